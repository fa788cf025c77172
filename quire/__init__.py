"""quire: catalogue resolution and corpus preparation as Spark plans."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers need not have this package on their path: its functions travel with the plans that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
