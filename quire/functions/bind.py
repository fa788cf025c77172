"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once.

    A helper column would be put in place of each of its uses by the optimizer, inside lambdas too, and be computed
    there again for each element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), then), 1)
