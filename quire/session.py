"""Session settings, table reading and lineage cuts shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "quire", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    Only on one machine (a local master, as in tests) may the setting be absent: a temporary folder then takes its place.
    On a cluster its absence is an error, since executors do not see the driver's folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), f"quire-checkpoints-{os.getpid()}")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def _has_void(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_void(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_void(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_void(kind.keyType) or _has_void(kind.valueType)
    return isinstance(kind, T.NullType)


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Materialise ``frame`` in the shared folder, so that it is computed once and outlives executors.

    It is written as a table: a checkpoint of the rows would compute its last stage twice, once to count and once to write,
    takes several times the space, and is read whole where a table is read by column. What a table cannot hold (columns
    without a type) is checkpointed. The table is deleted when the session's JVM ends.
    """
    spark = frame.sparkSession
    folder = shared_folder(spark)
    if not frame.columns or _has_void(frame.schema):
        return frame.checkpoint(eager=True)
    path = f"{folder}/quire-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(frame.schema).parquet(path)


def check_columns(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only ``columns`` of ``frame``; a missing one is an error before any job starts."""
    missing = [c for c in columns if c not in frame.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return frame.select(*[F.col(f"`{c}`") for c in columns])


def blank(column: Column) -> Column:
    """True for null and for text of nothing but white space."""
    return column.isNull() | ~column.rlike(r"(?U)[^\s\x{1c}-\x{1f}]")
