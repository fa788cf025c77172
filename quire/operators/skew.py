"""Equi-joins whose keys may be hot: a key of many rows is spread over several tasks on both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut_lineage

#: Rows of a key from which it is spread, and rows of it that one task then holds.
HOT = 5_000
#: Hot keys of at most this number are broadcast; more are joined by key.
FEW = 50_000


def hot_keys(index: DataFrame, key: Sequence[str], hot: int = HOT) -> DataFrame | None:
    """key..., __salts: the keys of more than ``hot`` rows and how many parts each is cut into; None if there is none.

    The counts are partial aggregates, so a hot key costs no task more than others; at most one key in ``hot`` rows is kept.
    """
    counted = index.groupBy(*key).agg(F.count("*").alias("__n")).where(F.col("__n") > hot)
    found = cut_lineage(counted.select(*key, F.ceil(F.col("__n") / hot).cast("int").alias("__salts")))
    n = found.count()
    return None if not n else F.broadcast(found) if n <= FEW else found


def salted_join(probe: DataFrame, index: DataFrame, key: Sequence[str], hot: int = HOT) -> DataFrame:
    """Inner join of ``probe`` and ``index`` on ``key`` (columns of both; no other name may be shared).

    The rows of a hot key of ``index`` are dealt to parts by their hash (a retried task deals them alike), and the probe's rows
    of that key are repeated once per part, so a task holds about ``hot`` index rows of a key. Rows with a null key meet nothing; an empty side gives no rows.
    """
    parts = hot_keys(index, key, hot)
    if parts is None:
        return probe.join(index, list(key))
    salts = F.coalesce("__salts", F.lit(1))
    dealt = index.join(parts, list(key), "left").withColumn("__salt", F.pmod(F.xxhash64(*index.columns), salts).cast("int")).drop("__salts")
    spread = probe.join(parts, list(key), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    return spread.join(dealt, [*key, "__salt"]).drop("__salt")
