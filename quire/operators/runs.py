"""The life of a run: started, sources skipped, attempts logged, finished, assessed and reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.operators import policy, upsert

#: Lag above which a consumer is behind, and for how long it must not have shrunk (fixed values).
LAG, LAG_MINUTES = 1000, 15


def start_run(runs: DataFrame, run_id: str, label: str, now: Column) -> DataFrame:
    """``runs`` (run_id, label, status, started_at, ...) with a new one running, after stale ones are given up."""
    swept = policy.abandon_stale(runs, now)
    new = runs.sparkSession.createDataFrame([(run_id, f"cli:{label}", "running")], "run_id string, label string, status string").withColumn("started_at", now)
    return swept.unionByName(new, allowMissingColumns=True)


def skip_sources(stored: DataFrame, skips: DataFrame) -> DataFrame:
    """(run_id, source, status, reason) after ``skips`` (run_id, source, reason): the last word on a source holds."""
    return upsert.upsert(stored, skips.withColumn("status", F.lit("skipped")), ["run_id", "source"])


def record_attempts(stored: DataFrame, attempts: DataFrame) -> DataFrame:
    """Attempts by (run_id, candidate_key, source, attempt_no): outcome, reason and duration are the last written."""
    return upsert.upsert(stored, attempts, ["run_id", "candidate_key", "source", "attempt_no"])


def finish_runs(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """Running runs with the status and the counts (run_id, candidates, resolved) they end with; finished ones stay."""
    joined = runs.join(counts, "run_id", "left")
    over = (F.col("status") == "running") & F.col("candidates").isNotNull()
    return joined.withColumn("status", F.when(over, policy.run_status(F.col("candidates"), F.col("resolved"))).otherwise(F.col("status")))


def assess(counts: DataFrame) -> DataFrame:
    """``counts`` with ``verdict``: why a run fails as a whole (no candidates, none resolved), null if it does not."""
    return counts.withColumn("verdict", F.when(F.col("candidates") == 0, "no candidates").when(F.col("resolved") == 0, "none resolved"))


def recent_runs(runs: DataFrame, most: int = 5) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "run_id").limit(most)


def lag_alerts(lags: DataFrame) -> DataFrame:
    """``lags`` (topic, at, lag) with ``alert``: behind by more than ``LAG`` and not once shrinking for ``LAG_MINUTES``."""
    in_order = Window.partitionBy("topic").orderBy("at")
    grown = lags.withColumn("__grown", F.col("lag") - F.lag("lag").over(in_order)).withColumn("__s", F.unix_micros(F.col("at").cast("timestamp")))
    span = Window.partitionBy("topic").orderBy("__s").rangeBetween(-LAG_MINUTES * 60_000_000, 0)
    shrunk = F.coalesce(F.min("__grown").over(span) < 0, F.lit(False))
    return grown.withColumn("alert", (F.col("lag") > LAG) & ~shrunk).drop("__grown", "__s")


def report(books: DataFrame, accounts: DataFrame, people: DataFrame) -> DataFrame:
    """One row on a catalogue: books (book_id, isbn13, published_year), accounts (book_id, source), people (book_id, name)."""
    whole = books.agg(F.count("*").alias("books"), F.count("isbn13").alias("with_isbn"), F.count("published_year").alias("with_year"), F.round(100.0 * F.count("isbn13") / F.count("*"), 2).alias("isbn_percent"))
    told = accounts.groupBy("book_id").agg(F.count_distinct("source").alias("n")).agg(F.count_if(F.col("n") > 1).alias("n")).scalar()
    written = people.groupBy("book_id").agg(F.count_distinct("name").alias("n")).agg(F.count_if(F.col("n") > 1).alias("n")).scalar()
    return whole.withColumns({"accounts": accounts.agg(F.count("*").alias("n")).scalar(), "of_several_sources": told, "of_several_authors": written})
