"""Rules over recorded responses: outcomes, budgets, circuit breakers, retries, cooldowns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Statuses that may be tried again (fixed values).
RETRYABLE = (408, 425, 429, 500, 502, 503, 504)


def classify(status: Column, challenged: Column, empty: Column) -> Column:
    """ok, challenge, denied, transient, blocked or final, from a response's status and body."""
    return (
        F.when(challenged, "challenge").when(status.isin(401, 403, 429), "denied").when(status >= 500, "transient")
        .when(status >= 400, "final").when(empty, "blocked").otherwise("ok")
    )


def block_wait(attempt: Column, pause: float) -> Column:
    """Seconds before trying a blocked page again: 10, 60, 360, ... up to ``pause``."""
    return F.least(F.lit(float(pause)), F.lit(10.0) * F.pow(F.lit(6.0), attempt - 1))


def retry_wait(attempt: Column, retry_after: Column, base: float, most: float) -> Column:
    """Upper bound of the jittered wait, or what the server asks for, within ``most``."""
    return F.least(F.lit(most), F.coalesce(retry_after, base * F.pow(F.lit(2.0), attempt - 1)))


def breaker(attempts: DataFrame, by: list[str], order: list[str], failed: Column, trips: Column, threshold: int) -> DataFrame:
    """``attempts`` with ``failures`` (consecutive ones so far) and ``open``: whether the breaker was open before it.

    A success ends a run of failures; the breaker opens after ``threshold`` in a row, or at once on ``trips``.
    """
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = attempts.withColumn("__ok", (~failed).cast("int")).withColumn("__run", F.sum("__ok").over(w))
    in_run = Window.partitionBy(*by, "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = runs.withColumn("failures", F.sum(failed.cast("int")).over(in_run))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    opened = ((F.col("failures") >= threshold) | trips).cast("int")
    return counted.withColumn("__opens", opened).withColumn("open", F.coalesce(F.max("__opens").over(before) > 0, F.lit(False))).drop("__ok", "__run", "__opens")


def budgets(attempts: DataFrame, by: list[str], order: list[str], limit: int, quota: Column) -> DataFrame:
    """``attempts`` with ``outcome``: tried, or skipped once the budget is spent or a quota answer spent it all."""
    w = Window.partitionBy(*by).orderBy(*order)
    spent = F.max(quota.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    within = F.row_number().over(w) <= limit
    return attempts.withColumn("outcome", F.when(within & (F.coalesce(spent, F.lit(0)) == 0), "tried").otherwise("skipped"))


def cooling_down(refusals: DataFrame, now: Column, minutes: int) -> DataFrame:
    """source, last_refusal, minutes_since, cooling: whether a source refused within the window before ``now``."""
    last = refusals.groupBy("source").agg(F.max("finished_at").alias("last_refusal"))
    since = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.col("last_refusal").cast("timestamp"))) / 60.0
    return last.select("source", "last_refusal", since.alias("minutes_since"), (since < minutes).alias("cooling"))


def run_status(candidates: Column, resolved: Column) -> Column:
    """failed without candidates or without a resolved one, success if all are, else partial_success."""
    return F.when((candidates == 0) | (resolved == 0), "failed").when(resolved >= candidates, "success").otherwise("partial_success")


def abandon_stale(runs: DataFrame, now: Column, hours: int = 12) -> DataFrame:
    """Runs still ``running`` after ``hours`` are failed; runs that are ``processing`` stay."""
    old = F.col("started_at") < now - F.expr(f"interval {int(hours)} hours")
    return runs.withColumn("status", F.when((F.col("status") == "running") & old, "failed").otherwise(F.col("status")))


def resolve(candidates: DataFrame, answers: dict[str, DataFrame], key: str, hierarchy: list[str]) -> DataFrame:
    """``candidates`` with ``resolved_by``: the first source of the hierarchy with an answer for the key, and ``attempts``,
    one per source asked: resolved, no_match, or skipped once an earlier source resolved it."""
    asked = candidates
    for source in hierarchy:
        found = answers[source].select(key).where(F.col(key).isNotNull()).distinct().withColumn(f"__{source}", F.lit(True))
        asked = asked.join(found, key, "left")
    resolved = F.coalesce(*[F.when(F.col(f"__{s}"), F.lit(s)) for s in hierarchy])
    attempts, done = [], F.lit(False)
    for source in hierarchy:
        hit = F.coalesce(F.col(f"__{source}"), F.lit(False))
        attempts.append(F.struct(F.lit(source).alias("source"), F.when(done, "skipped").when(hit, "resolved").otherwise("no_match").alias("outcome")))
        done = done | hit
    return asked.select(*candidates.columns, resolved.alias("resolved_by"), F.array(*attempts).alias("attempts"))


#: What an answer may be; each attempt ends in one of these or in ``skipped`` (fixed values).
OUTCOMES = ("resolved", "partial", "no_match", "contract_failure", "unavailable")


def resolve_candidates(candidates: DataFrame, answers: DataFrame, hierarchy: list[str], enrich: bool = False, retained: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(resolutions, attempts) of ``candidates`` (candidate_key, ...) by recorded ``answers`` (candidate_key, source, state).

    A candidate's retained payload, if ``retained`` says that it is whole, answers first. Sources are then asked in order: the
    first that resolves ends the search, and those after it are skipped; with ``enrich`` all are asked. A partial answer
    fills gaps and does not end the search. Attempts: candidate_key, source, attempt_no, outcome, fallback_reason.
    """
    best = answers.groupBy("candidate_key").agg(*[
        F.min(F.when(F.col("source") == s, F.array_position(F.array(*[F.lit(o) for o in OUTCOMES]), F.col("state")))).alias(f"__{i}") for i, s in enumerate(hierarchy)
    ])
    asked = candidates.withColumn("__kept", F.coalesce(retained if retained is not None else F.lit(False), F.lit(False))).join(best, "candidate_key", "left")
    done, rows, by = F.col("__kept"), [F.struct(F.lit("retained").alias("source"), F.lit(0).alias("attempt_no"), F.lit("resolved").alias("outcome"), F.lit(None).cast("string").alias("fallback_reason"))], F.when(F.col("__kept"), "retained")
    rows[0] = F.when(F.col("__kept"), rows[0])
    for i, source in enumerate(hierarchy):
        outcome = F.coalesce(F.try_element_at(F.array(*[F.lit(o) for o in OUTCOMES]), F.nullif(F.col(f"__{i}"), F.lit(0)).cast("int")), F.lit("no_match"))
        held = F.lit(False) if enrich else done
        shown = F.when(held, "skipped").otherwise(outcome)
        reason = F.when(held, "already resolved").when(shown != "resolved", F.concat(F.lit(source + ": "), F.regexp_replace(shown, "_", " ")))
        rows.append(F.struct(F.lit(source).alias("source"), F.lit(i + 1).alias("attempt_no"), shown.alias("outcome"), reason.alias("fallback_reason")))
        by = F.coalesce(by, F.when(shown == "resolved", F.lit(source)))
        done = done | (shown == "resolved")
    partial = F.coalesce(*[F.when(F.col(f"__{i}") == 2, F.lit(s)) for i, s in enumerate(hierarchy)])
    resolutions = asked.select("candidate_key", by.alias("resolved_by"), F.when(by.isNull(), partial).alias("filled_by"))
    attempts = asked.select("candidate_key", F.explode(F.array_compact(F.array(*rows))).alias("a")).select("candidate_key", "a.*")
    return resolutions, attempts


def release_times(requests: DataFrame, by: list[str], at: str, order: str, spacing: float) -> DataFrame:
    """``requests`` with ``released``: seconds at which each may go out so that two of a group are ``spacing`` apart.

    Request i leaves at the latest of arrival j plus the spacing of those from j to i: a running maximum, no recursion.
    """
    w = Window.partitionBy(*by).orderBy(at, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = requests.withColumn("__i", F.row_number().over(Window.partitionBy(*by).orderBy(at, order)))
    ahead = F.max(F.col(at) - F.col("__i") * spacing).over(w)
    return placed.withColumn("released", ahead + F.col("__i") * spacing).drop("__i")


def cache_hits(lookups: DataFrame, key: list[str], at: str, order: str, seconds: float, empty: Column) -> DataFrame:
    """``lookups`` with ``hit``: whether the same key was answered, not emptily, at most ``seconds`` before."""
    w = Window.partitionBy(*key).orderBy(at, order).rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(~empty, F.col(at))).over(w)
    return lookups.withColumn("hit", F.coalesce(F.col(at) - last <= seconds, F.lit(False)))


def ensure_accepted(enabled: bool, accepted: bool) -> None:
    """Both switches, or nothing that anyone could observe happens."""
    if not (enabled and accepted):
        raise PermissionError("the source must be enabled and its terms accepted")


def ranked_answers(scored: DataFrame, by: list[str], threshold: float, most: int = 3) -> DataFrame:
    """The best answers per group: score at least ``threshold``, by score, then by their own order (``index``)."""
    kept = scored.where(F.col("score") >= threshold)
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "index")
    return kept.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)
