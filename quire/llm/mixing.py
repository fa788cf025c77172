"""Sources mixed to target shares of the total size, in tokens of a public tokenizer.

Each document has a membership in every listed source: one-hot where its source is listed, the posterior of a
classifier trained on the labelled documents where it has none, nothing where its source has no target. Nonnegative
rates, how often each document is used, are fitted by projected-gradient least squares, so that the expected tokens of
each source meet its target; the projection keeps every rate between 0 and the source's cap. A step needs one number
per source from the corpus; documents of equal membership share a rate, which is kept per membership, not per document.
Rates become whole numbers of uses by systematic rounding, and what that leaves is made up for by small documents.

The total is the largest at which every source that has documents can reach its share within its cap.

Defined results: null, empty and blank texts have no or few tokens and are used like others; documents of sources
without a target are not used; a listed source without documents has share 0 and the others' shares are in proportion;
no documents or no targets give no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.bind import let
from quire.llm import encode
from quire.operators import skew
from quire.session import check_columns, cut_lineage

#: Labelled documents the classifier is fitted on at most.
TRAINING_ROWS = 20_000
FEATURES = 1 << 13
#: More listed sources are an error: their targets and residuals are held by the driver.
MOST_SOURCES = 1_000
STEPS = 60
#: Summed deviation from the targets, as a share of the total, at which the fit stands still.
SETTLED = 1e-4
#: Posteriors are taken to this grain, so that documents of one membership form few groups.
GRAIN = 0.02
#: Fitting steps after which the running rates are written down.
CUT = 10
#: Documents per rounding block, about.
BLOCK = 5_000


def targets_of(targets: DataFrame) -> list[tuple[str, float, int]]:
    rows = targets.where("source is not null and target_share > 0").select("source", "target_share", "max_repeats").orderBy("source").limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} target sources")
    return [(r["source"], float(r["target_share"]), int(r["max_repeats"] or 0)) for r in rows]


def token_counts(documents: DataFrame) -> DataFrame:
    """doc_id, tokens."""
    return encode.encode_corpus(documents).select("doc_id", F.size("ids").cast("long").alias("tokens"))


def memberships(documents: DataFrame, sources: list[str], training_rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, membership: array<double> over ``sources``; rows of sources without a target are left out."""
    # Imported where they are used: no other operator needs them in the driver's memory.
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    rows = check_columns(documents, ["doc_id", "text", "source"])
    at = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source"))
    own = lambda i: F.when(at == i + 1, 1.0).otherwise(0.0)
    listed = rows.where(F.col("source").isin(sources)).select("doc_id", F.array(*[own(i) for i in range(len(sources))]).alias("membership"))
    unlabelled = rows.where("source is null").select("doc_id", "text")
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: F.length(w) > 0)
    # Only ids are ordered; the texts of those chosen follow by id, of which there are at most ``training_rows``.
    chosen = rows.where(F.col("source").isin(sources)).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(training_rows)
    labelled = cut_lineage(
        rows.where(F.col("source").isin(sources)).join(F.broadcast(cut_lineage(chosen)), "doc_id", "left_semi").select((at - 1).cast("double").alias("label"), words.alias("words"))
    )
    seen = sorted(int(r["label"]) for r in labelled.select("label").distinct().collect())
    if not seen:
        return listed
    if len(seen) == 1:
        only = F.array(*[F.lit(1.0 if i == seen[0] else 0.0) for i in range(len(sources))])
        return listed.unionByName(unlabelled.select("doc_id", only.alias("membership")))
    tf = HashingTF(inputCol="words", outputCol="features", numFeatures=FEATURES)
    model = NaiveBayes(smoothing=1.0).fit(tf.transform(labelled))
    guessed = model.transform(tf.transform(unlabelled.withColumn("words", words))).select("doc_id", vector_to_array("probability").alias("p"))
    # The model knows classes up to the largest label seen; the rest have no documents.
    grained = [F.round(F.coalesce(F.try_element_at("p", F.lit(i + 1)), F.lit(0.0)) / GRAIN) for i in range(len(sources))]
    whole = let(F.array(*grained), lambda p: F.transform(p, lambda x: x / F.aggregate(p, F.lit(0.0), lambda a, y: a + y)))
    return listed.unionByName(guessed.select("doc_id", whole.alias("membership")))


def _cap(membership: Column, caps: list[int]) -> Column:
    return F.aggregate(F.zip_with(membership, F.array(*[F.lit(float(c)) for c in caps]), lambda p, c: p * c), F.lit(0.0), lambda a, x: a + x)


def _move(rate: Column, membership: Column, step: np.ndarray, caps: list[int]) -> Column:
    """A rate after one step: moved along its document's memberships and back into its bounds."""
    along = F.aggregate(F.zip_with(membership, F.array(*[F.lit(float(x)) for x in step]), lambda p, s: p * s), F.lit(0.0), lambda a, x: a + x)
    return F.greatest(F.lit(0.0), F.least(_cap(membership, caps), rate - along))


def fit_rates(sized: DataFrame, wanted: list[tuple[str, float, int]], steps: int = STEPS) -> tuple[DataFrame, np.ndarray]:
    """(membership -> rate, goal tokens per source) for ``sized`` (membership, tokens).

    Documents of equal membership have equal rates, so the steps run over distinct memberships and their token sums, each
    with its running rate. Only one number per source comes to the driver in a step.
    """
    caps = [c for _, _, c in wanted]
    size = len(wanted)
    first = F.least(F.lit(1.0), _cap(F.col("membership"), caps))
    groups = cut_lineage(sized.groupBy("membership").agg(F.sum("tokens").alias("tokens")).withColumn("rate", first))
    sums = lambda frame, rate: np.array([float(x or 0.0) for x in frame.select(*[F.sum(rate * F.col("tokens") * F.col("membership")[i]).alias(f"s{i}") for i in range(size)]).first()])
    available = sums(groups, F.lit(1.0))
    share = np.array([t for _, t, _ in wanted]) * (available > 0) * (np.array(caps) > 0)
    if not share.any():
        return groups.select("membership", F.lit(0.0).alias("rate")), np.zeros(size)
    share = share / share.sum()
    total = min(c * a / s for c, a, s in zip(caps, available, share) if s > 0)
    goal = share * total
    scale = np.where(available > 0, available, 1.0)
    for at in range(steps):
        off = sums(groups, F.col("rate")) - goal
        if np.abs(off).sum() <= SETTLED * total:
            break
        # Preconditioned by the tokens of each source: a full step for a source that shares its documents with none.
        groups = groups.withColumn("rate", _move(F.col("rate"), F.col("membership"), off / scale, caps))
        groups = cut_lineage(groups) if at % CUT == CUT - 1 else groups
    return groups.select("membership", "rate"), goal


def mix(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """doc_id, tokens, membership, rate, uses: how often each document is used, 0 included, at most its cap."""
    wanted = targets_of(targets)
    spark = documents.sparkSession
    if not wanted:
        return spark.createDataFrame([], "doc_id bigint, tokens bigint, membership array<double>, rate double, uses int")
    sources, caps = [s for s, _, _ in wanted], [c for _, _, c in wanted]
    sized = cut_lineage(memberships(documents, sources).join(token_counts(documents), "doc_id"))
    rates, goal = fit_rates(sized, wanted)
    # A document of unknown source may be any of several: the strictest cap it may fall under holds for its uses.
    strict = F.array_min(F.zip_with("membership", F.array(*[F.lit(c) for c in caps]), lambda p, c: F.when(p > 0, c)))
    rated = skew.salted_join(rates, sized, ["membership"]).withColumn("rate", F.least("rate", strict.cast("double")))
    return _settled(cut_lineage(_whole_uses(rated, strict)), goal, strict)


def _whole_uses(rated: DataFrame, strict: Column) -> DataFrame:
    """Systematic rounding: along documents from large to small, whole uses follow the running sum of rates.

    The order is cut into blocks by hash, so that no task holds a source; a block's rounding is off by less than one
    document.
    """
    main = F.array_position("membership", F.array_max("membership"))
    sizes = rated.groupBy(main.alias("main")).agg(F.count("*").alias("n"))
    placed = rated.withColumn("main", main).join(F.broadcast(sizes), "main")
    block = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("long"))
    w = Window.partitionBy("main", "block").orderBy(F.desc("tokens"), F.xxhash64("doc_id", F.lit(1)), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.floor("rate").cast("int")
    parts = placed.withColumn("block", block).withColumn("base", base).withColumn("part", F.col("rate") - F.col("base"))
    # One more use where the running sum of fractional rates passes the next half.
    after = F.sum("part").over(w)
    more = (F.floor(after + 0.5) > F.floor(after - F.col("part") + 0.5)).cast("int")
    uses = F.least(F.col("base") + more, strict)
    return parts.select("doc_id", "tokens", "membership", "rate", F.greatest(uses, F.lit(0)).cast("int").alias("uses"))


def _settled(used: DataFrame, goal: np.ndarray, strict: Column) -> DataFrame:
    """``used`` after what whole uses lack or exceed in each source is made up for by its smallest documents, one use each.

    Which sizes take part follows from a histogram of sizes per source; of the last size, the part that is still needed is
    taken by hash. Only documents that belong to one source wholly take part.
    """
    size = len(goal)
    got = used.select(*[F.sum(F.col("uses") * F.col("tokens") * F.col("membership")[i]).alias(f"s{i}") for i in range(size)]).first()
    lack = [float(g) - float(x or 0.0) for g, x in zip(goal, got)]
    main = F.array_position("membership", F.array_max("membership")).cast("int")
    parts = used.withColumn("main", main).withColumn("lack", F.element_at(F.array(*[F.lit(x) for x in lack]), main))
    room = F.when(F.col("lack") > 0, F.col("uses") < strict).otherwise(F.col("uses") > 0)
    parts = parts.withColumn("open", F.coalesce(room, F.lit(False)) & (F.array_max("membership") >= 1.0) & (F.col("tokens") > 0))
    sizes = parts.where("open").groupBy("main", "tokens").agg(F.count("*").alias("n"), F.first("lack").alias("lack"))
    w = Window.partitionBy("main").orderBy("tokens").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("n") * F.col("tokens")).over(w), F.lit(0))
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.floor((F.abs("lack") - before) / F.col("tokens")) / F.col("n")))
    taken = sizes.select("main", "tokens", part.alias("part")).where("part > 0")
    joined = parts.join(taken, ["main", "tokens"], "left")
    chosen = F.col("open") & (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1_000_000)) < F.coalesce("part", F.lit(0.0)) * 1_000_000)
    step = F.when(chosen, F.signum("lack")).otherwise(0).cast("int")
    return joined.select("doc_id", "tokens", "membership", "rate", (F.col("uses") + step).alias("uses"))


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, tokens, actual_share of each listed source."""
    wanted = targets_of(targets)
    spark = mixed.sparkSession
    kept = cut_lineage(mixed.where("uses > 0"))
    row = kept.select(*[F.sum(F.col("uses") * F.col("tokens") * F.col("membership")[i]).alias(f"s{i}") for i in range(len(wanted))]).first() if wanted else []
    got = [float(x or 0.0) for x in row]
    whole = sum(got) or 1.0
    return spark.createDataFrame(
        [(s, t, c, g, g / whole) for (s, t, c), g in zip(wanted, got)], "source string, target_share double, max_repeats int, tokens double, actual_share double"
    )
