"""Records made canonical, ranked, merged field by field, and recomputed from their stored accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import identity, numbers, text

#: Priority of sources, mergeable fields, and the fields that count towards completeness.
PRIORITY = ("goodreads", "googlebooks", "openlibrary", "gutendex")
MERGED = (
    "title", "normalised_title", "subtitle", "published_year", "page_count", "language", "publisher", "description", "cover_url", "download_count",
    "goodreads_average_rating", "normalised_first_author",
)
HASHED = (
    "title", "subtitle", "isbn13", "published_year", "publisher", "page_count", "download_count", "goodreads_average_rating", "language", "description", "cover_url",
)


def canonicalise(records: DataFrame) -> DataFrame:
    """Raw records (the fields of ``raw_book``) with normalised forms, ISBN, year, language and identity, or a rejection.

    A record without a title that can be compared is unidentifiable. Page counts must be positive, downloads not
    negative, a lifespan must not end before it begins; what breaks a rule is dropped from the record, not the record.
    """
    title = text.strip_marc(F.col("title"))
    authors = F.filter(F.coalesce("authors", F.array()), lambda a: F.length(F.trim(a["name"])) > 0)
    first = F.try_element_at(authors, F.lit(1))["name"]
    step = records.select(
        "*",
        text.title_form(title).alias("normalised_title"),
        numbers.canonical_isbn(F.col("isbns")).alias("isbn13"),
        numbers.parse_year(F.col("published")).alias("published_year"),
        identity.select_language(F.col("languages")).alias("language"),
        text.author_form(first).alias("normalised_first_author"),
    )
    clean = step.withColumns({
        "title": text.squeeze(title),
        "authors": authors,
        "page_count": F.when(F.col("page_count") > 0, F.col("page_count")),
        "download_count": F.when(F.col("download_count") >= 0, F.col("download_count")),
        "identity_key": identity.identity_key(F.col("isbn13"), F.col("normalised_title"), F.col("normalised_first_author"), F.col("published_year")),
    })
    rejection = F.when(
        F.col("identity_key").isNull(), F.struct(F.lit("unidentifiable").alias("code"), F.lit("no title that can be compared").alias("detail"))
    )
    return clean.withColumn("rejection", rejection)


def completeness(frame: DataFrame) -> Column:
    """How many of the counted fields are filled: 0, '' and empty lists are not."""
    kinds = dict(frame.dtypes)

    def filled(name: str) -> Column:
        kind, c = kinds[name], F.col(name)
        test = F.length(c) > 0 if kind == "string" else F.size(c) > 0 if kind.startswith("array") else c != 0
        return F.coalesce(test, F.lit(False)).cast("int")

    counted = [f for f in (*MERGED, "authors", "subjects", "series") if f in kinds]
    total = F.lit(0)
    for name in counted:
        total = total + filled(name)
    return total


def priority(source: Column) -> Column:
    return F.coalesce(*[F.when(source == s, F.lit(i)) for i, s in enumerate(PRIORITY)], F.lit(len(PRIORITY)))


def rank(frame: DataFrame) -> Column:
    """A total order of candidates: fullest first, then by source, then by source id."""
    return F.struct((-completeness(frame)).alias("c"), priority(F.col("source")).alias("p"), F.col("source_id").alias("i"), F.col("source").alias("s"))


def merge(candidates: DataFrame, by: str, target: str | None = None) -> DataFrame:
    """One record per ``by``: each field's first value in rank order, lists whole from the best that has any, series from
    the best that has a confirmed one. Partial aggregates only, in whatever order rows come.

    ``target`` names a column with the identity that the group's record already has, if any. A group is refused (its
    ``conflict`` is true and its values are null) if it holds more than one ISBN, or one that is not the target's, or, with
    neither an ISBN nor a target, more than one fallback identity.
    """
    ranked = candidates.withColumn("__rank", rank(candidates)).withColumn("__target", F.col(target) if target else F.lit(None).cast("string"))
    kinds = dict(candidates.dtypes)
    first = lambda name, test: F.min_by(F.when(test, F.col(name)), F.when(test, F.col("__rank"))).alias(name)
    fields = [first(f, F.col(f).isNotNull()) for f in MERGED if f in kinds]
    lists = [first(f, F.size(f) > 0) for f in ("authors", "subjects") if f in kinds]
    if "series" in kinds:
        sure = F.exists("series", lambda s: s["confirmed"])
        some = F.size("series") > 0
        order = F.when(some, F.struct((~F.coalesce(sure, F.lit(False))).alias("u"), F.col("__rank").alias("r")))
        lists.append(F.min_by(F.when(some, F.col("series")), order).alias("series"))
    winner = F.min_by(F.struct("source", "source_id"), "__rank")
    differ = lambda c: F.min(c) != F.max(c)
    merged = ranked.groupBy(by).agg(
        *fields, *lists, winner["source"].alias("source"), winner["source_id"].alias("source_id"), F.min("isbn13").alias("__isbn"), F.min("__target").alias("__target"),
        F.min("identity_key").alias("__key"), differ("isbn13").alias("__isbns"), differ("identity_key").alias("__keys"), F.count("*").alias("n_records"),
    )
    wanted = F.when(F.col("__target").startswith("isbn:"), F.substring("__target", 6, 13))
    one = F.coalesce("__isbn", wanted)
    conflict = F.coalesce("__isbns", F.lit(False)) | F.coalesce(F.col("__isbn") != wanted, F.lit(False)) | (one.isNull() & F.col("__target").isNull() & F.coalesce("__keys", F.lit(False)))
    key = F.coalesce(F.concat(F.lit("isbn:"), one), "__target", "__key")
    kept = [c for c in merged.columns if c not in (by, "n_records") and not c.startswith("__")]
    return merged.select(by, "n_records", conflict.alias("conflict"), *[F.when(~conflict, F.col(c)).alias(c) for c in kept], F.when(~conflict, one).alias("isbn13"), F.when(~conflict, key).alias("identity_key"))


def unify_identity(records: DataFrame, by: str) -> DataFrame:
    """``records`` with one identity and ISBN per ``by``: the ISBN's if there is exactly one, the best-ranked record's if
    there is none; groups whose ISBNs conflict keep their own."""
    ranked = records.withColumn("__rank", rank(records))
    agreed = ranked.groupBy(by).agg((F.min("isbn13") != F.max("isbn13")).alias("__apart"), F.min("isbn13").alias("__isbn"), F.min_by("identity_key", "__rank").alias("__key"))
    joined = records.join(agreed, by, "left")
    return agree(joined.withColumn("__target", F.when(~F.coalesce("__apart", F.lit(False)), F.coalesce(F.concat(F.lit("isbn:"), "__isbn"), "__key"))), "__target").drop("__apart", "__isbn", "__key", "__target")


def agree(records: DataFrame, target: str) -> DataFrame:
    """``records`` on the identity in the column ``target`` where it has one: key and ISBN move together, the rest stays."""
    moved = F.col(target).isNotNull() & ~F.col("identity_key").eqNullSafe(F.col(target))
    isbn = F.when(F.col(target).startswith("isbn:"), F.substring(F.col(target), 6, 13))
    return records.withColumns({"isbn13": F.when(moved, isbn).otherwise(F.col("isbn13")), "identity_key": F.coalesce(target, "identity_key")})


def content_hash(frame: DataFrame) -> Column:
    return identity.content_hash(*[(f, F.col(f)) for f in HASHED if f in frame.columns])


def first_download_count(records: DataFrame, by: str) -> DataFrame:
    """``download_count`` is one provider's to tell: its first account's value."""
    own = F.col("source") == "gutendex"
    return records.groupBy(by).agg(F.min_by(F.when(own, F.col("download_count")), F.when(own & F.col("download_count").isNotNull(), F.col("source_id"))).alias("download_count"))


def changed_only(old: DataFrame, new: DataFrame, by: str, stamp: Column) -> DataFrame:
    """``new`` (with ``content_hash``) beside ``old``: ``updated_at`` moves only where the hash differs."""
    before = old.select(by, F.col("content_hash").alias("old_hash"), F.col("updated_at").alias("old_updated_at"))
    moved = ~F.col("content_hash").eqNullSafe(F.col("old_hash"))
    joined = new.join(before, by, "left")
    return joined.withColumn("updated_at", F.when(moved, stamp).otherwise(F.col("old_updated_at"))).withColumn("changed", moved).drop("old_hash", "old_updated_at")


def running_budget(attempts: DataFrame, run: list[str], order: str, cost: Column, limit: int) -> DataFrame:
    """``attempts`` with ``within``: whether the run's budget still covers an attempt in its order."""
    w = Window.partitionBy(*run).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return attempts.withColumn("within", F.sum(cost).over(w) <= limit)
