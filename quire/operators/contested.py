"""Conflicts between the accounts of one book, and the backlog still to be enriched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Comparable fields and the payload members that may hold each, in order (fixed values).
COMPARED = {
    "title": ("title",),
    "published_year": ("published", "first_publish_year", "publish_date", "publishedDate"),
    "publisher": ("publisher", "publishers"),
    "page_count": ("page_count", "number_of_pages", "number_of_pages_median", "pageCount"),
}


def readable(v: Column, member: str) -> Column:
    """struct(text) of a payload's member as it is compared: at the top level if the member is there at all, null included,
    else in ``volumeInfo``; a list counts by its first. Null if the member is absent, null, '' or an empty list."""
    at = lambda path: F.try_variant_get(v, path, "variant")
    value = F.coalesce(at(f"$.{member}"), at(f"$.volumeInfo.{member}"))
    shape = F.schema_of_variant(value)
    listed = shape.startswith("ARRAY")
    text = F.when(listed, F.try_variant_get(value, "$[0]", "string")).otherwise(F.try_variant_get(value, "$", "string"))
    empty = (shape == "VOID") | (~listed & (text == "")) | (listed & F.try_variant_get(value, "$[0]", "variant").isNull())
    return F.when(value.isNotNull() & ~F.coalesce(empty, F.lit(False)), F.struct(F.lower(F.trim(text)).alias("text")))


def comparable_values(payloads: DataFrame) -> DataFrame:
    """``payloads`` (..., raw_payload) with a text per comparable field, that of the first member with a value; null where
    the payload has none."""
    parsed = payloads.withColumn("v", F.try_parse_json("raw_payload"))
    return parsed.select(*payloads.columns, *[F.coalesce(*[readable(F.col("v"), m) for m in members])["text"].alias(f) for f, members in COMPARED.items()])


def conflict_counts(payloads: DataFrame, by: str = "book_id") -> DataFrame:
    """by, n_sources, conflicts: in how many fields a book's accounts differ. Texts are compared as they are."""
    fields = [F.count_distinct(f).alias(f"n_{f}") for f in COMPARED]
    counted = comparable_values(payloads).groupBy(by).agg(F.count_distinct("source").alias("n_sources"), *fields)
    conflicts = sum(((F.col(f"n_{f}") > 1).cast("int") for f in COMPARED), F.lit(0))
    return counted.select(by, "n_sources", conflicts.alias("conflicts"))


def find_contested(payloads: DataFrame, minimum: int, limit: int, skip_source: str | None = None) -> DataFrame:
    """The most contested books of several sources: by conflicts, then id; ``skip_source``'s books are settled already."""
    several = conflict_counts(payloads).where((F.col("n_sources") > 1) & (F.col("conflicts") >= minimum))
    if skip_source is not None:
        several = several.join(payloads.where(F.col("source") == skip_source).select("book_id").distinct(), "book_id", "left_anti")
    return several.orderBy(F.desc("conflicts"), "book_id").limit(limit)


def find_unenriched(accounts: DataFrame, limit: int, markers: tuple[str, ...] = ("_edition", "_detail"), source: str = "goodreads") -> DataFrame:
    """One source's accounts whose payload has none of ``markers`` (presence counts, null included), longest unseen first."""
    keys = F.coalesce(F.json_object_keys("raw_payload"), F.array().cast("array<string>"))
    bare = ~F.arrays_overlap(keys, F.array(*[F.lit(m) for m in markers]))
    return accounts.where((F.col("source") == source) & bare).orderBy("last_seen_at", "source_id").limit(limit)
