"""Idempotent loading of observations into a catalogue of versioned snapshots.

An observation is one source's payload for one record. A load routes each observation to a book (by its stored account,
else by its identity, else to a new one), merges books that an observation ties together, recomputes every touched book
from all its stored payloads, and keeps authors, subjects and series in step. Loading the same input again changes
nothing but ``last_seen_at``; canonical fields are never taken from the observation in hand.

Every step is a set operation over the batch: keyed joins, partial aggregates, full outer joins with a rule per column.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import identity, numbers, text
from quire.operators import mapping, merge, upsert
from quire.session import cut_lineage
from quire.sources.files import Files

SCHEMAS = {
    "books": "book_id bigint, identity_key string, isbn13 string, title string, normalised_title string, subtitle string, published_year smallint, page_count int, language string, "
    "publisher string, description string, cover_url string, download_count bigint, goodreads_average_rating decimal(3,2), normalised_first_author string, "
    "series_search_text string, content_hash string, updated_at timestamp",
    "book_sources": "source string, source_id string, book_id bigint, raw_payload string, payload_hash string, source_updated timestamp, first_seen_at timestamp, last_seen_at timestamp",
    "authors": "normalised_name string, name string, birth_year smallint, death_year smallint",
    "book_authors": "book_id bigint, normalised_name string, position int",
    "subjects": "normalised_name string, name string",
    "book_subjects": "book_id bigint, normalised_name string",
    "series": "series_key string, name string, normalised_name string",
    "book_series": "book_id bigint, series_key string, position decimal(8,2), confirmed boolean",
    "rejected_records": "source string, raw_payload string, code string, detail string",
}


class Catalogue:
    """A folder of snapshots, ``version=N/table``; ``CURRENT`` names the one readers see and is replaced atomically."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def version(self) -> int:
        files, pointer = Files(self.spark), f"{self.folder}/CURRENT"
        return json.loads(files.read_text(pointer))["version"] if files.exists(pointer) else 0

    def tables(self) -> dict[str, DataFrame]:
        at = self.version()
        if not at:
            return {name: self.spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
        return {name: self.spark.read.schema(schema).parquet(f"{self.folder}/version={at}/{name}") for name, schema in SCHEMAS.items()}

    def publish(self, tables: dict[str, DataFrame]) -> int:
        """Write all tables as the next version, then point to it; a failed load leaves the old version in place."""
        at = self.version() + 1
        for name, frame in tables.items():
            frame.write.mode("overwrite").parquet(f"{self.folder}/version={at}/{name}")
        Files(self.spark).write_text(f"{self.folder}/CURRENT", json.dumps({"version": at}))
        return at

    def load(self, observations: DataFrame, now: Column) -> int:
        return self.publish(load_batch(self.tables(), observations, now))


def canonical_records(accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejected) of accounts (source, raw_payload, and any other columns), replayed through their mappers."""
    # Mapped once: the forms refer to each field many times, and its path into the payload would be read each time.
    mapped, refused = mapping.split(cut_lineage(mapping.map_payloads(accounts)))
    kept = [c for c in accounts.columns if c not in ("source_id",)]
    flat = mapped.select(*kept, "raw.*").withColumn("goodreads_average_rating", numbers.rating(F.col("rating_text"))).drop("rating_text")
    clean = merge.canonicalise(flat)
    shape = lambda frame: frame.select("source", "raw_payload", F.col("rejection.code").alias("code"), F.col("rejection.detail").alias("detail"))
    rejected = shape(refused).unionByName(shape(clean.where("rejection is not null")))
    return clean.where("rejection is null").drop("rejection"), rejected


def route(stored: dict[str, DataFrame], records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(source, source_id -> book_id) of the batch, (old_id -> new_id) of books that it ties together, and (book_id ->
    identity) of the books it touches.

    An account keeps its book; the book of its identity, if another, is tied to it. Books tied together become the one
    with the smallest id. The stored row arbitrates its book's identity: an ISBN it has stays, a fallback yields to an ISBN.
    """
    mine = stored["book_sources"].select("source", "source_id", F.col("book_id").alias("by_account"))
    owner = stored["books"].select("identity_key", F.col("book_id").alias("by_identity"))
    asked = records.select("source", "source_id", "identity_key").dropDuplicates(["source", "source_id"])
    found = cut_lineage(asked.join(mine, ["source", "source_id"], "left").join(owner, "identity_key", "left"))
    fresh = found.where("by_account is null and by_identity is null").select("identity_key")
    ids = upsert.assign_ids(stored["books"].select("identity_key", "book_id"), fresh, "identity_key", "book_id").withColumnRenamed("book_id", "by_key")
    placed = cut_lineage(found.join(ids, "identity_key", "left").withColumn("book_id", F.coalesce("by_account", "by_identity", "by_key")))
    # Accounts of one identity belong together, wherever each was stored: a star around the smallest book of the identity.
    hub = placed.groupBy("identity_key").agg(F.min(F.least("book_id", F.coalesce("by_identity", "book_id"))).alias("book_a"))
    ends = placed.select("identity_key", F.explode(F.array_compact(F.array("book_id", "by_identity"))).alias("book_b")).distinct()
    # Identities without an ISBN are fallbacks: they tie only what an ISBN does not contradict, so ties come from ISBNs.
    isbns = placed.where("identity_key like 'isbn:%'").select("identity_key").distinct()
    ties = ends.join(hub, "identity_key").join(isbns, "identity_key", "left_semi").where("book_a <> book_b").select("book_a", "book_b")
    mapped = upsert.reconcile_identities(ties).where("book <> root").select(F.col("book").alias("old_id"), F.col("root").alias("new_id"))
    mapped = cut_lineage(mapped)
    lead = lambda frame: frame.join(mapped, F.col("book_id") == F.col("old_id"), "left")
    led = cut_lineage(lead(placed).select("source", "source_id", "identity_key", F.coalesce("new_id", "book_id").alias("book_id")))
    held = lead(stored["books"].select("book_id", "identity_key")).select("identity_key", F.coalesce("new_id", "book_id").alias("book_id"), F.lit(0).alias("told"), F.col("new_id").isNotNull().alias("moved"))
    said = held.unionByName(led.select("identity_key", "book_id", F.lit(1).alias("told"), F.lit(True).alias("moved"))).join(led.select("book_id").distinct(), "book_id", "left_semi")
    isbn = F.col("identity_key").startswith("isbn:")
    identities = said.groupBy("book_id").agg(F.min_by("identity_key", F.struct((~isbn).alias("fallback"), F.col("told"), F.col("moved"), F.col("identity_key"))).alias("identity"))
    return led.select("source", "source_id", "book_id"), mapped, cut_lineage(identities)


def load_batch(stored: dict[str, DataFrame], observations: DataFrame, now: Column) -> dict[str, DataFrame]:
    """All tables after loading ``observations`` (source, raw_payload, source_updated)."""
    batch = cut_lineage(observations.select("source", "raw_payload", F.col("source_updated").cast("timestamp").alias("source_updated")))
    records, rejected = canonical_records(batch)
    records = cut_lineage(records)
    routed, mapped, identities = route(stored, records)

    latest = records.groupBy("source", "source_id").agg(F.max_by(F.struct("raw_payload", "source_updated"), F.struct("source_updated", "raw_payload")).alias("o"))
    incoming = latest.join(routed, ["source", "source_id"]).select(
        "source", "source_id", "book_id", "o.raw_payload", identity.payload_hash(F.col("o.raw_payload")).alias("payload_hash"), "o.source_updated",
        now.cast("timestamp").alias("first_seen_at"), now.cast("timestamp").alias("last_seen_at"),
    )
    old_sources = upsert.remap(stored["book_sources"], mapped, "book_id", ["source", "source_id"])
    sources = cut_lineage(upsert.upsert(old_sources, incoming, ["source", "source_id"], {"first_seen_at": upsert.fill}))

    touched = routed.select("book_id").distinct()
    replayed, _ = canonical_records(sources.join(touched, "book_id", "left_semi").select("book_id", "source", "raw_payload", "source_updated"))
    replayed = cut_lineage(replayed)
    books = _books(stored["books"], replayed, mapped, identities, now)

    people, author_links = upsert.sync_people(replayed, "book_id", text.author_form(F.col("author.name")))
    topics, topic_links = upsert.sync_subjects(replayed, "book_id", text.subject_form(F.col("subject")))
    members = replayed.select("book_id", "source", "source_id", F.explode("series").alias("m")).select(
        "book_id", "source", "source_id", "m.name", identity.series_form(F.col("m.name")).alias("normalised_name"), numbers.series_position(F.col("m.position")).alias("position"),
        F.coalesce("m.confirmed", F.lit(False)).alias("confirmed"), identity.series_key(F.col("source"), F.col("m.source_series_id"), F.col("m.name"), F.col("m.confirmed")).alias("series_key"),
    ).where("normalised_name is not null")
    named = members.groupBy("series_key").agg(F.min_by("name", F.struct("source", "source_id")).alias("name"), F.min("normalised_name").alias("normalised_name"))
    series = upsert.upsert(stored["series"], named, ["series_key"], {"name": upsert.fill})
    told = stored["book_series"].join(stored["series"].select("series_key", "normalised_name"), "series_key")
    remapped = upsert.remap(told, mapped, "book_id", ["book_id", "series_key"])
    joined = upsert.absorb_inferred(members.select("series_key", "normalised_name", "position", "confirmed", "book_id").unionByName(remapped.select("series_key", "normalised_name", "position", "confirmed", "book_id")))
    joined = cut_lineage(joined)
    shown = upsert.search_text(joined.join(series.select("series_key", "name"), "series_key"), "book_id").withColumnRenamed("series_search_text", "__text")
    books = books.join(shown, "book_id", "left")
    moved = ~F.coalesce("series_search_text", F.lit("")).eqNullSafe(F.coalesce("__text", F.lit("")))
    books = books.withColumn("updated_at", F.when(moved, now.cast("timestamp")).otherwise(F.col("updated_at"))).withColumn("series_search_text", F.coalesce("__text", F.lit(""))).drop("__text")

    links = lambda name, new, key, rules: upsert.upsert(upsert.remap(stored[name], mapped, "book_id", key), new, key, rules)
    tables = {
        "books": books, "book_sources": sources,
        "authors": upsert.upsert(stored["authors"], people, ["normalised_name"], {"name": upsert.fill, "birth_year": upsert.fill, "death_year": upsert.fill}),
        "book_authors": links("book_authors", author_links, ["book_id", "normalised_name"], {"position": upsert.fill}),
        "subjects": upsert.upsert(stored["subjects"], topics, ["normalised_name"], {"name": upsert.fill}),
        "book_subjects": upsert.remap(stored["book_subjects"], mapped, "book_id", ["book_id", "normalised_name"]).unionByName(topic_links).distinct(),
        "series": series.join(joined.select("series_key").distinct(), "series_key", "left_semi"),
        "book_series": joined.select("book_id", "series_key", "position", "confirmed"),
        "rejected_records": stored["rejected_records"].unionByName(rejected).distinct(),
    }
    return {name: _as(tables[name], schema) for name, schema in SCHEMAS.items()}


def _as(frame: DataFrame, schema: str) -> DataFrame:
    wanted = frame.sparkSession.createDataFrame([], schema).schema
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])


def _books(stored: DataFrame, replayed: DataFrame, mapped: DataFrame, identities: DataFrame, now: Column) -> DataFrame:
    """Books after recomputing the touched ones; a merged book is gone, an ISBN promotes a fallback identity in place.

    The accounts of a book are brought to its identity before they are merged, whatever each says itself.
    """
    agreed = merge.agree(replayed.join(identities, "book_id"), "identity")
    merged = merge.merge(agreed, "book_id", "identity")
    downloads = merge.first_download_count(replayed, "book_id").withColumnRenamed("download_count", "__downloads")
    merged = merged.join(downloads, "book_id", "left").withColumn("download_count", F.col("__downloads"))
    hashed = merged.withColumn("content_hash", merge.content_hash(merged))
    kept = stored.join(mapped, F.col("book_id") == F.col("old_id"), "left_anti")
    changed = merge.changed_only(kept, hashed, "book_id", now.cast("timestamp")).join(kept.select("book_id", "series_search_text"), "book_id", "left")
    columns = stored.columns
    fresh = changed.select(*[F.col(c) for c in columns])
    untouched = kept.join(fresh.select("book_id"), "book_id", "left_anti").select(*columns)
    return untouched.unionByName(fresh)
