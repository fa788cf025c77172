"""The two consumers of the event stream: raw records become clean ones, clean ones are loaded.

Each micro-batch passes the same set operations as a batch would. Effects come before the commit of the offset, so a batch
may come again: sinks write a folder per batch that a retry replaces, and loading twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators import mapping, merge
from quire.plans.load import Catalogue
from quire.session import cut_lineage
from quire.streaming import events


def transform(records: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(clean, parked) of decoded raw records: mapped and made canonical, or the failure that a dead letter tells.

    ``clean`` has an envelope's columns with the identity the record is keyed by; ``parked`` has code and detail.
    """
    raw = records.where("event_type = 'book.raw'").withColumn("raw_payload", F.col("payload"))
    # The payload is read once for all that follows from it.
    mapped = cut_lineage(mapping.map_payloads(raw.select("event_id", "run_id", "source", "raw_payload")))
    kept, refused = mapping.split(mapped)
    flat = kept.select("event_id", "run_id", "source", "raw_payload", "raw.*").withColumn("goodreads_average_rating", F.col("rating_text").try_cast("decimal(3,2)"))
    clean = merge.canonicalise(flat)
    good = clean.where("rejection is null").select(
        F.lit(events.VERSION).alias("schema_version"), F.concat(F.col("event_id"), F.lit(":clean")).alias("event_id"), "run_id", F.lit("book.clean").alias("event_type"),
        now.alias("emitted_at"), "source", "source_id", "identity_key", F.col("raw_payload").alias("payload"),
    )
    told = lambda frame: frame.select("event_id", "run_id", "source", F.col("raw_payload").alias("payload"), F.col("rejection.code").alias("code"), F.col("rejection.detail").alias("detail"))
    return good, told(refused).unionByName(told(clean.where("rejection is not null")))


def envelope_lines(clean: DataFrame) -> DataFrame:
    """value: a JSON line per event, as ``events.decode`` reads it."""
    shown = F.struct(
        "schema_version", "event_id", "run_id", "event_type", F.date_format("emitted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("emitted_at"), "source", "source_id", "identity_key",
        F.parse_json("payload").alias("payload"),
    )
    return clean.select(F.to_json(shown).alias("value"))


def letter_lines(parked: DataFrame, attempts: int = 1) -> DataFrame:
    """value: a dead letter per failure, the payload with its ``_failure``."""
    return parked.select(events.dead_letter(F.col("code"), F.col("detail"), F.lit(attempts)).alias("value"))


def write_lines(lines: DataFrame, folder: str, batch_id: int) -> None:
    """JSON lines of one batch in a folder of its own: written again, they replace what an earlier try left."""
    lines.write.mode("overwrite").text(f"{folder}/batch={batch_id}")


def run_transform(stream: DataFrame, clean: str, letters: str, checkpoint: str, now: Column) -> StreamingQuery:
    """Consume raw events until none is left: clean ones to ``clean``, markers passed on with them, failures to ``letters``."""

    def batch(frame: DataFrame, batch_id: int) -> None:
        records, markers, parked = events.route(cut_lineage(events.decode(frame)))
        good, bad = transform(records, now)
        passed = markers.select("value")
        write_lines(envelope_lines(good).unionByName(passed), clean, batch_id)
        broken = parked.select(F.coalesce("payload", "value").alias("payload"), F.col("decode_status").alias("code"), F.lit("not usable").alias("detail"))
        write_lines(letter_lines(bad.select("payload", "code", "detail").unionByName(broken)), letters, batch_id)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_load(stream: DataFrame, catalogue: Catalogue, letters: str, checkpoint: str, now: Column) -> StreamingQuery:
    """Consume clean events until none is left, a micro-batch a load; a batch without records publishes nothing."""

    def batch(frame: DataFrame, batch_id: int) -> None:
        records, _, parked = events.route(cut_lineage(events.decode(frame)))
        books = records.where("event_type = 'book.clean'").select("source", F.col("payload").alias("raw_payload"), F.lit(None).cast("timestamp").alias("source_updated"))
        if not books.isEmpty():
            catalogue.load(books, now)
        broken = parked.select(F.coalesce("payload", "value").alias("payload"), F.col("decode_status").alias("code"), F.lit("not usable").alias("detail"))
        write_lines(letter_lines(broken), letters, batch_id)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def freeze_topology(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """(run_id, topic, expected) after ``wanted``: what is frozen for a run and topic never changes."""
    fresh = wanted.groupBy("run_id", "topic").agg(F.max("expected").alias("expected")).join(stored.select("run_id", "topic"), ["run_id", "topic"], "left_anti")
    return stored.select("run_id", "topic", "expected").unionByName(fresh)


def sweep(runs: DataFrame, markers: DataFrame, topology: DataFrame) -> DataFrame:
    """Runs after a restart: those still processing whose markers are all there already are finished."""
    return events.finalise(runs, events.completed_partitions(markers, topology))


def read_lines(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """A stream of the lines that another consumer wrote, batch by batch."""
    return spark.readStream.option("maxFilesPerTrigger", per_trigger).option("recursiveFileLookup", "true").text(folder)
