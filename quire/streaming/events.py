"""The event stream: envelopes decoded, records transformed, run boundaries observed, batches loaded once.

Batch and stream pass the same transformations: every function here takes a static or a streaming frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

VERSION = 1
KINDS = ("book.raw", "book.clean")
MARKER = "run.partition_complete"
MOST_DETAIL = 500


def decode(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON lines as envelope columns with ``decode_status``: ok, malformed, unsupported_version, unknown_type or invalid.

    The version is looked at first, and only a whole number is one; a time without an offset is invalid.
    """
    v = F.try_parse_json(F.col(value))
    known = lines.withColumn("v", v)
    version = F.try_variant_get("v", "$.schema_version", "variant")
    whole = F.schema_of_variant(version).isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    text = lambda name: F.try_variant_get("v", f"$.{name}", "string")
    emitted = text("emitted_at")
    aware = emitted.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$")
    kind = text("event_type")
    keyed = (F.length(text("source")) > 0) & (F.length(text("source_id")) > 0)
    bad = (
        (F.length(text("event_id")) == 0) | text("event_id").isNull() | text("run_id").isNull() | ~F.coalesce(aware, F.lit(False))
        | (kind.isin(*KINDS) & ~F.coalesce(keyed, F.lit(False))) | ((kind == "book.clean") & text("identity_key").isNull())
        | ((kind == MARKER) & (text("topic").isNull() | (F.coalesce(F.try_variant_get("v", "$.partition", "int"), F.lit(-1)) < 0)))
    )
    status = (
        F.when(F.col("v").isNull() | ~F.schema_of_variant("v").startswith("OBJECT"), "malformed")
        .when(~F.coalesce(whole, F.lit(False)) | (F.try_variant_get("v", "$.schema_version", "int") != VERSION), "unsupported_version")
        .when(kind.isNull() | ~kind.isin(*KINDS, MARKER), "unknown_type")
        .when(bad, "invalid")
        .otherwise("ok")
    )
    return known.select(
        *lines.columns, status.alias("decode_status"), text("event_id").alias("event_id"), text("run_id").alias("run_id"), kind.alias("event_type"),
        F.when(aware, emitted.try_cast("timestamp")).alias("emitted_at"), text("source").alias("source"), text("source_id").alias("source_id"),
        text("identity_key").alias("identity_key"), F.to_json(F.try_variant_get("v", "$.payload", "variant")).alias("payload"),
        text("topic").alias("topic"), F.try_variant_get("v", "$.partition", "int").alias("partition"),
    )


def partition_key() -> Column:
    """What a record is keyed by: a raw one by source and source id, a clean one by its identity."""
    return F.when(F.col("event_type") == "book.raw", F.concat_ws(":", "source", "source_id")).when(F.col("event_type") == "book.clean", F.col("identity_key"))


def message_status(messages: DataFrame) -> DataFrame:
    """Rows of a message table (columns of an envelope) with ``decode_status``, by the same rules as ``decode``."""
    payload = F.try_parse_json("payload")
    keyed = (F.length("source") > 0) & (F.length("source_id") > 0)
    status = (
        F.when(F.coalesce("schema_version", F.lit(-1)) != VERSION, "unsupported_version")
        .when(F.col("event_type").isNull() | ~F.col("event_type").isin(*KINDS, MARKER), "unknown_type")
        .when((F.col("event_type") != MARKER) & payload.isNull(), "malformed")
        .when((F.col("event_type") != MARKER) & ~F.coalesce(keyed, F.lit(False)), "invalid")
        .when((F.col("event_type") == "book.clean") & F.col("identity_key").isNull(), "invalid")
        .otherwise("ok")
    )
    return messages.withColumn("decode_status", status)


def dead_letter(code: Column, detail: Column, attempts: Column) -> Column:
    """The payload text with a ``_failure`` member; text that is no JSON object is kept under ``_text``."""
    v = F.try_parse_json("payload")
    members = F.try_variant_get(v, "$", "map<string,variant>")
    failure = F.parse_json(F.to_json(F.struct(code.alias("code"), F.substring(detail, 1, MOST_DETAIL).alias("detail"), attempts.alias("attempts"))))
    kept = F.when(members.isNotNull(), members).otherwise(F.create_map(F.lit("_text"), F.parse_json(F.to_json(F.struct(F.col("payload").alias("t"))))))
    return F.to_json(F.map_concat(F.map_filter(kept, lambda k, _: k != "_failure"), F.create_map(F.lit("_failure"), failure)))


def completed_partitions(markers: DataFrame, topology: DataFrame) -> DataFrame:
    """run_id, topic, expected, observed, complete: each partition's marker counts once; runs without a frozen topology
    are unknown and left out."""
    seen = markers.where("run_id is not null and topic is not null and partition is not null").groupBy("run_id", "topic").agg(F.count_distinct("partition").alias("observed"))
    joined = topology.join(seen, ["run_id", "topic"], "left")
    observed = F.coalesce("observed", F.lit(0))
    return joined.select("run_id", "topic", "expected", observed.alias("observed"), (observed >= F.col("expected")).alias("complete"))


def finalise(runs: DataFrame, completed: DataFrame) -> DataFrame:
    """Runs that are ``processing`` and whose every topic is complete become ``success``; others, done ones included, stay."""
    done = completed.groupBy("run_id").agg(F.bool_and("complete").alias("all_complete"))
    joined = runs.join(done, "run_id", "left")
    over = (F.col("status") == "processing") & F.coalesce("all_complete", F.lit(False))
    return joined.withColumn("status", F.when(over, "success").otherwise(F.col("status"))).drop("all_complete")


def tally(rows: DataFrame, by: list[str]) -> DataFrame:
    """Counts per outcome that add up over batches: loaded, parked, markers."""
    marker = F.col("event_type") == MARKER
    return rows.groupBy(*by).agg(
        F.count_if((F.col("decode_status") == "ok") & ~marker).alias("loaded"), F.count_if(F.col("decode_status") != "ok").alias("parked"),
        F.count_if((F.col("decode_status") == "ok") & marker).alias("markers"),
    )


def route(decoded: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, markers, parked) of decoded rows."""
    ok = decoded.where("decode_status = 'ok'")
    return ok.where(F.col("event_type") != MARKER), ok.where(F.col("event_type") == MARKER), decoded.where("decode_status <> 'ok'")


def read_events(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """A stream of JSON lines files; with the Kafka connector on the class path, ``read_topic`` reads a topic instead."""
    return spark.readStream.option("maxFilesPerTrigger", per_trigger).text(folder)


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest")
    return stream.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def consume(stream: DataFrame, load: Callable[[DataFrame, int], None], park: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Decode a stream and hand each micro-batch's records and failures on; the offset is committed after both.

    A batch may be delivered again after a failure, with the same id: ``load`` and ``park`` must be idempotent per id,
    as ``once`` makes them.
    """
    def batch(frame: DataFrame, batch_id: int) -> None:
        decoded = decode(frame).persist()
        try:
            records, markers, parked = route(decoded)
            load(records.unionByName(markers), batch_id)
            park(parked, batch_id)
        finally:
            decoded.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once(folder: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to a folder of its own, replacing what an earlier try left: effectively once."""
    def write(frame: DataFrame, batch_id: int) -> None:
        frame.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write


def deduplicated(decoded: DataFrame) -> DataFrame:
    """A stream's records, each event id once, however late a repeat comes: nothing is dropped by time.

    The state holds every id seen (keep it in RocksDB); a loader whose upserts are idempotent does not need this at all.
    """
    return decoded.dropDuplicates(["event_id"])
