"""Messages delivered more than once.

Two kinds of identifier are told apart. A *producer sequence* (a producer's name and a running number) is checked
against the disjoint ranges of numbers already seen from that producer: each uncovered number is accepted once and the
ranges are merged. Every other identifier, UUIDs included, is resolved by exact keyed lookup.

Rows of one message are never gathered: a message's kept delivery is a partial ``min``, and the others are found by an
anti-join on the unique delivery id, so a message that holds a third of all rows costs no task more than the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.session import check_columns

#: Notations of a UUID: plain, without hyphens, in braces, as URN; in any case, with white space around it.
UUID_FORM = r"^(?:urn:uuid:)?(?:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|[0-9a-f]{32})$"
#: Numbers of a producer that share one window task when ranges are formed.
RANGE_BLOCK = 1 << 20


def uuid_key(identifier: Column) -> Column:
    """The 32 hexadecimal digits of a UUID in whatever notation, else null."""
    text = F.lower(F.regexp_replace(identifier, r"(?U)^\s+|\s+$", ""))
    bare = F.regexp_replace(text, r"^\{(.*)\}$", "$1")
    return F.when(bare.rlike(UUID_FORM), F.regexp_replace(F.regexp_replace(bare, r"^urn:uuid:", ""), "-", ""))


def keyed_duplicates(deliveries: DataFrame, key: Column, order: list[str], delivery_id: str = "delivery_id") -> DataFrame:
    """Delivery ids to drop: all deliveries of a message but its first by ``order`` (nulls last), then by delivery id.

    Rows with a null key are nobody's duplicates. An input whose delivery ids repeat counts each id once.
    """
    keyed = deliveries.select(F.col(delivery_id).alias("delivery_id"), key.alias("message_key"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    keyed = keyed.where("message_key is not null")
    rank = F.struct(*[x for i in range(len(order)) for x in (F.col(f"o{i}").isNull().alias(f"n{i}"), F.col(f"o{i}"))], F.col("delivery_id"))
    kept = keyed.groupBy("message_key").agg(F.min(rank).alias("first")).select(F.col("first.delivery_id").alias("delivery_id"))
    return keyed.select("delivery_id").join(kept, "delivery_id", "left_anti")


def message_duplicates(deliveries: DataFrame) -> DataFrame:
    """``delivery_id`` of every redelivered message: same UUID, kept is the earliest ``emitted_at``, then the smallest id."""
    wanted = check_columns(deliveries, ["delivery_id", "event_id", "emitted_at"])
    return keyed_duplicates(wanted, uuid_key(F.col("event_id")), ["emitted_at"])


def sequence_identifier(identifier: Column) -> Column:
    """struct(producer, number) of an identifier such as ``evt-12``, else null."""
    form = r"^([A-Za-z_][A-Za-z0-9_.:]*)-([0-9]{1,18})$"
    trimmed = F.trim(identifier)
    number = F.try_to_number(F.regexp_extract(trimmed, form, 2), F.lit("9" * 18)).cast("long")
    return F.when(trimmed.rlike(form), F.struct(F.regexp_extract(trimmed, form, 1).alias("producer"), number.alias("number")))


def seen_ranges(numbers: DataFrame, producer: str = "producer", number: str = "number") -> DataFrame:
    """Disjoint, maximal ranges of the numbers seen per producer: producer, first, last.

    Numbers are made unique first and ranges are formed within blocks of ``RANGE_BLOCK`` numbers, so the longest sequence
    is spread over many tasks; see ``_across`` for how they are joined.
    """
    n = F.col(number).cast("long")
    unique = numbers.select(F.col(producer).alias("producer"), n.alias("number")).where("producer is not null and number is not null").distinct()
    w = Window.partitionBy("producer", "block").orderBy("number")
    local = (
        unique.withColumn("block", F.floor(F.col("number") / RANGE_BLOCK))
        .withColumn("island", F.col("number") - F.row_number().over(w))
        .groupBy("producer", "block", "island")
        .agg(F.min("number").alias("first"), F.max("number").alias("last"))
    )
    return _across(local.select("producer", "block", "first", "last"))


def _joined(ranges: DataFrame, by: list[str]) -> DataFrame:
    """Overlapping and adjacent ranges of a group as one."""
    w = Window.partitionBy(*by).orderBy("first", "last")
    reach = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.withColumn("opens", F.coalesce(F.col("first") > reach + 1, F.lit(True)).cast("int")).withColumn("run", F.sum("opens").over(w))
    return opened.groupBy(*by, "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def _across(local: DataFrame) -> DataFrame:
    """Ranges of blocks joined across them. Only ranges that touch a block's edge can go on in the next, at most two per
    block, and only these meet in one task per producer; all others are whole already."""
    low, high = F.col("block") * RANGE_BLOCK, (F.col("block") + 1) * RANGE_BLOCK - 1
    edge = (F.col("first") <= low) | (F.col("last") >= high)
    inner = local.where(~edge).select("producer", "first", "last")
    return inner.unionByName(_joined(local.where(edge).select("producer", "first", "last"), ["producer"]))


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Union of ranges per producer as disjoint, maximal ranges, formed block by block."""
    blocks = F.sequence(F.floor(F.col("first") / RANGE_BLOCK), F.floor(F.col("last") / RANGE_BLOCK))
    cut = ranges.select("producer", "first", "last", F.explode(blocks).alias("block")).select(
        "producer", "block", F.greatest("first", F.col("block") * RANGE_BLOCK).alias("first"), F.least("last", (F.col("block") + 1) * RANGE_BLOCK - 1).alias("last")
    )
    return _across(_joined(cut, ["producer", "block"]))


def accept_sequence(seen: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, ranges): numbers of ``batch`` (producer, number, delivery_id) that no seen range covers, each once by
    its smallest delivery id, and the ranges that cover both.

    A number is looked up by the last range that starts at or before it, within its own block of numbers: ranges are
    cut at block edges, so the lookup is an equi-join with a residual condition and never a range join over a producer.
    """
    cut = F.sequence(F.floor(F.col("first") / RANGE_BLOCK), F.floor(F.col("last") / RANGE_BLOCK))
    blocks = seen.select("producer", "first", "last", F.explode(cut).alias("block"))
    fresh = batch.where("producer is not null and number is not null").groupBy("producer", "number").agg(F.min("delivery_id").alias("delivery_id"))
    fresh = fresh.withColumn("block", F.floor(F.col("number") / RANGE_BLOCK))
    covered = (fresh["producer"] == blocks["producer"]) & (fresh["block"] == blocks["block"]) & fresh["number"].between(blocks["first"], blocks["last"])
    accepted = fresh.join(blocks, covered, "left_anti").select("producer", "number", "delivery_id")
    grown = merge_ranges(seen.select("producer", "first", "last").unionByName(seen_ranges(accepted)))
    return accepted, grown


def first_deliveries(deliveries: DataFrame) -> DataFrame:
    """The deliveries that remain, all columns: exactly one per message; rows without a usable identifier all remain."""
    return deliveries.join(message_duplicates(deliveries), "delivery_id", "left_anti")
