"""Queries for drifting schemas and redelivered messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import drift, redelivery
from quire.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(table(spark, sf_dir, "openlibrary_search_raw")).select("file_id", "change_kind", "old_name", "new_name")


def p1_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "openlibrary_search_raw")
    return drift.consistent_table(lines, drift.alias_table(lines))


def p1_lifespans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = drift.lifespans(drift.catalogue(drift.explode_fields(table(spark, sf_dir, "openlibrary_search_raw"))))
    return drift.islands(spans).select("feed", "field", "first_seq", "last_seq", F.coalesce("type", F.lit("")).alias("type"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redelivery.message_duplicates(table(spark, sf_dir, "book_messages"))


def p5_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redelivery.first_deliveries(table(spark, sf_dir, "book_messages")).select("delivery_id", "event_id", "emitted_at")


def p5_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint ranges of broker offsets seen per topic and partition: the producer sequences of this table."""
    producer = F.concat_ws("/", F.col("topic"), F.col("partition_no").cast("string"))
    numbers = table(spark, sf_dir, "book_messages").where("topic is not null and partition_no is not null")
    return redelivery.seen_ranges(numbers.select(producer.alias("producer"), F.col("offset_no").alias("number")))


def p5_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of the later half of the batches that no range seen in the earlier half covers, each accepted once."""
    producer = F.concat_ws("/", F.col("topic"), F.col("partition_no").cast("string"))
    sent = table(spark, sf_dir, "book_messages").where("topic is not null and partition_no is not null and offset_no is not null and batch_id is not null")
    numbered = sent.select(producer.alias("producer"), F.col("offset_no").alias("number"), "delivery_id", (F.col("batch_id") % 2 == 0).alias("early"))
    accepted, _ = redelivery.accept_sequence(redelivery.seen_ranges(numbered.where("early")), numbered.where("not early"))
    return accepted.select("producer", "number", "delivery_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_table": p1_table,
    "p1_lifespans": p1_lifespans,
    "p5_found": p5_found,
    "p5_kept": p5_kept,
    "p5_ranges": p5_ranges,
    "p5_accepted": p5_accepted,
}

_UUID = r"""(
  SELECT delivery_id, event_id, emitted_at,
         replace(regexp_replace(regexp_replace(lower(trim(event_id)), '^\{(.*)\}$', '\1'), '^urn:uuid:', ''), '-', '') AS k
  FROM book_messages)"""
_VALID = "k IS NOT NULL AND regexp_full_match(k, '[0-9a-f]{32}')"

# Fields of each file with their type, by the statement of the problem.
_HELD = """facts AS (SELECT feed, file_seq, file_id, k AS field, json_extract(doc, '$."' || k || '"') AS v FROM (
        SELECT feed, file_seq, file_id, doc, unnest(json_keys(doc)) AS k FROM openlibrary_search_raw WHERE json_valid(doc) AND json_type(doc) = 'OBJECT')),
      typed AS (SELECT feed, file_seq, file_id, field, CASE json_type(v) WHEN 'VARCHAR' THEN CASE WHEN v::VARCHAR <> '""' THEN 'string' END WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object'
        WHEN 'UBIGINT' THEN 'number' WHEN 'BIGINT' THEN 'number' WHEN 'DOUBLE' THEN 'number' WHEN 'ARRAY' THEN CASE json_type(v, '$[0]') WHEN 'VARCHAR' THEN 'array of strings' WHEN 'OBJECT' THEN 'array of objects'
          WHEN 'UBIGINT' THEN 'array of numbers' WHEN 'BIGINT' THEN 'array of numbers' WHEN 'DOUBLE' THEN 'array of numbers' END END AS type FROM facts),
      held AS (SELECT feed, field, file_seq, file_id, arg_min(type, (-n, type)) FILTER (WHERE type IS NOT NULL) AS type FROM (SELECT feed, file_seq, file_id, field, type, count(*) AS n FROM typed GROUP BY ALL) GROUP BY ALL)"""

SQL: dict[str, str] = {
    "p1_found": f"""WITH {_HELD},
      files AS (SELECT feed, file_seq, min(file_id) AS file_id FROM openlibrary_search_raw GROUP BY 1, 2),
      compared AS (SELECT f.* FROM files f JOIN files e ON e.feed = f.feed AND e.file_seq = f.file_seq - 1),
      now AS (SELECT c.feed, c.file_seq, c.file_id, h.field, h.type FROM compared c JOIN held h ON h.feed = c.feed AND h.file_seq = c.file_seq),
      before AS (SELECT c.feed, c.file_seq, c.file_id, h.field, h.type FROM compared c JOIN held h ON h.feed = c.feed AND h.file_seq = c.file_seq - 1),
      come AS (SELECT * FROM now ANTI JOIN before USING (feed, file_seq, field)), gone AS (SELECT * FROM before ANTI JOIN now USING (feed, file_seq, field)),
      said AS (SELECT feed, file_seq, json_extract_string(doc, '$.key') AS doc_key, k AS field, json_extract(doc, '$."' || k || '"') AS v FROM (
        SELECT feed, file_seq, doc, unnest(json_keys(doc)) AS k FROM openlibrary_search_raw WHERE json_valid(doc) AND json_type(doc) = 'OBJECT')),
      parts AS (SELECT feed, file_seq, doc_key, field, CASE WHEN json_type(v) = 'ARRAY' THEN v::JSON[] ELSE [v] END AS items FROM said WHERE doc_key IS NOT NULL AND json_type(v) <> 'NULL'),
      told AS (SELECT DISTINCT feed, file_seq, doc_key, field, lower(regexp_replace(list_aggregate([regexp_replace(coalesce(CASE WHEN json_type(x) = 'OBJECT'
          THEN coalesce(x->>'value', x->>'name', x->>'key', x->>'title', x->>'label', x->>'id') ELSE x->>'$' END, ''), '^/[a-z_]+/', '') for x in items], 'string_agg', ''), '[^\\p{{L}}\\p{{M}}\\p{{N}}]', '', 'g')) AS content FROM parts),
      full_of AS (SELECT feed, file_seq, doc_key, field, min(content) AS content FROM told WHERE content <> '' GROUP BY ALL),
      met AS (SELECT g.feed, g.file_seq, g.file_id, g.field AS old_name, c.field AS new_name, g.type AS old_type, c.type AS new_type, count(*) AS n, count(*) FILTER (WHERE o.content = w.content) AS equal
        FROM gone g JOIN come c ON c.feed = g.feed AND c.file_seq = g.file_seq JOIN full_of o ON o.feed = g.feed AND o.file_seq = g.file_seq - 1 AND o.field = g.field
        JOIN full_of w ON w.feed = g.feed AND w.file_seq = g.file_seq AND w.field = c.field AND w.doc_key = o.doc_key GROUP BY ALL),
      moved AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed, file_seq, old_name ORDER BY equal DESC, new_name) AS a, row_number() OVER (PARTITION BY feed, file_seq, new_name ORDER BY equal DESC, old_name) AS b
        FROM met WHERE n = equal) WHERE a = 1 AND b = 1)
      SELECT file_id, 'renamed' AS change_kind, old_name, new_name FROM moved UNION ALL SELECT file_id, 'retyped', old_name, new_name FROM moved WHERE old_type <> new_type
      UNION ALL SELECT file_id, 'added', '', field FROM come c WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.feed = c.feed AND m.file_seq = c.file_seq AND m.new_name = c.field)
      UNION ALL SELECT file_id, 'removed', field, '' FROM gone g WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.feed = g.feed AND m.file_seq = g.file_seq AND m.old_name = g.field)
      UNION ALL SELECT n.file_id, 'retyped', n.field, n.field FROM now n JOIN before b USING (feed, file_seq, field) WHERE n.type <> b.type""",
    "p1_lifespans": f"""WITH {_HELD},
      begun AS (SELECT *, CASE WHEN lag(file_seq) OVER w = file_seq - 1 AND lag(type) OVER w IS NOT DISTINCT FROM type THEN 0 ELSE 1 END AS b FROM held WINDOW w AS (PARTITION BY feed, field ORDER BY file_seq, file_id))
      SELECT feed, field, min(file_seq) AS first_seq, max(file_seq) AS last_seq, coalesce(any_value(type), '') AS type FROM (
        SELECT *, sum(b) OVER (PARTITION BY feed, field ORDER BY file_seq, file_id) AS run FROM begun) GROUP BY feed, field, run""",
    "p5_accepted": """SELECT topic || '/' || partition_no AS producer, offset_no AS number, min(delivery_id) AS delivery_id FROM book_messages m
      WHERE topic IS NOT NULL AND partition_no IS NOT NULL AND offset_no IS NOT NULL AND batch_id % 2 <> 0
        AND NOT EXISTS (SELECT 1 FROM book_messages e WHERE e.topic = m.topic AND e.partition_no = m.partition_no AND e.offset_no = m.offset_no AND e.batch_id % 2 = 0) GROUP BY 1, 2""",
    "p5_found": f"""SELECT delivery_id FROM (
      SELECT delivery_id, row_number() OVER (PARTITION BY k ORDER BY emitted_at NULLS LAST, delivery_id) AS n
      FROM {_UUID} WHERE {_VALID}) WHERE n > 1""",
    "p5_kept": f"""SELECT delivery_id, event_id, emitted_at FROM (
      SELECT *, CASE WHEN {_VALID} THEN row_number() OVER (PARTITION BY k ORDER BY emitted_at NULLS LAST, delivery_id) ELSE 1 END AS n
      FROM {_UUID}) WHERE n = 1""",
    "p5_ranges": """SELECT producer, min(number) AS first, max(number) AS last FROM (
      SELECT producer, number, number - row_number() OVER (PARTITION BY producer ORDER BY number) AS island FROM (
        SELECT DISTINCT topic || '/' || partition_no AS producer, offset_no AS number FROM book_messages
        WHERE topic IS NOT NULL AND partition_no IS NOT NULL AND offset_no IS NOT NULL))
      GROUP BY producer, island""",
}
