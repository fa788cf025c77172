"""Queries of the corpus operators and the SQL counterparts of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import canonical, encode, linkage, mixing, names, stuffing, survivor
from quire.session import table


def _typed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    gutendex = canonical.entries_of(table(spark, sf_dir, "gutendex_page1"), "gutendex", "id", "subjects")
    openlibrary = canonical.entries_of(table(spark, sf_dir, "openlibrary_search"), "openlibrary", "ol_key", "subject")
    googlebooks = canonical.entries_of(table(spark, sf_dir, "googlebooks_volumes"), "googlebooks", "id", "volumeinfo.categories")
    return gutendex.unionByName(openlibrary).unionByName(googlebooks)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.canonical_terms(_typed_entries(spark, sf_dir), table(spark, sf_dir, "subject_terms"))


def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.unmatched(_typed_entries(spark, sf_dir), table(spark, sf_dir, "subject_terms"))


def _stored_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.spellings([
        table(spark, sf_dir, "gutendex_page1").select(F.explode("authors.name")),
        table(spark, sf_dir, "openlibrary_search").select(F.explode("author_name")),
        table(spark, sf_dir, "goodreads_autocomplete").select("author.name"),
    ])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.name_pairs(_stored_names(spark, sf_dir))


def p3_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.name_entities(_stored_names(spark, sf_dir))


def _open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.open_records(table(spark, sf_dir, "raw_book"), table(spark, sf_dir, "book_sources"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.matches(_open(spark, sf_dir)).select("record_a", "record_b")


def p4_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.link(_open(spark, sf_dir)).select("record_a", "record_b", "confidence")


def p4_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many candidates the model takes for matches and how many it refuses, by what the title, volume, derivation and author functions say."""
    said = ["title", "volume", "derived", "authors"]
    match = (F.col("confidence") >= linkage.THRESHOLD).alias("match")
    return linkage.link(_open(spark, sf_dir)).groupBy(match, *said).agg(F.count("*").alias("pairs"))


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "book_sources")
    return survivor.of_several(survivor.accounts(stored, table(spark, sf_dir, "raw_book")), stored)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors under the declared order of trust, whose weights no estimate replaces."""
    return survivor.survivors(_accounts(spark, sf_dir), survivor.TRUST)


def p6_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors by support, with reliabilities estimated from the claims."""
    return survivor.survivors(_accounts(spark, sf_dir))


def p6_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = survivor.discover(survivor.claims(_accounts(spark, sf_dir)))
    return spark.createDataFrame([(s, float(r)) for s, r in found.items()], "source string, reliability double")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_corpus(table(spark, sf_dir, "documents"))


def p7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's text, encoded and decoded again."""
    pieces = encode.piece_table(spark)
    ids = encode.encode_corpus(table(spark, sf_dir, "documents"))
    return encode.bound(ids, pieces, "doc_id", text=lambda p: encode.decode_ids(F.col("ids"), p))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")).select("doc_id", "tokens", "uses")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "mix_targets")
    return mixing.shares(mixing.mix(table(spark, sf_dir, "documents"), targets), targets)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffing.stuffed_pages(table(spark, sf_dir, "documents"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffing.stuffing_shares(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_unmatched": p2_unmatched,
    "p3_found": p3_found,
    "p3_entities": p3_entities,
    "p4_found": p4_found,
    "p4_confidence": p4_confidence,
    "p4_decisions": p4_decisions,
    "p6_found": p6_found,
    "p6_discovered": p6_discovered,
    "p6_reliability": p6_reliability,
    "p7_ids": p7_ids,
    "p7_round_trip": p7_round_trip,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_shares": p9_shares,
}

# What sellers and stand-ins say, written out for the SQL counterpart.
_SAYS = (
    "on demand", "on-demand", "working days", "business days", "is a facsimile", "altered the scan", "returns are accepted", "trusted seller", "order now", "may contain notes", "good condition",
    "nachdruck nach bestellung", "spuren des originals", "versand in ", "réimpression à la demande", "expédié sous", "impreso bajo demanda", "free shipping", "money-back",
)
_SELLER = " OR ".join(f"contains(lower(text), '{s}')" for s in _SAYS)
_NOTHING = "regexp_matches(lower(text), '^[^a-zà-ÿ]*(n/?a|tb[acd]|null|none|unknown|no (description|synopsis|summary|blurb).*|keine? (beschreibung|inhaltsangabe).*|pas de (description|résumé).*|sin (descripción|sinopsis|resumen).*|(description|synopsis|summary|blurb|details)( [^ ]+){0,2} (soon|follow|later|pending|unavailable|available)|see the publisher.?s? page.*|beschreibung folgt.*)[^a-zà-ÿ]*$')"
_BROKEN = "regexp_matches(lower(text), '([.]{2,}|…|[(](more|continued|cont[.]?|mehr|suite|fortsetzung)[)]|(read|see|show) (more|on)|weiterlesen|lire la suite|leer más)[]. )»”\"]*$')"

SQL: dict[str, str] = {
    "p6_found": f"""WITH facts AS (
      SELECT b.book_id, r.source, r.source_id, r.source_updated, r.page_count, r.publisher, r.published, trim(r.description, E' \\n\\t\\r') AS text,
             count(*) OVER (PARTITION BY b.book_id) AS n
      FROM book_sources b JOIN raw_book r ON b.source = r.source AND b.source_id = r.source_id),
    claims AS (
      SELECT *, 'description' AS field_name FROM facts
      WHERE len(regexp_split_to_array(text, '\\s+')) >= 3 AND regexp_matches(text, '[.!?]["”)]*$') AND NOT {_NOTHING}
        AND NOT {_BROKEN} AND NOT ({_SELLER})
      UNION ALL SELECT *, 'publisher' FROM facts
      WHERE trim(publisher) <> '' AND lower(trim(publisher, ' []?-.')) NOT IN ('', 'n/a', 'none', 'unknown', 'unknown publisher', 'publisher unknown', 'publisher not identified', 's.n')
      UNION ALL SELECT *, 'page_count' FROM facts WHERE page_count > 0
      UNION ALL SELECT *, 'published' FROM facts
      WHERE regexp_matches(published, '(^|[^0-9])(1[4-9][0-9]{{2}}|20[0-9]{{2}}|2100)([^0-9]|$)') OR regexp_full_match(published, 'M(CD|DC{{0,3}}|CM|M)?[CLXVI]*'))
    SELECT book_id, field_name, source, source_id FROM (
      SELECT *, row_number() OVER (PARTITION BY book_id, field_name ORDER BY
        CASE source WHEN 'goodreads' THEN 0 WHEN 'googlebooks' THEN 1 WHEN 'openlibrary' THEN 2 WHEN 'gutendex' THEN 3 ELSE 4 END,
        source_updated DESC NULLS LAST, source_id) AS place
      FROM claims WHERE n >= 2) WHERE place = 1""",
    "p7_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
