"""Sources: dumps, exports, listings, manifests, pages; and the manifest sink."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import numbers
from quire.session import cut_lineage
from quire.sources.files import Files

EDITION = "/type/edition"


class TruncatedDumpError(OSError):
    """A dump that ends before its compressed stream does."""


def verify_checksum(path: str | os.PathLike[str], expected: str) -> None:
    """SHA-256 of a file, read in pieces; a mismatch is an error."""
    digest = hashlib.sha256()
    with open(path, "rb") as file:
        while piece := file.read(1 << 20):
            digest.update(piece)
    if digest.hexdigest() != expected.strip().lower():
        raise ValueError(f"{path}: checksum {digest.hexdigest()}, expected {expected}")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line (from 1), value: the lines of one file in order.

    A file is read as ranges in order; each range adds the lines of those before it, which one number per range tells.
    """
    lines = spark.read.option("ignoreCorruptFiles", "false").text(path)
    at = F.monotonically_increasing_id()
    marked = lines.select("value", F.spark_partition_id().alias("part"), (at - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias("at"), F.col("_metadata.file_block_start").alias("start"))
    with truncation_told():
        sizes = sorted((r["start"], r["part"], r["n"]) for r in marked.groupBy("start", "part").agg(F.count("*").alias("n")).collect())
    offsets, total = {}, 0
    for _, part, n in sizes:
        offsets[part] = total
        total += n
    before = F.element_at(F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair]), F.col("part")) if offsets else F.lit(0)
    return marked.select((before + F.col("at") + 1).cast("long").alias("line"), "value")


def slice_dump(spark: SparkSession, path: str, lines: int, target: str) -> None:
    """The first ``lines`` lines of a dump as one gzip text file in the folder ``target``, which must not exist."""
    part = numbered_lines(spark, path).where(F.col("line") <= lines)
    part.orderBy("line").select("value").coalesce(1).write.option("compression", "gzip").text(target)


def scan_dump(spark: SparkSession, path: str) -> DataFrame:
    """line, doc: rows of five tab-separated columns whose type is an edition's; malformed rows cost only themselves.

    A truncated or corrupt file fails the scan (``ignoreCorruptFiles`` is off), see ``guarded``.
    """
    columns = F.split("value", "\t", -1)
    rows = numbered_lines(spark, path).select("line", columns.alias("c")).where((F.size("c") == 5) & (F.get("c", F.lit(0)) == EDITION))
    return rows.select("line", F.try_parse_json(F.get("c", F.lit(4))).alias("doc")).where("doc is not null")


def dump_slice(candidates: DataFrame, lines: int, start_line: int = 1, most: int | None = None) -> tuple[DataFrame, dict[str, int | bool]]:
    """(slice, outcome): candidates (with ``line``) from ``start_line`` on, ``most`` of them, and where to go on: emitted,
    next_line, exhausted; ``lines`` is the number of lines of the dump. A cap that is just reached is not the end."""
    later = candidates.where(F.col("line") >= start_line).orderBy("line")
    part = later if most is None else later.limit(most)
    told = part.agg(F.count("*").alias("n"), F.max("line").alias("last")).first()
    capped = most is not None and told["n"] >= most
    return part, {"emitted": told["n"], "next_line": (told["last"] or start_line - 1) + 1 if capped else lines + 1, "exhausted": not capped}


@contextmanager
def truncation_told() -> Iterator[None]:
    """What a broken compressed stream raises inside becomes ``TruncatedDumpError``."""
    try:
        yield
    except Exception as error:
        if any(word in str(error) for word in ("EOFException", "ZipException", "unexpected end of", "not in gzip", "incorrect header", "Unexpected end of")):
            raise TruncatedDumpError(str(error).splitlines()[0][:300]) from error
        raise


def guarded(frame: DataFrame) -> DataFrame:
    """Materialise a scan in the shared folder, so that a truncated file fails here and not amid its use."""
    with truncation_told():
        return cut_lineage(frame)


def _strings(doc: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(doc, path, "array<string>"), F.array().cast("array<string>"))


def _keys(doc: Column, path: str) -> Column:
    keyed = F.coalesce(F.try_variant_get(doc, path, "array<struct<key:string>>"), F.array().cast("array<struct<key:string>>"))
    return F.array_compact(F.transform(keyed, lambda k: F.element_at(F.split(k["key"], "/"), -1)))


def dump_candidates(rows: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """Candidates of a dump: a title, a key, and an author's name or a valid ISBN; of the allowed languages or of none told."""
    doc = F.col("doc")
    title = F.trim(F.try_variant_get(doc, "$.title", "string"))
    authors = F.array_compact(F.array(F.regexp_replace(F.regexp_replace(F.trim(F.try_variant_get(doc, "$.by_statement", "string")), r"(?i)^(?:by|par|von|de)\b[\s.]*", ""), r"\.+$", "")))
    listed = rows.select(
        *[c for c in ("line",) if c in rows.columns], F.element_at(F.split(F.try_variant_get(doc, "$.key", "string"), "/"), -1).alias("candidate_key"), title.alias("title"),
        F.filter(authors, lambda a: F.length(a) > 0).alias("authors"), numbers.isbns13(F.concat(_strings(doc, "$.isbn_13"), _strings(doc, "$.isbn_10"))).alias("isbns"),
        F.try_element_at(_keys(doc, "$.works"), F.lit(1)).alias("work_key"), _keys(doc, "$.languages").alias("languages"), F.to_json(doc).alias("discovery_payload"),
    )
    usable = (F.length("candidate_key") > 0) & (F.length("title") > 0) & ((F.size("authors") > 0) | (F.size("isbns") > 0))
    kept = listed.where(usable)
    if languages:
        kept = kept.where((F.size("languages") == 0) | F.arrays_overlap("languages", F.array(*[F.lit(x) for x in languages])))
    return kept


def scan_export(spark: SparkSession, path: str) -> DataFrame:
    """record: the objects of a JSON array, or of the first list-valued member of one object; other items are skipped."""
    whole = spark.read.option("wholetext", "true").text(path).select(F.try_parse_json("value").alias("v"))
    listed = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array().cast("array<variant>"))
    members = F.try_variant_get("v", "$", "map<string,variant>")
    lists = F.filter(F.transform(F.map_entries(members), lambda e: F.try_variant_get(e["value"], "$", "array<variant>")), lambda a: a.isNotNull())
    items = F.when(F.schema_of_variant("v").startswith("ARRAY"), listed).otherwise(F.coalesce(F.try_element_at(lists, F.lit(1)), F.array().cast("array<variant>")))
    rows = whole.select(F.posexplode(items).alias("record_no", "record"))
    return rows.where(F.schema_of_variant("record").startswith("OBJECT"))


def export_payload(record: Column) -> Column:
    """An export's row in the provider's dialect, as JSON text; null without an id or a title."""
    ident = F.trim(F.try_variant_get(record, "$.goodreadsId", "string"))
    title = F.trim(F.try_variant_get(record, "$.title", "string"))
    one = F.try_variant_get(record, "$.author", "string")
    names = F.coalesce(F.try_variant_get(record, "$.author", "array<string>"), F.array_compact(F.array(one)))
    authors = F.array_distinct(F.filter(F.transform(names, lambda x: F.trim(x)), lambda a: F.length(a) > 0))
    made = F.to_json(F.struct(
        ident.alias("bookId"), title.alias("title"), F.when(F.size(authors) > 0, F.struct(authors[0].alias("name"))).alias("author"), F.when(F.size(authors) > 0, authors).alias("authors"),
        F.try_variant_get(record, "$.rating", "string").alias("avgRating"), F.try_variant_get(record, "$.ratingCount", "bigint").alias("ratingsCount"),
        F.try_variant_get(record, "$.coverUrl", "string").alias("imageUrl"), F.try_variant_get(record, "$.goodreadsUrl", "string").alias("bookUrl"),
        F.struct(F.try_variant_get(record, "$.sourceFile", "string").alias("source_file"), F.try_variant_get(record, "$.position", "int").alias("position")).alias("_export"),
    ))
    return F.when((F.length(ident) > 0) & (F.length(title) > 0), made)


def export_profile(records: DataFrame) -> DataFrame:
    """One row: total, usable, missing_id, missing_title, and the first twelve member names in order."""
    ident = F.length(F.trim(F.try_variant_get("record", "$.goodreadsId", "string"))) > 0
    title = F.length(F.trim(F.try_variant_get("record", "$.title", "string"))) > 0
    has_id, has_title = F.coalesce(ident, F.lit(False)), F.coalesce(title, F.lit(False))
    counted = records.agg(F.count("*").alias("total"), F.count_if(has_id & has_title).alias("usable"), F.count_if(~has_id).alias("missing_id"), F.count_if(~has_title).alias("missing_title"))
    # Distinct names are found before anything is gathered, and twelve of them are kept.
    names = records.select(F.explode(F.json_object_keys(F.to_json("record"))).alias("name")).distinct().orderBy("name").limit(12)
    members = names.agg(F.array_sort(F.collect_list("name")).alias("members"))
    return counted.withColumn("members", members.scalar())


def explain_profile(profile: DataFrame) -> DataFrame:
    """message: what an operator is told about an export without usable records; no row if it has some."""
    seen = F.array_join("members", ", ")
    reason = F.when(F.col("total") == 0, F.lit("the export holds no records")).when(
        F.col("usable") == 0, F.concat(F.lit("none of "), F.col("total").cast("string"), F.lit(" records has an id and a title; members seen: "), seen)
    )
    return profile.select(reason.alias("message")).where("message is not null")


def listing_candidates(pages: DataFrame, most_authors: int = 5, most_languages: int = 3) -> DataFrame:
    """Candidates of recorded listing pages (gutendex_page1's columns): those with a title and an author."""
    names = F.filter(F.transform("authors", lambda a: F.trim(a["name"])), lambda n: F.length(n) > 0)
    usable = pages.where((F.length(F.trim("title")) > 0) & (F.size(names) > 0) & F.col("id").isNotNull())
    return usable.select(
        F.concat(F.lit("gutendex:"), F.col("id").cast("string")).alias("candidate_key"), F.trim("title").alias("title"), F.slice(names, 1, most_authors).alias("authors"),
        F.slice(F.coalesce("languages", F.array().cast("array<string>")), 1, most_languages).alias("languages"),
    )


def resume(records: DataFrame, position: str, start: int, most: int) -> DataFrame:
    """Records from position ``start`` on, ``most`` of them by position."""
    return records.where(F.col(position) >= start).orderBy(position).limit(most)


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Candidates of a manifest of JSON lines; blank lines are skipped."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def write_manifest(candidates: DataFrame, path: str, order: str) -> str:
    """Candidates as JSON lines with sorted members, ordered, in one file that appears whole or not at all.

    Returns the file's SHA-256. The part files, on whatever file system the path names, are concatenated as a stream.
    """
    columns = F.to_json(F.struct(*[F.col(c) for c in sorted(candidates.columns)]))
    files, parts = Files(candidates.sparkSession), f"{path}.parts"
    try:
        candidates.orderBy(order).select(columns.alias("value")).write.mode("overwrite").text(parts)
        return files.concatenate([name for name in files.names(parts) if name.rsplit("/", 1)[-1].startswith("part-")], path)
    finally:
        files.delete(f"{path}.partial")
        files.delete(parts)


def source_frame(spark: SparkSession, manifest: str, dump: str, languages: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Candidates of the manifest if there is one, else of the dump, else an error; ``most`` of them by their order."""
    files = Files(spark)
    if files.exists(manifest):
        found = read_manifest(spark, manifest, "candidate_key string, title string, authors array<string>, isbns array<string>, languages array<string>")
    elif files.exists(dump):
        found = dump_candidates(scan_dump(spark, dump), languages)
    else:
        raise FileNotFoundError(f"neither {manifest} nor {dump}")
    return found if most is None else found.orderBy("line" if "line" in found.columns else "candidate_key").limit(most)
