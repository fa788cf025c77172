"""Provider payloads mapped to one record schema, with a reason kept for each that cannot be.

Mappers are total: a payload that is no JSON object, lacks an identifier or title, or holds a field of the wrong shape
gives a ``rejection`` instead of values. JSON is read as variant, whose types are checked, since ``from_json`` coerces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import numbers, similarity, text
from quire.functions.bind import let

AUTHORS = "array<struct<name:string,source_author_id:string,birth_year:smallint,death_year:smallint>>"
SERIES = "array<struct<name:string,source_series_id:string,position:string,confirmed:boolean>>"
RAW = {
    "source_id": "string", "title": "string", "subtitle": "string", "authors": AUTHORS, "subjects": "array<string>", "isbns": "array<string>",
    "languages": "array<string>", "published": "string", "publisher": "string", "page_count": "int", "description": "string", "cover_url": "string",
    "download_count": "bigint", "rating_text": "string", "series": SERIES,
}
MOST_SUBJECTS = 50
MOST_DETAIL = 500
COVER = "https://covers.openlibrary.org/b/id/"


def _text(v: Column, path: str) -> Column:
    value = F.trim(F.try_variant_get(v, path, "string"))
    return F.when(F.length(value) > 0, value)


def _list(v: Column, path: str) -> Column:
    items = F.try_variant_get(v, path, "array<string>")
    return F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def _shape(v: Column, path: str) -> Column:
    """Outermost shape of a member: null where it is absent or null."""
    member = F.try_variant_get(v, path, "variant")
    return F.when(member.isNotNull() & ~F.is_variant_null(member), F.regexp_extract(F.schema_of_variant(member), r"^[A-Z]+", 0))


def _wrong(v: Column, **expected: str) -> Column:
    """The first member whose shape is not the expected one, as text; null if none."""
    checks = [
        F.when(_shape(v, f"$.{path.replace('__', '.')}") != shape, F.lit(f"{path.replace('__', '.')} is no {shape.lower()}")) for path, shape in expected.items()
    ]
    return F.coalesce(*checks)


def _record(rejection: Column, **fields: Column) -> Column:
    values = [fields.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in RAW.items()]
    missing = F.coalesce(
        rejection, F.when(fields["source_id"].isNull(), F.lit("no identifier")), F.when(fields["title"].isNull(), F.lit("no title"))
    )
    detail = F.when(missing.isNotNull(), F.struct(F.lit("invalid_record").alias("code"), F.substring(missing, 1, MOST_DETAIL).alias("detail")))
    return F.struct(F.when(missing.isNull(), F.struct(*values)).alias("raw"), detail.alias("rejection"))


def _people(names: Column, ids: Column | None = None) -> Column:
    """Names zipped with ids; whoever has no name is left out."""
    none = F.lit(None).cast("string")
    year = F.lit(None).cast("smallint")
    person = lambda n, i: F.struct(n.alias("name"), i.alias("source_author_id"), year.alias("birth_year"), year.alias("death_year"))
    zipped = F.transform(names, lambda n: person(n, none)) if ids is None else F.zip_with(names, ids, person)
    return F.filter(zipped, lambda a: F.length(F.trim(a["name"])) > 0)


def map_gutendex(v: Column) -> Column:
    people = F.try_variant_get(v, "$.authors", "array<struct<name:string,birth_year:int,death_year:int>>")
    none = F.lit(None).cast("string")
    authors = F.transform(
        F.filter(F.coalesce(people, F.array().cast("array<struct<name:string,birth_year:int,death_year:int>>")), lambda p: F.length(F.trim(p["name"])) > 0),
        lambda p: F.struct(
            F.trim(p["name"]).alias("name"), none.alias("source_author_id"),
            numbers.author_year(p["birth_year"].cast("string")).alias("birth_year"), numbers.author_year(p["death_year"].cast("string")).alias("death_year"),
        ),
    )
    return _record(
        _wrong(v, authors="ARRAY", subjects="ARRAY", languages="ARRAY", summaries="ARRAY"),
        source_id=_text(v, "$.id"), title=_text(v, "$.title"), authors=authors, subjects=_list(v, "$.subjects"), languages=_list(v, "$.languages"),
        description=F.try_element_at(_list(v, "$.summaries"), F.lit(1)), cover_url=_text(v, "$.formats['image/jpeg']"),
        download_count=F.try_variant_get(v, "$.download_count", "bigint"),
    )


def map_openlibrary(v: Column) -> Column:
    """Both dialects: a search document's fields where they are present and filled, else the dump edition's."""
    last = lambda k: F.element_at(F.split(k, "/"), -1)
    dump_keys = lambda path: F.transform(F.coalesce(F.try_variant_get(v, path, "array<struct<key:string>>"), F.array().cast("array<struct<key:string>>")), lambda x: last(x["key"]))
    either = lambda search, dump: let(_list(v, search), lambda s: F.when(F.size(s) > 0, s).otherwise(dump))
    statement = F.regexp_replace(F.regexp_replace(_text(v, "$.by_statement"), r"(?i)^(?:by|par|von|de)\b[\s.]*", ""), r"\.+\s*$", "")
    names = let(_list(v, "$.author_name"), lambda n: F.when(F.size(n) > 0, n).otherwise(F.array_compact(F.array(statement))))
    ids = either("$.author_key", dump_keys("$.authors"))
    year = F.when(_shape(v, "$.first_publish_year") != "BOOLEAN", _text(v, "$.first_publish_year"))
    cover_id = F.try_variant_get(v, "$.cover_i", "bigint")
    return _record(
        _wrong(v, author_name="ARRAY", isbn="ARRAY", subject="ARRAY", publisher="ARRAY"),
        source_id=last(_text(v, "$.key")), title=_text(v, "$.title"), subtitle=_text(v, "$.subtitle"), authors=_people(names, ids),
        subjects=F.slice(either("$.subject", _list(v, "$.subjects")), 1, MOST_SUBJECTS),
        isbns=either("$.isbn", F.concat(_list(v, "$.isbn_13"), _list(v, "$.isbn_10"))), languages=either("$.language", dump_keys("$.languages")),
        published=F.coalesce(year, _text(v, "$.publish_date")),
        publisher=F.try_element_at(either("$.publisher", _list(v, "$.publishers")), F.lit(1)),
        page_count=F.coalesce(F.try_variant_get(v, "$.number_of_pages_median", "int"), F.try_variant_get(v, "$.number_of_pages", "int")),
        description=_text(v, "$.description"), cover_url=F.when(cover_id > 0, F.concat(F.lit(COVER), cover_id.cast("string"), F.lit("-L.jpg"))),
    )


def map_googlebooks(v: Column) -> Column:
    kinds = "array<struct<type:string,identifier:string>>"
    numbered = F.coalesce(F.try_variant_get(v, "$.volumeInfo.industryIdentifiers", kinds), F.array().cast(kinds))
    isbns = F.transform(F.filter(numbered, lambda i: i["type"].isin("ISBN_10", "ISBN_13") & i["identifier"].isNotNull()), lambda i: i["identifier"])
    info = lambda name: _text(v, f"$.volumeInfo.{name}")
    return _record(
        _wrong(v, volumeInfo="OBJECT", volumeInfo__authors="ARRAY", volumeInfo__categories="ARRAY", volumeInfo__industryIdentifiers="ARRAY"),
        source_id=_text(v, "$.id"), title=info("title"), subtitle=info("subtitle"), authors=_people(_list(v, "$.volumeInfo.authors")),
        subjects=_list(v, "$.volumeInfo.categories"), isbns=isbns, languages=F.array_compact(F.array(info("language"))), published=info("publishedDate"),
        publisher=info("publisher"), page_count=F.try_variant_get(v, "$.volumeInfo.pageCount", "int"), description=info("description"),
        cover_url=F.coalesce(info("imageLinks.thumbnail"), info("imageLinks.smallThumbnail")),
    )


def map_goodreads(v: Column) -> Column:
    """A search card, with what enrichment stored beside it (``_detail``, ``_edition``) taking part in replay."""
    title, bare = _text(v, "$.title"), _text(v, "$.bookTitleBare")
    dirty = similarity.title_series(title)
    shown = F.coalesce(bare, dirty["bare"], title)
    told = similarity.aria_series(_text(v, "$._detail.series_label"))
    series_id = _text(v, "$._detail.series_id")
    member = lambda name, sid, position, sure: F.array(F.struct(name.alias("name"), sid.alias("source_series_id"), position.alias("position"), sure.alias("confirmed")))
    none = F.lit(None).cast("string")
    series = F.when(told.isNotNull(), member(told["name"], series_id, told["position"], series_id.isNotNull())).when(
        dirty.isNotNull(), member(dirty["name"], none, dirty["position"], F.lit(False))
    )
    names = F.array_distinct(F.array_compact(F.concat(F.array(_text(v, "$.author.name")), _list(v, "$.authors"))))
    author_ids = F.array(F.try_variant_get(v, "$.author.id", "string"))
    return _record(
        _wrong(v, author="OBJECT", description="OBJECT", _edition="OBJECT", _detail="OBJECT"),
        source_id=_text(v, "$.bookId"), title=shown, authors=_people(names, author_ids), isbns=F.array_distinct(F.array_compact(F.array(
            _text(v, "$._edition.isbn13"), _text(v, "$._edition.isbn"), _text(v, "$._detail.isbn")))),
        published=F.coalesce(_text(v, "$._edition.published"), _text(v, "$._detail.published")), publisher=_text(v, "$._edition.publisher"),
        page_count=F.try_variant_get(v, "$.numPages", "int"), description=text.html_text(_text(v, "$.description.html")),
        cover_url=similarity.cover(_text(v, "$.imageUrl")), rating_text=_text(v, "$.avgRating"), series=series,
    )


#: Source -> mapper; a new provider is one entry.
MAPPERS: dict[str, Callable[[Column], Column]] = {
    "gutendex": map_gutendex, "openlibrary": map_openlibrary, "googlebooks": map_googlebooks, "goodreads": map_goodreads,
}


def map_payloads(payloads: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """``payloads`` (source, ..., payload) with ``raw`` and ``rejection``, exactly one of which is null in each row.

    Each source's rows pass its own mapper as one branch of a union, so no row evaluates another dialect's paths.
    """
    parsed = payloads.withColumn("v", F.try_parse_json(F.col(payload)))
    whole = F.schema_of_variant("v").startswith("OBJECT")
    branches = [parsed.where(F.col("source") == s).withColumn("m", F.when(whole, mapper(F.col("v")))) for s, mapper in MAPPERS.items()]
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch)
    strange = parsed.where(F.col("source").isNull() | ~F.col("source").isin(*MAPPERS)).withColumn("m", F.lit(None).cast(out.schema["m"].dataType))
    out = out.unionByName(strange)
    known = F.coalesce(F.col("source").isin(*MAPPERS), F.lit(False))
    no_mapper = F.struct(F.lit("invalid_record").alias("code"), F.when(known, F.lit("payload is no object")).otherwise(F.lit("unknown source")).alias("detail"))
    return out.select(*payloads.columns, F.col("m.raw").alias("raw"), F.when(F.col("m").isNull(), no_mapper).otherwise(F.col("m.rejection")).alias("rejection"))


def split(mapped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejected): the two outputs of a mapper."""
    kept = mapped.where("rejection is null").drop("rejection")
    return kept, mapped.where("rejection is not null").drop("raw")
