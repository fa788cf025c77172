"""Fields that drift between the files of a feed.

The documents of every file are taken apart into (file, field, type) facts, the counterpart of file footers for
line-delimited JSON. Per feed and field the files are ordered, ``lag`` finds where a field begins, ends or changes its
type, and beginnings are paired with endings that carry the same content in documents present in both files: those are
renames. From the renames an alias table follows, and from the alias table the casts of one consistent table.

Defined results: documents that are null, no JSON or no JSON object contribute no fields (the report counts their files
as existing); null and empty values give a field no type; a file whose predecessor (``file_seq`` one lower) is absent is
not compared; repeated documents change nothing; extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.session import check_columns, cut_lineage

#: Files of a feed that share one window task; the last file of a block is repeated as the first row of the next.
BLOCK = 512
#: Members of an object that hold its content, in this order.
CONTENT_KEYS = ("value", "name", "key", "title", "label", "id")
#: A catalogue of more distinct field names than this is an error: its alias table is held by the driver.
MOST_NAMES = 10_000


def explode_fields(lines: DataFrame) -> DataFrame:
    """One row per top-level field of each document: feed, file_seq, file_id, doc_key, field, value (variant)."""
    parsed = check_columns(lines, ["feed", "file_id", "file_seq", "doc"]).select(
        "feed", "file_id", "file_seq", F.from_json("doc", T.MapType(T.StringType(), T.VariantType())).alias("fields")
    )
    key = F.try_variant_get(F.element_at(F.map_filter("fields", lambda k, v: k == "key"), "key"), "$", "string")
    return parsed.select("feed", "file_id", "file_seq", key.alias("doc_key"), F.explode("fields").alias("field", "value"))


def value_type(value: Column) -> Column:
    """string, number, boolean, array of strings/numbers/objects, object; null where the value shows no type."""
    shape = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    number = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)"
    return (
        F.when(shape == "VOID", None)
        .when(shape == "STRING", F.when(F.length(text) > 0, F.lit("string")))
        .when(shape.rlike(number), F.lit("number"))
        .when(shape == "BOOLEAN", F.lit("boolean"))
        .when(shape.startswith("ARRAY<VOID"), None)
        .when(shape.startswith("ARRAY<STRING"), F.lit("array of strings"))
        .when(shape.rlike(r"^ARRAY<(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)"), F.lit("array of numbers"))
        .when(shape.startswith("ARRAY<OBJECT"), F.lit("array of objects"))
        .when(shape.startswith("ARRAY"), F.lit("array"))
        .when(shape.startswith("OBJECT"), F.lit("object"))
    )


def value_items(value: Column) -> Column:
    """The content of a value as an array of texts: an object's content member, an array's elements, or the scalar."""
    shape = F.schema_of_variant(value)
    text = F.to_json(value)
    member = lambda m: F.coalesce(*[m[k] for k in CONTENT_KEYS], F.array_join(F.map_values(m), " "))
    objects = F.transform(F.from_json(text, "array<map<string,string>>"), member)
    single = F.array(member(F.from_json(text, "map<string,string>")))
    return (
        F.when(shape == "VOID", None)
        .when(shape.startswith("ARRAY<OBJECT"), objects)
        .when(shape.startswith("ARRAY<VOID"), F.array().cast("array<string>"))
        .when(shape.startswith("ARRAY"), F.from_json(text, "array<string>"))
        .when(shape.startswith("OBJECT"), single)
        .otherwise(F.array(F.try_variant_get(value, "$", "string")))
    )


def content_form(value: Column) -> Column:
    """What a value says whatever its shape and separators: letters and digits of its items, one after another."""
    items = F.transform(value_items(value), lambda x: F.regexp_replace(x, r"^/[a-z_]+/", ""))
    joined = F.lower(F.regexp_replace(F.array_join(items, ""), r"[^\p{L}\p{M}\p{N}]", ""))
    return F.when(F.length(joined) > 0, joined)


def catalogue(fields: DataFrame) -> DataFrame:
    """One row per file and field: its type by majority of the values that show one (ties: the smaller name), null if none does."""
    counted = (
        fields.select("feed", "file_seq", "file_id", "field", value_type(F.col("value")).alias("type"))
        .groupBy("feed", "file_seq", "file_id", "field", "type")
        .count()
    )
    rank = F.struct((-F.col("count")).alias("n"), F.col("type").alias("t"))
    return counted.groupBy("feed", "file_seq", "file_id", "field").agg(
        F.sum("count").alias("n_docs"), F.min(F.when(F.col("type").isNotNull(), rank))["t"].alias("type")
    )


def lifespans(cat: DataFrame) -> DataFrame:
    """Per file and field its neighbours one ``file_seq`` before and after, by ``lag``/``lead`` within blocks of files.

    A feed's files are cut into blocks with the neighbouring file repeated on either side, so no task holds the whole
    history of a feed however long it is.
    """
    seq = F.col("file_seq").cast("long")
    block = F.floor(seq / BLOCK)
    spread = cat.withColumn(
        "block",
        F.explode(
            F.array_distinct(F.array(block, F.floor((seq - 1) / BLOCK), F.floor((seq + 1) / BLOCK)))
        ),
    ).withColumn("own", F.col("block") == block)
    w = Window.partitionBy("feed", "field", "block").orderBy("file_seq", "file_id")
    near = lambda f, d: F.when(f("file_seq", 1).over(w) == F.col("file_seq") + d, f("type", 1).over(w))
    return spread.select(
        "*",
        (F.lag("file_seq", 1).over(w) == F.col("file_seq") - 1).alias("has_before"),
        near(F.lag, -1).alias("type_before"),
        (F.lead("file_seq", 1).over(w) == F.col("file_seq") + 1).alias("has_after"),
    ).where("own").drop("own", "block")


def islands(spans: DataFrame) -> DataFrame:
    """Runs of consecutive files of a feed that hold a field with one type: feed, field, type, first_seq, last_seq.

    Runs are formed within blocks of files; a run that goes on from the block before is joined to it over one row per run
    and block, so no task holds a feed's files however many they are.
    """
    start = ~F.coalesce("has_before", F.lit(False)) | ~F.col("type_before").eqNullSafe(F.col("type"))
    block = F.floor(F.col("file_seq").cast("long") / BLOCK)
    w = Window.partitionBy("feed", "field", "block").orderBy("file_seq", "file_id")
    edges = spans.select("feed", "field", "file_seq", "file_id", "type", start.alias("starts"), block.alias("block"))
    local = edges.withColumn("run", F.sum(F.col("starts").cast("int")).over(w)).groupBy("feed", "field", "block", "run").agg(
        F.first("type").alias("type"), F.min("file_seq").alias("first_seq"), F.max("file_seq").alias("last_seq"), F.bool_or("starts").alias("starts")
    )
    across = Window.partitionBy("feed", "field").orderBy("first_seq", "run")
    joined = local.withColumn("whole", F.sum(F.col("starts").cast("int")).over(across))
    return joined.groupBy("feed", "field", "whole").agg(F.first("type").alias("type"), F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq")).drop("whole")


def changes(lines: DataFrame) -> DataFrame:
    """Each change between a file and the one before: file_id, change_kind, old_name, new_name."""
    return _changes(lines, cut_lineage(lifespans(catalogue(explode_fields(lines)))))


def _changes(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """The changes of ``lines``, given the lifespans of their fields."""
    files = check_columns(lines, ["feed", "file_seq", "file_id"]).groupBy("feed", "file_seq").agg(F.min("file_id").alias("file_id"))
    later = files.select("feed", (F.col("file_seq") + 1).alias("file_seq"), F.lit(True).alias("compared"))
    compared = cut_lineage(files.join(later, ["feed", "file_seq"]).select("feed", "file_seq", "file_id"))

    begun = spans.where("not coalesce(has_before, false)").select("feed", "file_seq", F.col("field").alias("new_name"), F.col("type").alias("new_type"))
    ended = spans.where("not coalesce(has_after, false)").select(
        "feed", (F.col("file_seq") + 1).alias("file_seq"), F.col("field").alias("old_name"), F.col("type").alias("old_type")
    )
    begun = begun.join(compared, ["feed", "file_seq"])
    ended = ended.join(compared, ["feed", "file_seq"])

    renames = cut_lineage(_renames(explode_fields(lines), begun, ended))
    moved = renames.select("feed", "file_seq", "file_id", F.lit("renamed").alias("change_kind"), "old_name", "new_name")
    moved_type = renames.where("old_type <> new_type").select(
        "feed", "file_seq", "file_id", F.lit("retyped").alias("change_kind"), "old_name", "new_name"
    )
    added = begun.join(renames.select("feed", "file_seq", "new_name"), ["feed", "file_seq", "new_name"], "left_anti").select(
        "feed", "file_seq", "file_id", F.lit("added").alias("change_kind"), F.lit("").alias("old_name"), "new_name"
    )
    removed = ended.join(renames.select("feed", "file_seq", "old_name"), ["feed", "file_seq", "old_name"], "left_anti").select(
        "feed", "file_seq", "file_id", F.lit("removed").alias("change_kind"), "old_name", F.lit("").alias("new_name")
    )
    retyped = spans.where("has_before and type <> type_before").select(
        "feed", "file_seq", "file_id", F.lit("retyped").alias("change_kind"), F.col("field").alias("old_name"), F.col("field").alias("new_name")
    )
    return moved.unionByName(moved_type).unionByName(added).unionByName(removed).unionByName(retyped)


def _renames(fields: DataFrame, begun: DataFrame, ended: DataFrame) -> DataFrame:
    """Endings and beginnings of one transition whose content is the same in every document that both files hold."""
    turning = begun.select("feed", "file_seq").intersect(ended.select("feed", "file_seq"))
    olds = cut_lineage(ended.join(turning, ["feed", "file_seq"], "left_semi"))
    news = cut_lineage(begun.join(turning, ["feed", "file_seq"], "left_semi"))
    # Documents are read once more, and of their fields only those that end or begin at a turning file, as hashed content.
    ending = olds.select("feed", (F.col("file_seq") - 1).alias("file_seq"), F.col("old_name").alias("field"), F.lit(True).alias("ending"))
    asked = ending.unionByName(news.select("feed", "file_seq", F.col("new_name").alias("field"), F.lit(False).alias("ending")))
    facts = fields.where("doc_key is not null").select("feed", "file_seq", F.xxhash64("doc_key").alias("doc"), "field", "value").join(asked, ["feed", "file_seq", "field"])
    told = facts.select("feed", (F.col("file_seq") + F.col("ending").cast("int")).alias("file_seq"), "ending", "doc", "field", F.xxhash64(content_form(F.col("value"))).alias("content"), content_form(F.col("value")).isNotNull().alias("some"))
    one = cut_lineage(told.where("some").groupBy("feed", "file_seq", "doc", "ending", "field").agg(F.min("content").alias("content")))
    side = lambda ending, name, content: one.where("ending" if ending else "not ending").select("feed", "file_seq", "doc", F.col("field").alias(name), F.col("content").alias(content))
    same = (
        side(True, "old_name", "old_content").join(side(False, "new_name", "new_content"), ["feed", "file_seq", "doc"])
        .groupBy("feed", "file_seq", "old_name", "new_name")
        .agg(F.count("*").alias("both"), F.count_if(F.col("old_content") == F.col("new_content")).alias("equal"))
        .where("both = equal")
    )
    by_old = Window.partitionBy("feed", "file_seq", "old_name").orderBy(F.desc("equal"), "new_name")
    by_new = Window.partitionBy("feed", "file_seq", "new_name").orderBy(F.desc("equal"), "old_name")
    paired = (
        same.withColumn("a", F.row_number().over(by_old)).withColumn("b", F.row_number().over(by_new)).where("a = 1 and b = 1")
        .select("feed", "file_seq", "old_name", "new_name")
    )
    return paired.join(olds.drop("file_id"), ["feed", "file_seq", "old_name"]).join(news, ["feed", "file_seq", "new_name"])


def alias_table(lines: DataFrame) -> dict[str, str]:
    """Field name -> canonical name, from all renames; names linked by renames form a family named by its commonest member.

    Held by the driver, as a schema is; more than ``MOST_NAMES`` names are an error.
    """
    spans = cut_lineage(lifespans(catalogue(explode_fields(lines))))
    usage = spans.groupBy("field").agg(F.sum("n_docs").alias("n")).limit(MOST_NAMES + 1).collect()
    if len(usage) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} distinct field names")
    uses = {r["field"]: r["n"] for r in usage}
    links = _changes(lines, spans).where("change_kind = 'renamed'").select("old_name", "new_name").distinct().collect()
    family = {name: {name} for name in uses}
    for old, new in links:
        if family[old] is not family[new]:
            family[old] |= family[new]
            for name in family[new]:
                family[name] = family[old]
    return {name: min(members, key=lambda m: (-uses[m], m)) for name, members in family.items()}


def consistent_table(lines: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """All documents under canonical names: file_id, line_no, then per family a column of one type.

    A family becomes array<string> if any of its values is an array, number if all its scalars read as numbers, boolean
    if all are booleans, else string; text with separators is split where the family is an array.
    """
    fields = explode_fields(lines)
    kinds = fields.select("field", value_type(F.col("value")).alias("type"), F.try_variant_get("value", "$", "double").isNull().alias("words"))
    facts = kinds.where("type is not null").groupBy("field", "type").agg(F.bool_or("words").alias("words")).collect()
    seen: dict[str, set[tuple[str, bool]]] = {}
    for field, kind, words in facts:
        seen.setdefault(aliases.get(field, field), set()).add((kind, words))
    source = lines.select("feed", "file_id", "file_seq", "line_no", "fetched_at", F.from_json("doc", T.MapType(T.StringType(), T.VariantType())).alias("fields"))
    columns = []
    for canonical in sorted(set(aliases.values())):
        names = sorted(n for n, c in aliases.items() if c == canonical)
        value = F.coalesce(*[F.try_element_at("fields", F.lit(n)) for n in names])
        kinds_of = seen.get(canonical, set())
        if any(k.startswith(("array", "object")) for k, _ in kinds_of):
            split = F.flatten(F.transform(value_items(value), lambda x: F.split(x, r"\s*[;|]\s*|\s+/\s+")))
            column = F.transform(split, lambda x: F.regexp_replace(x, r"^/[a-z_]+/", ""))
        elif kinds_of and all(k == "boolean" for k, _ in kinds_of):
            column = F.try_variant_get(value, "$", "boolean")
        elif kinds_of and not any(words for _, words in kinds_of):
            column = F.try_variant_get(value, "$", "double")
        else:
            column = F.try_variant_get(value, "$", "string")
        columns.append(column.alias("doc_key" if canonical == "key" else canonical))
    return source.select("feed", "file_id", "file_seq", "line_no", "fetched_at", *columns)
