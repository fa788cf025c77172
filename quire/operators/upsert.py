"""Idempotent loading: keyed upserts as new snapshots, and relationships kept in step with their accounts.

A snapshot is a full outer join of the stored and the incoming rows with a rule per column, so loading the same input
again changes nothing. Parquet has no MERGE; the writer publishes a snapshot by renaming a finished folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = Callable[[Column, Column], Column]


def overwrite(old: Column, new: Column) -> Column:
    return new


def keep(old: Column, new: Column) -> Column:
    return old


def fill(old: Column, new: Column) -> Column:
    """The stored value unless it is null."""
    return F.coalesce(old, new)


def refresh(old: Column, new: Column) -> Column:
    """The incoming value unless it is null."""
    return F.coalesce(new, old)


def add(old: Column, new: Column) -> Column:
    return F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))


def either(old: Column, new: Column) -> Column:
    """True once either is."""
    return F.coalesce(old, F.lit(False)) | F.coalesce(new, F.lit(False))


def upsert(stored: DataFrame, incoming: DataFrame, key: Sequence[str], rules: dict[str, Rule] | None = None, default: Rule = overwrite) -> DataFrame:
    """The snapshot after ``incoming`` (unique by ``key``): rows of one side stay as they are, rows of both follow
    ``rules``; columns a side lacks are null there. Rows with a null key are never equal and stay apart."""
    rules = rules or {}
    values = [c for c in dict.fromkeys([*stored.columns, *incoming.columns]) if c not in key]
    pad = lambda frame: frame.select(*[F.col(c) if c in frame.columns else F.lit(None).alias(c) for c in [*key, *values]])
    old = pad(stored).select(*key, F.struct(*values).alias("__old"))
    new = pad(incoming).select(*key, F.struct(*values).alias("__new"))
    both = old.join(new, list(key), "full_outer")
    pick = lambda c: (
        F.when(F.col("__new").isNull(), F.col(f"__old.{c}"))
        .when(F.col("__old").isNull(), F.col(f"__new.{c}"))
        .otherwise(rules.get(c, default)(F.col(f"__old.{c}"), F.col(f"__new.{c}")))
        .alias(c)
    )
    return both.select(*key, *[pick(c) for c in values])


def assign_ids(stored: DataFrame, fresh: DataFrame, key: str, identifier: str) -> DataFrame:
    """key -> identifier for stored and fresh keys: stored ones keep theirs, fresh ones follow the largest, in key order.

    Ids are dense: partitions are ranged by key, and each adds the sizes of those before it.
    """
    new = fresh.select(key).where(F.col(key).isNotNull()).distinct().join(stored.select(key), key, "left_anti")
    top = stored.agg(F.coalesce(F.max(identifier), F.lit(0)).alias("m")).first()["m"]
    from quire.session import cut_lineage

    ranged = cut_lineage(new.repartitionByRange(key).sortWithinPartitions(key).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()))
    sizes = {r["__part"]: r["n"] for r in ranged.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    starts, total = {}, top
    for part in sorted(sizes):
        starts[part] = total
        total += sizes[part]
    offsets = F.create_map(*[F.lit(x) for p, s in starts.items() for x in (p, s)]) if starts else F.lit(None).cast("map<int,bigint>")
    # monotonically_increasing_id counts from the partition's number shifted by 33 bits.
    place = F.col("__at") - F.shiftleft(F.col("__part").cast("long"), 33) + 1
    numbered = ranged.select(key, (F.element_at(offsets, F.col("__part")) + place).cast("long").alias(identifier))
    return stored.select(key, F.col(identifier).cast("long").alias(identifier)).unionByName(numbered)


def remap(links: DataFrame, mapping: DataFrame, column: str, key: Sequence[str]) -> DataFrame:
    """``links`` with ``column`` led through ``mapping`` (old_id, new_id), each link once: what merging two rows does to
    those that point at them. Of links that fall together the survivor's own stays, then the one with the smallest values."""
    led = links.join(mapping, F.col(column) == F.col("old_id"), "left")
    moved = led.withColumn("__moved", F.col("new_id").isNotNull()).withColumn(column, F.coalesce("new_id", column)).drop("old_id", "new_id")
    rest = [c for c in links.columns if c not in key]
    if not rest:
        return moved.select(*key).distinct()
    kept = moved.groupBy(*key).agg(F.min(F.struct("__moved", *rest)).alias("__kept"))
    return kept.select(*[F.col(c) if c in key else F.col(f"__kept.{c}") for c in links.columns])


def sync_people(accounts: DataFrame, by: str, name: Column) -> tuple[DataFrame, DataFrame]:
    """(people, links): every author of all accounts, the first spelling by account order winning per normalised name;
    lifespans are the first known; a link keeps the position of the first account that names it. Links only grow."""
    listed = accounts.select(by, "source", "source_id", F.posexplode("authors").alias("position", "author"))
    order = F.struct("source", "source_id", "position")
    named = listed.withColumn("normalised_name", name).where("normalised_name is not null").withColumn("o", order)
    known = lambda field: F.min_by(F.when(F.col(f"author.{field}").isNotNull(), F.col(f"author.{field}")), F.when(F.col(f"author.{field}").isNotNull(), F.col("o"))).alias(field)
    people = named.groupBy("normalised_name").agg(F.min_by("author.name", "o").alias("name"), known("birth_year"), known("death_year"))
    links = named.groupBy(by, "normalised_name").agg(F.min_by("position", "o").alias("position"))
    return people, links


def sync_subjects(accounts: DataFrame, by: str, name: Column) -> tuple[DataFrame, DataFrame]:
    """(subjects, links): the first spelling by account order per normalised subject."""
    listed = accounts.select(by, "source", "source_id", F.posexplode("subjects").alias("position", "subject"))
    named = listed.withColumn("normalised_name", name).where("normalised_name is not null")
    subjects = named.groupBy("normalised_name").agg(F.min_by("subject", F.struct("source", "source_id", "position")).alias("name"))
    return subjects, named.select(by, "normalised_name").distinct()


def sync_series(accounts: DataFrame, by: str, key: Column) -> DataFrame:
    """Per book and series: a confirmed membership beats an inferred one, then account order; position is the first known."""
    listed = accounts.select(by, "source", "source_id", F.explode("series").alias("member"))
    keyed = listed.withColumn("series_key", key).where("series_key is not null")
    order = F.struct((~F.coalesce("member.confirmed", F.lit(False))).alias("u"), F.col("source"), F.col("source_id"))
    told = F.col("member.position").isNotNull()
    return keyed.groupBy(by, "series_key").agg(
        F.min_by("member.name", order).alias("name"), F.min_by(F.when(told, F.col("member.position")), F.when(told, order)).alias("position"),
        F.bool_or(F.coalesce("member.confirmed", F.lit(False))).alias("confirmed"),
    )


def absorb_inferred(series: DataFrame) -> DataFrame:
    """Rows (series_key, normalised_name, position, confirmed, book_id): an inferred series of a confirmed one's name
    becomes that series; positions fill each other, confirmation stays."""
    sure = series.where("series_key like 'srcseries:%'").groupBy("normalised_name").agg(F.min("series_key").alias("survivor"))
    led = series.join(sure, "normalised_name", "left").withColumn("series_key", F.when(F.col("series_key").startswith("series:"), F.coalesce("survivor", "series_key")).otherwise(F.col("series_key")))
    order = F.struct((~F.col("confirmed")).alias("u"), F.col("position"))
    told = F.col("position").isNotNull()
    return led.groupBy("book_id", "series_key", "normalised_name").agg(
        F.min_by(F.when(told, F.col("position")), F.when(told, order)).alias("position"), F.bool_or("confirmed").alias("confirmed")
    )


def search_text(series: DataFrame, by: str) -> DataFrame:
    """A book's series names in one text: one display name per normalised name (the smallest), ordered by the latter."""
    one = series.groupBy(by, "normalised_name").agg(F.min("name").alias("name"))
    whole = F.array_sort(F.collect_list(F.struct("normalised_name", "name")))
    return one.groupBy(by).agg(F.array_join(F.transform(whole, lambda s: s["name"]), " ").alias("series_search_text"))


def reconcile_identities(routes: DataFrame, rounds: int = 40) -> DataFrame:
    """(book, root): connected components of books that accounts tie together (book_a, book_b), named by the smallest id.

    Alternating minimum propagation and pointer jumping over keyed joins; a round is one checkpoint, and whether a root moved
    is counted on what was just written. Jumping halves the depth, so ``rounds`` are enough for chains of 2 to their number.
    """
    from quire.session import cut_lineage

    a, b = routes.select(F.col("book_a").alias("x"), F.col("book_b").alias("y")), routes.select(F.col("book_b").alias("x"), F.col("book_a").alias("y"))
    edges = cut_lineage(a.unionByName(b).where("x is not null and y is not null").distinct())
    root = cut_lineage(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("root"), F.lit(True).alias("moved")))
    for _ in range(rounds):
        if root.where("moved").isEmpty():
            break
        near = edges.join(root.select(F.col("x").alias("y"), F.col("root").alias("near")), "y").groupBy("x").agg(F.min("near").alias("near"))
        spread = root.select("x", F.col("root").alias("before")).join(near, "x").withColumn("root", F.least("before", "near"))
        jumped = spread.join(root.select(F.col("x").alias("root"), F.col("root").alias("beyond")), "root", "left").withColumn("to", F.least("root", F.coalesce("beyond", "root")))
        root = cut_lineage(jumped.select("x", F.col("to").alias("root"), (F.col("to") != F.col("before")).alias("moved")))
    else:
        if not root.where("moved").isEmpty():
            raise RuntimeError(f"components not settled after {rounds} rounds")
    return root.select(F.col("x").alias("book"), "root")


def series_provenance(accounts: DataFrame, by: str, key: Column) -> tuple[DataFrame, DataFrame]:
    """(series_sources, book_series_sources): which account names which series, under which id, and what it says about a
    book's place in it; the position stays the text that the account gives."""
    listed = accounts.select(by, "source", "source_id", F.posexplode("series").alias("at", "member"))
    keyed = listed.withColumn("series_key", key).where("series_key is not null")
    first = F.struct("source_id", "at")
    names = keyed.groupBy("series_key", "source").agg(F.min_by("member.name", first).alias("name"), F.min("member.source_series_id").alias("source_series_id"))
    places = keyed.groupBy(by, "series_key", "source", "source_id").agg(
        F.min_by("member.position", F.when(F.col("member.position").isNotNull(), F.col("at"))).alias("position"), F.bool_or(F.coalesce("member.confirmed", F.lit(False))).alias("confirmed")
    )
    return names, places
