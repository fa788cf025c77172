"""Search over the catalogue: weighted terms, trigrams, titles of like words, keyset pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import similarity
from quire.operators.skew import salted_join

#: Weights of the fields' terms (fixed values).
WEIGHTS = {"title": 1.0, "series_search_text": 1.0, "subtitle": 0.4, "description": 0.2}
#: Commonest title words, under which pairs meet last (fixed value). Any number gives the same pairs.
COMMON = 2_000


def terms(column: Column) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def term_table(books: DataFrame, identifier: str, weights: dict[str, float] | None = None) -> DataFrame:
    """identifier, term, weight: a term's weight is the sum over the fields it occurs in, each field once."""
    fields = {f: w for f, w in (weights or WEIGHTS).items() if f in books.columns}

    def weighed(field: str, weight: float) -> Column:
        own = F.array_distinct(F.coalesce(terms(F.col(field)), F.array().cast("array<string>")))
        return F.transform(own, lambda t: F.struct(t.alias("term"), F.lit(weight).alias("weight")))

    listed = [weighed(f, w) for f, w in fields.items()]
    rows = books.select(identifier, F.explode(F.concat(*listed)).alias("t")).select(identifier, "t.term", "t.weight")
    return rows.groupBy(identifier, "term").agg(F.sum("weight").alias("weight"))


def search(table: DataFrame, identifier: str, query: list[str], limit: int) -> DataFrame:
    """The best ``limit`` rows that hold every term of the query: identifier, score."""
    wanted = sorted({t.lower() for t in query})
    hits = table.where(F.col("term").isin(wanted)).groupBy(identifier).agg(F.sum("weight").alias("score"), F.count("*").alias("n"))
    return hits.where(F.col("n") == len(wanted)).select(identifier, "score").orderBy(F.desc("score"), identifier).limit(limit)


def trigrams(column: Column) -> Column:
    """Distinct trigrams of the words of a text, each word padded with two blanks before and one after."""
    padded = F.transform(terms(column), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    of = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(padded, of)))


def trigram_table(books: DataFrame, identifier: str, column: str) -> DataFrame:
    """gram, identifier, n: an inverted index of the trigrams of each text, of which it has ``n``.

    Rows are ranged by gram: written as a table, each file holds few grams, and a lookup reads only those of its query.
    """
    listed = books.select(identifier, trigrams(F.col(column)).alias("grams")).where(F.size("grams") > 0)
    rows = listed.select(F.explode("grams").alias("gram"), identifier, F.size("grams").alias("n"))
    return rows.repartitionByRange("gram", identifier).sortWithinPartitions("gram")


def trigram_lookup(table: DataFrame, identifier: str, query: str, floor: float) -> DataFrame:
    """identifier, similarity (shared trigrams over all of both) of the texts of a ``trigram_table`` at least ``floor``, which
    is above 0, like the query. A query without letters finds nothing."""
    if floor <= 0:
        raise ValueError("a floor above 0")
    asked = table.sparkSession.range(1).select(trigrams(F.lit(query)).alias("g")).first()["g"]
    met = table.where(F.col("gram").isin(asked)).groupBy(identifier).agg(F.count("*").alias("shared"), F.max("n").alias("n"))
    near = F.col("shared") / (F.col("n") + len(asked) - F.col("shared"))
    return met.select(identifier, near.alias("similarity")).where(F.col("similarity") >= floor)


def like_titles(asked: DataFrame, known: DataFrame, floor: float, letters: int = 3) -> DataFrame:
    """t, a, u, b: the pairs of sorted word sets of a title and an author (``t, a`` of ``asked``, ``u, b`` of ``known``), each once,
    whose titles' F1 is at least ``floor``, which is above 0, and whose authors share a word of more than ``letters`` letters.

    A set of n words has floor / (2 - floor) * n words or more in common with any set of that F1. So, in one order of all words,
    the two share one of the words that are first in each, as many as may be missing and one. The order is from rare words to
    common ones; pairs meet under such a word and one of the author's.
    """
    if floor <= 0:
        raise ValueError("a floor above 0")
    left, right = asked.select("t", "a").distinct(), known.select("u", "b").distinct()
    words = left.select(F.explode("t").alias("w")).unionAll(right.select(F.explode("u").alias("w")))
    common = F.broadcast(words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(COMMON))

    def keyed(sets: DataFrame, title: str, author: str) -> DataFrame:
        listed = sets.select(title, author, F.explode(title).alias("w")).join(common, "w", "left")
        place = F.row_number().over(Window.partitionBy(title, author).orderBy(F.coalesce("n", F.lit(0)), "w"))
        missing = F.size(title) - F.ceil(F.size(title) * (floor / (2 - floor)) - 1e-9)
        first = listed.withColumn("i", place).where(F.col("i") <= missing + 1)
        return first.select(title, author, "w", F.explode(F.filter(author, lambda x: F.length(x) > letters)).alias("by"))

    met = salted_join(keyed(left, "t", "a"), keyed(right, "u", "b"), ["by", "w"])
    return met.where(similarity.token_f1(F.col("t"), F.col("u")) >= floor).select("t", "a", "u", "b").distinct()


def keyset_page(books: DataFrame, column: str, identifier: str, after: tuple[str, int] | None, size: int) -> DataFrame:
    """The next ``size`` rows by (lower(column), identifier) after a position; nulls are on no page."""
    order = F.lower(F.col(column)).alias("sort_key")
    rows = books.where(F.col(column).isNotNull()).select(order, identifier)
    if after is not None:
        rows = rows.where((F.col("sort_key") > after[0]) | ((F.col("sort_key") == after[0]) & (F.col(identifier) > after[1])))
    return rows.orderBy("sort_key", identifier).limit(size)
