"""Byte-level BPE of a whole corpus by folds over Spark arrays.

Texts are cut into words by the tokenizer's pattern, each distinct word is encoded once, and the ids are put back:

* ``encode_words`` folds the ranked merges of a word: its bytes are an array of one-byte pieces, each step joins the
  leftmost adjacent pair of the lowest rank, and ranks come from a literal map (hashed into small buckets, since a
  lookup in a Spark map reads it from the start).
* The commonest words (at most ``HEAD_WORDS``) form a second literal map; words outside it are joined by key and only
  those travel with their document's id and position.

Defined results: null, empty and blank texts: null and '' give an empty list, blanks the ids of their white space.
Special token strings in a text are ordinary text. Every row is kept: duplicate documents are encoded alike, rows of one
doc_id or of none each by their own text.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.bind import let
from quire.operators import skew
from quire.session import check_columns, cut_lineage

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The tokenizer's white space: Unicode's White_Space, which Java's \s does not cover.
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The tokenizer's word pattern (a fixed value), with SPACE for \s.
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^" + SPACE + r"\p{L}\p{N}]++|[" + SPACE + r"]++$|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]"
)
BUCKETS = 1 << 14
#: Words held in the literal map of ready encodings; all others are joined by key.
HEAD_WORDS = 20_000
#: Words of more bytes are merged with a priority queue in Python: the fold copies its array at each step.
FOLD_BYTES = 160


def load_ranks(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> dict[bytes, int]:
    lines = (Path(folder) / vocabulary).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}


def literal_map(spark: SparkSession, entries: list[tuple[bytes, object]], value: pa.DataType, buckets: int = BUCKETS) -> Column:
    """array<map<binary, value>> by crc32 of the key, as a scalar subquery: one literal in whatever plan uses it.

    Bind it with ``bound``: Spark takes no subquery inside a lambda, but takes a lambda variable that holds one.
    """
    table: list[list[tuple[bytes, object]]] = [[] for _ in range(buckets)]
    for key, item in entries:
        table[zlib.crc32(key) % buckets].append((key, item))
    row = pa.table({"m": pa.array([table], type=pa.list_(pa.map_(pa.binary(), value)))})
    return spark.createDataFrame(row).scalar()


def bound(frame: DataFrame, literal: Column, *keep: str | Column, **columns: Callable[[Column], Column]) -> DataFrame:
    """``frame`` with ``keep`` and each of ``columns``, built from the literal bound to a lambda variable.

    The literal is referred to once, so the optimizer puts it in place of the helper column and no row carries it.
    """
    held = frame.select("*", literal.alias("__literal"))
    names = list(columns)
    built = lambda m: F.struct(*[columns[n](m).alias(n) for n in names])
    one = F.transform(F.array("__literal"), built)
    out = held.select(*keep, F.element_at(one, 1).alias("__built"))
    return out.select(*[c for c in out.columns if c != "__built"], *[F.col(f"__built.{n}").alias(n) for n in names])


def look_up(literal: Column, key: Column, buckets: int = BUCKETS) -> Column:
    return F.try_element_at(F.element_at(literal, (F.crc32(key) % buckets + 1).cast("int")), key)


def words_of(text: Column) -> Column:
    """The words of a text in order, as the tokenizer cuts them; together they are the text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), F.lit(0))


def fold_merges(word: Column, ranks: Column) -> Column:
    """Ids of a word (binary) by folding ranked merges over the array of its pieces.

    The state holds the pieces and beside each the rank of joining it with the next one, so that a step looks up two
    ranks only; a step without a rank left changes nothing.
    """
    none = F.lit(None).cast("int")
    rank = lambda pair: look_up(ranks, pair)
    size = F.length(word)
    pieces = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(word, i, F.lit(1)))
    firsts = F.transform(
        F.sequence(F.lit(1), size), lambda i: F.when(i < size, rank(F.substring(word, i, F.lit(2))))
    )
    start = F.struct(pieces.alias("p"), firsts.alias("r"))

    def step(state: Column, _: Column) -> Column:
        p, r = state["p"], state["r"]
        at = F.array_position(r, F.array_min(r)).cast("int")
        joined = F.concat(F.element_at(p, at), F.element_at(p, at + 1))
        n = F.size(p)
        left = F.when(at > 1, rank(F.concat(F.element_at(p, F.greatest(at - 1, F.lit(1))), joined)))
        right = F.when(at + 2 <= n, rank(F.concat(joined, F.element_at(p, F.least(at + 2, n)))))
        before, after = F.greatest(at - 2, F.lit(0)), F.greatest(n - at - 1, F.lit(0))
        merged = F.struct(
            F.concat(F.slice(p, F.lit(1), at - 1), F.array(joined), F.slice(p, at + 2, after)).alias("p"),
            F.concat(
                F.slice(r, F.lit(1), before), F.when(at > 1, F.array(left)).otherwise(F.array().cast("array<int>")), F.array(right), F.slice(r, at + 2, after)
            ).alias("r"),
        )
        return F.when(F.array_min(r).isNull(), state).otherwise(merged)

    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), start, step, lambda s: s["p"])
    return F.transform(folded, rank)


def _queue_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word, with a queue of candidate pairs."""
    import heapq

    n = len(word)
    end, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    while heap:
        _, i, stop = heapq.heappop(heap)
        if not live[i] or end[i] >= n or end[end[i]] != stop:
            continue
        j = end[i]
        live[j], end[i] = False, stop
        if stop < n:
            before[stop] = i
            offer(i)
        if i > 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def encode_words(words: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """word (string, distinct) -> ids; long words by ``_queue_merges``, all others by ``fold_merges``."""
    spark = words.sparkSession
    entries = list(load_ranks(folder, vocabulary).items())
    ranks = literal_map(spark, entries, pa.int32())
    binary = F.encode("word", "UTF-8")
    short = bound(words.where(F.octet_length("word") <= FOLD_BYTES), ranks, *words.columns, ids=lambda m: fold_merges(binary, m))

    # The ranks travel to the workers; the vocabulary's folder need exist where the driver runs only.
    known = spark.sparkContext.broadcast(dict(entries))

    def long_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            frame["ids"] = [_queue_merges(w.encode(), known.value) for w in frame["word"]]
            yield frame

    fields = [f for f in words.schema.fields if f.name != "ids"]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    long = words.where(F.octet_length("word") > FOLD_BYTES).mapInPandas(long_words, schema)
    return short.unionByName(long)


def encode_corpus(documents: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, ids: the token ids of each document's text, without special tokens; one row per input row."""
    spark = documents.sparkSession
    texts = check_columns(documents, ["doc_id", "text"])
    counted = texts.select(F.explode(words_of(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    encoded = cut_lineage(encode_words(counted.repartition("word"), folder, vocabulary))
    head = encoded.orderBy(F.desc("n"), "word").limit(head_words).select("word", "ids").collect()
    ready = literal_map(spark, [(r["word"].encode(), r["ids"]) for r in head], pa.list_(pa.int32()))

    def made(m: Column) -> Column:
        """The ids of each word, null for a word outside the head, and those words with their places."""
        known = lambda w: F.transform(w, lambda x: look_up(m, F.encode(x, "UTF-8")))
        gaps = lambda w, ids: F.filter(F.transform(w, lambda x, i: F.when(F.get(ids, i).isNull(), F.struct(i.alias("at"), x.alias("word")))), lambda g: g.isNotNull())
        return let(words_of(F.col("text")), lambda w: let(known(w), lambda ids: F.struct(ids.alias("parts"), gaps(w, ids).alias("gaps"))))

    # Texts are cut once; rows get a key of their own, since documents may share an id or have none.
    parts = bound(texts, ready, "doc_id", made=made).select(F.monotonically_increasing_id().alias("row"), "doc_id", "made.*")
    parts = cut_lineage(parts)
    whole = parts.where(F.size("gaps") == 0).select("doc_id", F.flatten("parts").alias("ids"))
    # Only documents with a gap are joined: the gaps are filled by word and come back per row as place -> ids.
    open_rows = parts.where(F.size("gaps") > 0)
    wanted = open_rows.select("row", F.explode("gaps").alias("gap")).select("row", F.col("gap.at").alias("at"), F.col("gap.word").alias("word"))
    rare = skew.salted_join(encoded.select("word", "ids"), wanted, ["word"]).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("at", "ids"))).alias("rare"))
    filled = F.transform("parts", lambda ids, i: F.coalesce(ids, F.try_element_at(F.col("rare"), i)))
    return whole.unionByName(open_rows.select("row", "doc_id", "parts").join(rare, "row").select("doc_id", F.flatten(filled).alias("ids")))


def piece_table(spark: SparkSession, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """array<binary>: the bytes of each token, by id, as a literal."""
    by_id = {rank: token for token, rank in load_ranks(folder, vocabulary).items()}
    row = pa.table({"p": pa.array([[by_id.get(i, b"") for i in range(max(by_id) + 1)]], type=pa.list_(pa.binary()))})
    return spark.createDataFrame(row).scalar()


def decode_ids(ids: Column, pieces: Column) -> Column:
    """Text of token ids: their binary pieces, concatenated and read as UTF-8."""
    joined = F.aggregate(ids, F.lit(b""), lambda acc, i: F.concat(acc, F.element_at(pieces, i + 1)))
    return F.decode(joined, "UTF-8")
