from pyspark.sql import functions as F

import base64
import random

import pytest

from quire.llm import encode

tiktoken = pytest.importorskip("tiktoken")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encode.load_ranks(), special_tokens={})


def test_ids_and_round_trip_against_a_library(spark, reference):
    rng = random.Random(7)
    letters = list("abc  \n\t'sdé日本  😀1２٣ⅷ.-<>|​́\x1c\x85") + ["the ", "ing", "'ll"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    texts += [None, "", " ", "\n\n", "a" * 3000, "x日" * 300, " " * 2000, "the" * 500 + "\n\n ", "<|endoftext|>", "dup", "dup"]
    frame = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "doc_id bigint, text string, parts string")
    # A small head sends most words through the keyed path.
    ids = encode.encode_corpus(frame, head_words=20)
    got = {r["doc_id"]: r["ids"] for r in ids.collect()}
    assert all(got[i] == reference.encode_ordinary(t or "") for i, t in enumerate(texts)) and len(got) == len(texts)
    back = encode.bound(ids, encode.piece_table(spark), "doc_id", text=lambda p: encode.decode_ids(ids["ids"], p))
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_long_words_merge_alike(reference):
    ranks = encode.load_ranks()
    for word in ("abcabc" * 60, "日" * 90, "aab" * 77):
        assert encode._queue_merges(word.encode(), ranks) == reference.encode_ordinary(word)


def test_empty_table(spark):
    assert encode.encode_corpus(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_ranks_are_read_from_the_folder_given(tmp_path):
    (tmp_path / "v.tiktoken").write_bytes(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b"b") + b" 1\n")
    assert encode.load_ranks(str(tmp_path), "v.tiktoken") == {b"a": 0, b"b": 1}


def test_rows_of_one_id_or_of_none_are_encoded_each(spark):
    texts = [(1, "Zyxwv qwxz"), (1, "Plvmt rare"), (None, "Gnrfl"), (None, None), (2, "x" * 400 + " é")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    pieces = encode.piece_table(spark)
    ids = encode.encode_corpus(frame, head_words=1)
    back = encode.bound(ids, pieces, "doc_id", text=lambda p: encode.decode_ids(F.col("ids"), p)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in texts)
