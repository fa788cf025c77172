import random

from pyspark.sql import functions as F

from quire.functions import similarity
from quire.operators import search
from quire.plans import pipeline

RAW = "record_id bigint, source string, title string, authors array<struct<name:string>>"
CARDS = "bookid string, booktitlebare string, author struct<name:string>"


def test_like_titles_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(search, "COMMON", 3)
    pick = random.Random(3)
    some = lambda of, most: sorted(set(pick.choices(of, k=pick.randint(0, most))))
    asked, known = ([(some("abcdefghijkl", 9), some(["lydia", "otto", "ana", "marsh"], 3)) for _ in range(150)] for _ in range(2))
    left, right = spark.createDataFrame(asked, "t array<string>, a array<string>"), spark.createDataFrame(known, "u array<string>, b array<string>")
    for floor in (0.3, 0.75, 1.0):
        got = search.like_titles(left, right, floor).collect()
        near = lambda t, u: t and u and 2 * len({*t} & {*u}) / (len(t) + len(u)) >= floor  # noqa: B023, E731
        want = {(*t, 0, *a, 0, *u, 0, *b) for t, a in asked for u, b in known if near(t, u) and {*a} & {*b} & {"lydia", "otto", "marsh"}}
        assert len(got) == len(want) > 0 and {(*r["t"], 0, *r["a"], 0, *r["u"], 0, *r["b"]) for r in got} == want


def test_pairs_of_candidates_are_scored_without_python_workers(spark, tmp_path):
    rows = [(i, "gutendex", "The Iron Loom" if i else "Straße ÉTÉ", ["Brook, Lydia"]) for i in range(6)] + [(7, "gutendex", None, ["Lydia Brook"]), (8, "goodreads", "The Iron Loom", ["Lydia"]), (9, "gutendex", "The Iron Loom", None)]
    spark.createDataFrame([(i, s, t, a and [(n,) for n in a]) for i, s, t, a in rows], RAW).write.parquet(f"{tmp_path}/raw_book.parquet")
    cards = [(str(i), "the iron loom", "Lydia Brook") for i in range(5)] + [("5", "The Iron Gate, Loom", "LYDIA"), ("6", "STRASSE été", "lydia b."), ("7", "The Iron Loom", "Ann"), (None, "The Iron Loom", "Lydia"), ("0", "LOOM, the iron", "Brook, Lydia")]
    spark.createDataFrame([(i, t, (a,)) for i, t, a in cards], CARDS).write.parquet(f"{tmp_path}/goodreads_autocomplete.parquet")
    frame = pipeline.candidate_score(spark, str(tmp_path))
    # Each of the expressions in Python is a worker of its own beside each core.
    assert "ArrowEvalPython" not in frame._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, frame.select("record_id", "place", "bookid", "score", F.col("plausible")).collect()))
    best = [(i, place, str(place - 1), 1.0, True) for i in range(1, 6) for place in (1, 2, 3)]
    assert got == [(0, 1, "6", 0.8, True), *best]


def test_a_record_found_by_isbn_must_be_like_the_title(spark):
    pairs = [("The Iron Loom", "iron loom"), ("The Iron Loom", "Otto"), (" ", "Otto"), ("Otto", None)]
    frame = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    assert [r[0] for r in frame.select(similarity.plausible(F.col("a"), F.col("b"))).collect()] == [True, False, True, True]
