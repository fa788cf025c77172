import random
from datetime import datetime

from quire.operators import redelivery

U = "8db104d1-b8a5-4f4d-98af-94770112083a"
T = [datetime(2025, 1, d) for d in range(1, 10)]


def messages(spark, rows):
    return spark.createDataFrame([(i, e, t, "x") for i, e, t in rows], "delivery_id bigint, event_id string, emitted_at timestamp_ntz, first string")


def dropped(spark, rows):
    return sorted(r[0] for r in redelivery.message_duplicates(messages(spark, rows)).collect())


def test_notations_of_one_uuid(spark):
    forms = [U, U.upper(), "{" + U + "}", "urn:uuid:" + U, U.replace("-", ""), f"  {U} ", "URN:UUID:" + U.upper()]
    rows = [(i, f, T[5 - i] if i < 5 else T[8]) for i, f in enumerate(forms)]
    assert dropped(spark, rows) == [0, 1, 2, 3, 5, 6]


def test_unusable_ids_are_no_duplicates(spark):
    bad = [None, None, "", "", "unknown", "unknown", "evt-1", "evt-1", "00000000", "00000000", U[:-1], U[:-1]]
    assert dropped(spark, list(enumerate(bad and [(b) for b in bad])) and [(i, b, T[0]) for i, b in enumerate(bad)]) == []


def test_ties_nulls_and_empty(spark):
    assert dropped(spark, [(3, U, T[1]), (2, U, T[1]), (1, U, None)]) == [1, 3]
    assert dropped(spark, []) == []
    kept = redelivery.first_deliveries(messages(spark, [(1, U, T[0]), (2, U, T[0]), (3, None, T[0])]))
    assert sorted(r["delivery_id"] for r in kept.collect()) == [1, 3] and "first" in kept.columns


def test_ranges_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(redelivery, "RANGE_BLOCK", 10)
    rng = random.Random(5)
    rows = [(p, rng.randrange(0, 60)) for p in "ab" for _ in range(45)] + [(None, 1), ("a", None)]
    got = {tuple(r) for r in redelivery.seen_ranges(spark.createDataFrame(rows, "producer string, number bigint")).collect()}
    want = set()
    for p in "ab":
        numbers = sorted({n for q, n in rows if q == p and n is not None})
        start = None
        for k, n in enumerate(numbers):
            start = n if start is None else start
            if k + 1 == len(numbers) or numbers[k + 1] != n + 1:
                want.add((p, start, n))
                start = None
    assert got == want


def test_accept_each_uncovered_number_once(spark, monkeypatch):
    monkeypatch.setattr(redelivery, "RANGE_BLOCK", 4)
    seen = spark.createDataFrame([("a", 1, 9), ("a", 12, 12)], "producer string, first bigint, last bigint")
    batch = spark.createDataFrame([("a", 5, 1), ("a", 10, 3), ("a", 10, 2), ("a", 11, 4), ("b", 5, 5)], "producer string, number bigint, delivery_id bigint")
    accepted, ranges = redelivery.accept_sequence(seen, batch)
    assert {tuple(r) for r in accepted.collect()} == {("a", 10, 2), ("a", 11, 4), ("b", 5, 5)}
    assert {tuple(r) for r in ranges.collect()} == {("a", 1, 12), ("b", 5, 5)}


def test_sequence_identifier(spark):
    frame = spark.createDataFrame([("evt-12",), (U,), (None,), ("",), ("p-999999999999999999",)], "id string")
    got = [r[0] and tuple(r[0]) for r in frame.select(redelivery.sequence_identifier(frame["id"])).collect()]
    assert got == [("evt", 12), None, None, None, ("p", 999999999999999999)]
