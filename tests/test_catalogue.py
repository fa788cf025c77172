import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quire.operators import contested, mapping, merge, policy, search, upsert
from quire.sources import readers
from quire.streaming import events

RAW = "record_id bigint, " + ", ".join(f"{n} {k}" for n, k in {
    "source": "string", "source_id": "string", "title": "string", "subtitle": "string", "authors": mapping.AUTHORS, "subjects": "array<string>", "isbns": "array<string>",
    "languages": "array<string>", "published": "string", "publisher": "string", "page_count": "int", "description": "string", "cover_url": "string", "download_count": "bigint",
    "goodreads_average_rating": "decimal(3,2)", "series": mapping.SERIES,
}.items())


def raw(spark, rows):
    names = [p.split(" ")[0] for p in RAW.split(", ")]
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(RAW)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def test_mappers_reject_with_a_reason(spark):
    rows = [
        ("gutendex", '{"id": 1, "title": "T", "authors": [{"name": "A", "birth_year": -5}], "summaries": ["", "s"]}'), ("gutendex", '{"id": 1, "title": " "}'), ("gutendex", "{broken"),
        ("gutendex", '{"title": "T"}'), ("gutendex", '{"id": 1, "title": "T", "authors": "A"}'), ("openlibrary", '{"key": "/books/O1", "title": "T", "isbn_13": ["9"], "by_statement": "by Ana."}'),
        ("googlebooks", '{"id": "g", "volumeInfo": {"title": "T", "industryIdentifiers": [{"type": "OTHER", "identifier": "1"}, {"type": "ISBN_10", "identifier": "2"}]}}'),
        ("goodreads", '{"bookId": "7", "title": "T (Saga, #2)", "description": {"html": "<p>x</p>"}}'), ("elsewhere", "{}"), (None, None),
    ]
    frame = spark.createDataFrame(rows, "source string, raw_payload string").withColumn("raw_title", F.lit("clash"))
    kept, rejected = mapping.split(mapping.map_payloads(frame))
    by = {r["source"]: r["raw"] for r in kept.collect()}
    assert by["gutendex"]["authors"][0]["birth_year"] == -5 and by["gutendex"]["description"] == "s"
    assert by["openlibrary"]["isbns"] == ["9"] and by["openlibrary"]["authors"][0]["name"] == "Ana" and by["openlibrary"]["source_id"] == "O1"
    assert by["googlebooks"]["isbns"] == ["2"] and by["goodreads"]["title"] == "T" and by["goodreads"]["series"][0]["position"] == "2"
    assert sorted(r["rejection"]["detail"] for r in rejected.collect()) == sorted(
        ["no title", "payload is no object", "no identifier", "authors is no array", "unknown source", "unknown source"]
    )


def test_merge_is_ranked_and_order_independent(spark):
    person = [{"name": "Ana", "source_author_id": None, "birth_year": None, "death_year": None}]
    rows = [
        {"record_id": 1, "source": "gutendex", "source_id": "1", "title": "Key", "page_count": 0, "download_count": 5},
        {"record_id": 2, "source": "goodreads", "source_id": "2", "title": "Key", "publisher": "P", "authors": person, "isbns": ["0306406152"], "published": "1997"},
        {"record_id": 3, "source": "goodreads", "source_id": "3", "title": " ", "publisher": "Q"},
    ]
    clean = merge.canonicalise(raw(spark, rows)).withColumn("book_id", F.lit(1))
    assert [r["rejection"] is None for r in clean.orderBy("record_id").collect()] == [True, True, False]
    one, two = (merge.merge(f, "book_id").collect()[0] for f in (clean.where("rejection is null").orderBy("record_id"), clean.where("rejection is null").orderBy(F.desc("record_id"))))
    assert one == two and (one["publisher"], one["download_count"], one["page_count"], one["isbn13"], one["source"]) == ("P", 5, None, "9780306406157", "goodreads")
    keys = {r["identity_key"] for r in merge.unify_identity(clean.where("rejection is null"), "book_id").collect()}
    assert keys == {"isbn:9780306406157"}


def test_conflicting_isbns_are_not_merged(spark):
    rows = [{"record_id": i, "source": "goodreads", "source_id": str(i), "title": "Key", "isbns": [c]} for i, c in enumerate(["9780306406157", "9780804429573"])]
    other = [{"record_id": i, "source": "goodreads", "source_id": str(i), "title": t} for i, t in enumerate(["Moby Dick", "Pride"])]
    clean = merge.canonicalise(raw(spark, other)).withColumn("b", F.lit(1)).withColumn("kept", F.lit("isbn:9780306406157"))
    assert merge.merge(clean, "b").collect()[0]["conflict"]
    led = merge.merge(clean, "b", "kept").collect()[0]
    assert (led["conflict"], led["identity_key"], led["isbn13"], led["title"]) == (False, "isbn:9780306406157", "9780306406157", "Moby Dick")
    clash = merge.canonicalise(raw(spark, rows)).where("record_id = 1").withColumn("b", F.lit(1)).withColumn("kept", F.lit("isbn:9780306406157"))
    assert merge.merge(clash, "b", "kept").collect()[0]["conflict"]
    got = merge.merge(merge.canonicalise(raw(spark, rows)).withColumn("b", F.lit(1)), "b").collect()[0]
    assert got["conflict"] and got["title"] is None and merge.merge(merge.canonicalise(raw(spark, [])).withColumn("b", F.lit(1)), "b").count() == 0


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([("a", 1, 10), ("b", None, 20)], "k string, v int, n int")
    new = spark.createDataFrame([("b", 2, 1), ("c", 3, 1)], "k string, v int, n int")
    once = upsert.upsert(old, new, ["k"], {"v": upsert.fill})
    twice = upsert.upsert(once, new, ["k"], {"v": upsert.fill})
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 1, 10), ("b", 2, 1), ("c", 3, 1)]


def test_ids_are_dense_and_stable(spark):
    stored = spark.createDataFrame([("a", 7)], "k string, id bigint")
    fresh = spark.createDataFrame([("c",), ("b",), ("a",), (None,), ("c",)], "k string")
    assert dict(map(tuple, upsert.assign_ids(stored, fresh, "k", "id").collect())) == {"a": 7, "b": 8, "c": 9}


def test_components(spark):
    ties = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (9, 9), (None, 1)] + [(i, i + 1) for i in range(100, 140)], "book_a bigint, book_b bigint")
    roots = dict(map(tuple, upsert.reconcile_identities(ties).collect()))
    assert roots[3] == 1 and roots[6] == 5 and roots[9] == 9 and roots[140] == 100


def test_contested(spark):
    rows = [
        (1, "openlibrary", '{"title": "A", "number_of_pages": 3}'), (1, "googlebooks", '{"volumeInfo": {"title": "a ", "pageCount": 4}}'), (2, "goodreads", "{broken"), (2, "gutendex", None),
        (3, "a", '{"published": 1900}'), (3, "b", '{"published": 1950}'), (4, "a", '{"title": null, "volumeInfo": {"title": "x"}}'), (4, "b", '{"title": "y"}'),
        (5, "a", '{"publisher": [], "publishers": ["P"]}'), (5, "b", '{"publisher": "q", "volumeInfo": {"publisher": "p"}}'), (6, "a", '{"published_year": 1}'), (6, "b", '{"published_year": 2}'),
    ]
    counts = {r["book_id"]: r["conflicts"] for r in contested.conflict_counts(spark.createDataFrame(rows, "book_id bigint, source string, raw_payload string")).collect()}
    assert counts == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1, 6: 0}


def test_breaker_and_budget(spark):
    rows = [("s", i, s) for i, s in enumerate("ffofffo")]
    frame = spark.createDataFrame(rows, "source string, seq int, s string")
    got = [r["open"] for r in policy.breaker(frame, ["source"], ["seq"], F.col("s") == "f", F.lit(False), 3).orderBy("seq").collect()]
    assert got == [False] * 6 + [True]
    spent = [r["outcome"] for r in policy.budgets(frame, ["source"], ["seq"], 5, F.col("seq") == 2).orderBy("seq").collect()]
    assert spent == ["tried"] * 3 + ["skipped"] * 4


def test_dump_scan(spark, tmp_path):
    doc = lambda **k: "\t".join(["/type/edition", k.get("key", "/books/O1"), "1", "2020", json.dumps(k)])
    lines = [
        doc(key="/books/O1", title="T", isbn_13=["9780306406157"], languages=[{"key": "/languages/eng"}]), doc(key="/books/O2", title="T", by_statement="by Ana."), doc(key="/books/O3", title="T"),
        doc(key="/books/O4", title="T", isbn_10=["bad"]), "/type/edition\tx\t1", "/type/work\ta\tb\tc\t{}", "/type/edition\ta\tb\tc\t{broken", doc(key="/books/O5", title="T", by_statement="A", languages=[{"key": "/languages/fre"}]),
    ]
    path = tmp_path / "dump.txt.gz"
    path.write_bytes(gzip.compress("\n".join(lines).encode()))
    got = readers.dump_candidates(readers.scan_dump(spark, str(path)), ["eng"])
    assert [(r["candidate_key"], r["line"]) for r in got.orderBy("line").collect()] == [("O1", 1), ("O2", 2)]
    part, outcome = readers.dump_slice(got, len(lines), 1, 1)
    assert [r["candidate_key"] for r in part.collect()] == ["O1"] and outcome == {"emitted": 1, "next_line": 2, "exhausted": False}
    part, outcome = readers.dump_slice(got, len(lines), 2)
    assert [r["candidate_key"] for r in part.collect()] == ["O2"] and outcome == {"emitted": 1, "next_line": len(lines) + 1, "exhausted": True}
    broken = tmp_path / "broken.txt.gz"
    broken.write_bytes(gzip.compress(("\n".join(lines) * 4000).encode())[:2000])
    with pytest.raises(readers.TruncatedDumpError):
        readers.guarded(readers.scan_dump(spark, str(broken)))


def test_export_and_manifest(spark, tmp_path):
    path = tmp_path / "export.json"
    path.write_text(json.dumps({"count": 2, "items": [{"goodreadsId": "1", "title": "T", "author": ["A", "A", "B"]}, {"title": "U"}, 5]}))
    records = readers.scan_export(spark, str(path))
    profile = readers.export_profile(records).collect()[0]
    assert (profile["total"], profile["usable"], profile["missing_id"]) == (2, 1, 1) and "author" in profile["members"]
    made = [r[0] for r in records.select(readers.export_payload(F.col("record"))).collect()]
    assert json.loads(made[0])["authors"] == ["A", "B"] and made[1] is None
    assert readers.explain_profile(readers.export_profile(records)).count() == 0
    assert "members seen: " in readers.explain_profile(readers.export_profile(records.where("record_no = 1"))).collect()[0][0]
    out = str(tmp_path / "manifest.jsonl")
    digest = readers.write_manifest(spark.createDataFrame([("b", "2"), ("a", "1")], "candidate_key string, title string"), out, "candidate_key")
    readers.verify_checksum(out, digest.upper())
    with pytest.raises(ValueError):
        readers.verify_checksum(out, "0" * 64)
    assert [r["candidate_key"] for r in readers.read_manifest(spark, out, "candidate_key string, title string").collect()] == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        readers.source_frame(spark, str(tmp_path / "no"), str(tmp_path / "none"))


BASE = {"schema_version": 1, "event_id": "e", "run_id": "r", "event_type": "book.raw", "emitted_at": "2025-01-01T00:00:00Z", "source": "goodreads", "source_id": "1", "payload": {"title": "T"}}


def envelopes():
    change = lambda **k: json.dumps({**BASE, **k})
    return [
        (json.dumps(BASE), "ok"), (change(schema_version=2), "unsupported_version"), (change(schema_version="1"), "unsupported_version"), (change(schema_version=True), "unsupported_version"),
        (json.dumps({k: v for k, v in BASE.items() if k != "schema_version"}), "unsupported_version"), ("[1]", "malformed"), ("{broken", "malformed"), (change(event_type="x"), "unknown_type"),
        (change(emitted_at="2025-01-01T00:00:00"), "invalid"), (change(event_type="book.clean"), "invalid"), (change(event_type="run.partition_complete", topic="books.raw", partition=0), "ok"),
        (change(event_type="run.partition_complete", topic="books.raw", partition=-1), "invalid"),
    ]


def test_decode(spark):
    lines = spark.createDataFrame([(i, e) for i, (e, _) in enumerate(envelopes())], "i int, value string")
    assert [r["decode_status"] for r in events.decode(lines).orderBy("i").collect()] == [s for _, s in envelopes()]


def test_dead_letter_keeps_the_payload(spark):
    frame = spark.createDataFrame([('{"a": 1}',), ("{broken",), (None,)], "payload string")
    made = [json.loads(r[0]) for r in frame.select(events.dead_letter(F.lit("c"), F.lit("d" * 600), F.lit(1))).collect()]
    assert made[0]["a"] == 1 and all(m["_failure"]["code"] == "c" and len(m["_failure"]["detail"]) == 500 for m in made)


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.jsonl").write_text("\n".join(e for e, _ in envelopes()))
    stream = events.read_events(spark, str(folder))
    for _ in range(2):  # a second run finds its place in the checkpoint and adds nothing
        events.consume(stream, events.once(str(tmp_path / "out")), events.once(str(tmp_path / "dlq")), str(tmp_path / "check")).awaitTermination()
    batch = events.decode(spark.read.text(str(folder)))
    assert spark.read.parquet(str(tmp_path / "out")).count() == batch.where("decode_status = 'ok'").count() == 2
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == batch.where("decode_status <> 'ok'").count() == 10


def test_markers_complete_runs_once(spark):
    markers = spark.createDataFrame([("r", "t", 0), ("r", "t", 0), ("r", "t", 1), ("q", "t", 0)], "run_id string, topic string, partition int")
    topology = spark.createDataFrame([("r", "t", 2), ("s", "t", 2)], "run_id string, topic string, expected bigint")
    completed = events.completed_partitions(markers, topology)
    assert {r["run_id"]: r["complete"] for r in completed.collect()} == {"r": True, "s": False}
    runs = spark.createDataFrame([("r", "processing"), ("s", "processing"), ("z", "failed")], "run_id string, status string")
    assert dict(map(tuple, events.finalise(runs, completed).collect())) == {"r": "success", "s": "processing", "z": "failed"}


def test_stale_runs(spark):
    runs = spark.createDataFrame([(1, datetime(2025, 1, 1), "running"), (2, datetime(2025, 1, 1), "processing"), (3, datetime(2025, 1, 2), "running")], "id int, started_at timestamp_ntz, status string")
    got = policy.abandon_stale(runs, F.lit("2025-01-02 06:00:00").cast("timestamp_ntz")).orderBy("id").collect()
    assert [r["status"] for r in got] == ["failed", "processing", "running"]


def test_trigram_index(spark):
    books = spark.createDataFrame([(1, "Amber Railway"), (2, "amber railways"), (3, "Loom"), (4, None), (5, "???")], "i bigint, title string")
    index = search.trigram_table(books, "i", "title")
    got = {r["i"]: round(r["similarity"], 3) for r in search.trigram_lookup(index, "i", "Amber Railway", 0.3).collect()}
    assert got[1] == 1.0 and 0.7 < got[2] < 1.0 and set(got) == {1, 2} and search.trigram_lookup(index, "i", "?!", 0.3).count() == 0
    with pytest.raises(ValueError):
        search.trigram_lookup(index, "i", "x", 0)
