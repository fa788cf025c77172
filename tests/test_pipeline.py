import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quire.functions import pages
from quire.operators import enrichment, policy, runs
from quire.plans.load import Catalogue
from quire.streaming import consumers, events

ISBN = "9780306406157"
PAGE = """<html><head><script type="application/ld+json">{broken</script><script type="application/ld+json">[{"@type": "Thing"}, {"@type": "Book", "author": [{"name": " Ana "}, "Otto", {"x": 1}, {"name": "Ana"}],
 "numberOfPages": 12, "isbn": " "}]</script></head><body><div data-testid="description">One.<br>Two &amp; <b>three</b></div><span aria-label="nothing"></span>
<div aria-label="Book 2.5 in the Loom Cycle series"><a href="/series/12-loom-cycle">x</a></div><a href="/work/editions/77">e</a><script>{"publicationTime": 0000000000, "publicationTime" : 946684800000}</script>"""


def test_a_book_page(spark):
    rows = [(1, PAGE), (2, ""), (3, None), (4, "<div><p></div></b><a href='/series/9'>" + "x" * 100_000), (5, PAGE.replace("12-loom-cycle", "12-other").replace('"numberOfPages": 12', '"numberOfPages": true'))]
    frame = spark.createDataFrame(rows, "i int, markup string").withColumn("p", pages.page_pieces("markup"))
    got = {r["i"]: r["d"] for r in frame.select("i", pages.book_page(F.col("markup"), F.col("p")).alias("d")).collect()}
    one = got[1]
    assert one["authors"] == ["Ana", "Otto"] and one["page_count"] == 12 and one["isbn"] is None and one["description"] == "One.\nTwo & three" and one["work_id"] == "77"
    assert (one["series"]["name"], one["series"]["position"], one["series"]["source_series_id"], one["series"]["confirmed"]) == ("Loom Cycle", "2.5", "12", True)
    assert got[5]["series"]["confirmed"] is False and got[5]["page_count"] is None
    for i in (2, 3, 4):
        assert got[i]["authors"] == [] and got[i]["series"] is None and got[i]["published"] is None


def test_the_first_edition_only(spark):
    markup = f'<div class="editionData"><div>Published June 3, 1949 by Secker &amp; Sons</div><div>ISBN {ISBN}</div></div><div class="editionData">Published May 1900 by No</div>'
    frame = spark.createDataFrame([(markup,), ("<p>none</p>",), (None,)], "m string").select(pages.first_edition(pages.page_pieces("m")).alias("e"))
    got = [(r["e"]["isbn13"], r["e"]["published"], r["e"]["publisher"]) for r in frame.collect()]
    assert got == [(ISBN, "June 3, 1949", "Secker & Sons"), (None, None, None), (None, None, None)]


def test_enriching_asks_for_editions_only_where_something_is_wanting(spark):
    backlog = spark.createDataFrame([("a",), ("b",)], "source_id string")
    seen = spark.createDataFrame([("a", PAGE)], "source_id string, markup string")
    listed = spark.createDataFrame([("77", f'<div data-testid="editionCell">ISBN {ISBN}</div>'), ("78", "<p>")], "work_id string, markup string")
    got = {r["source_id"]: r for r in enrichment.enrich(backlog, seen, listed).collect()}
    assert got["a"]["outcome"] == "enriched" and got["a"]["edition"]["isbn13"] == ISBN and got["b"]["outcome"] == "missing" and got["b"]["edition"] is None


def test_contested_books_until_the_circuit_opens(spark):
    pair = lambda b, n: [(b, "openlibrary", json.dumps({"title": "A", "publisher": "P" if n > 1 else "Q"})), (b, "googlebooks", json.dumps({"title": "B", "publisher": "Q"}))]
    payloads = spark.createDataFrame([r for b, n in ((1, 2), (2, 2), (3, 1), (4, 1), (5, 1)) for r in pair(b, n)], "book_id bigint, source string, raw_payload string")
    answers = spark.createDataFrame([(1, False, "{}"), (2, True, None), (3, True, None), (5, False, "{}")], "book_id bigint, failed boolean, payload string")
    got = {r["book_id"]: r["outcome"] for r in enrichment.resolve_contested(payloads, answers, 1, 10, "goodreads", 2).collect()}
    assert got == {1: "resolved", 2: "failed", 3: "failed", 4: "skipped", 5: "skipped"}


def test_resolution_modes(spark):
    asked = spark.createDataFrame([(1, False), (2, False), (3, True), (4, False)], "candidate_key bigint, kept boolean")
    told = spark.createDataFrame([(1, "a", "partial"), (1, "b", "resolved"), (2, "a", "resolved"), (2, "b", "unavailable"), (4, "a", "contract_failure")], "candidate_key bigint, source string, state string")
    said = lambda enrich: {(r["candidate_key"], r["source"]): r["outcome"] for r in policy.resolve_candidates(asked, told, ["a", "b"], enrich, F.col("kept"))[1].collect()}
    assert said(False) == {(1, "a"): "partial", (1, "b"): "resolved", (2, "a"): "resolved", (2, "b"): "skipped", (3, "retained"): "resolved", (3, "a"): "skipped", (3, "b"): "skipped", (4, "a"): "contract_failure", (4, "b"): "no_match"}
    assert said(True)[2, "b"] == "unavailable" and said(True)[3, "a"] == "no_match"
    by = {r["candidate_key"]: (r["resolved_by"], r["filled_by"]) for r in policy.resolve_candidates(asked, told, ["a", "b"], False, F.col("kept"))[0].collect()}
    assert by == {1: ("b", None), 2: ("a", None), 3: ("retained", None), 4: (None, None)}
    with pytest.raises(PermissionError):
        policy.ensure_accepted(True, False)


def test_runs(spark):
    old = spark.createDataFrame([("r1", "x", "running", datetime(2025, 1, 1)), ("r2", "x", "success", datetime(2025, 1, 1))], "run_id string, label string, status string, started_at timestamp")
    got = {r["run_id"]: r["status"] for r in runs.start_run(old, "r3", "u", F.lit(datetime(2025, 1, 2))).collect()}
    assert got == {"r1": "failed", "r2": "success", "r3": "running"}
    tried = spark.createDataFrame([("r", "k", "s", 1, "resolved", None, 5)], "run_id string, candidate_key string, source string, attempt_no int, outcome string, fallback_reason string, duration_ms int")
    assert runs.record_attempts(tried, tried.withColumn("outcome", F.lit("partial"))).collect()[0]["outcome"] == "partial"


def envelope(i, payload, **more):
    return json.dumps({"schema_version": 1, "event_id": str(i), "run_id": "r", "event_type": "book.raw", "emitted_at": "2025-01-01T00:00:00Z", "source": "googlebooks", "source_id": str(i), "payload": payload, **more})


def volume(i, title, isbn=None):
    return {"id": f"g{i}", "volumeInfo": {"title": title, "authors": ["Vega, Ana"], "industryIdentifiers": [{"type": "ISBN_13", "identifier": isbn}] if isbn else []}}


def test_stream_equals_batch_through_both_consumers(spark, tmp_path):
    raw, clean, letters, lost = (str(tmp_path / n) for n in ("raw", "clean", "letters", "lost"))
    (tmp_path / "raw").mkdir()
    marker = json.dumps({"schema_version": 1, "event_id": "m", "run_id": "r", "event_type": "run.partition_complete", "emitted_at": "2025-01-01T00:00:00Z", "topic": "books.raw", "partition": 0})
    lines = [envelope(1, volume(1, "The Key", ISBN)), envelope(2, volume(2, "A Key", ISBN)), envelope(3, {"id": "g3"}), envelope(4, volume(4, "Loom"), schema_version=2), "{broken", marker]
    (tmp_path / "raw" / "one.jsonl").write_text("\n".join(lines))
    now = F.lit(datetime(2025, 1, 2))
    for _ in range(2):  # a restart finds its place and adds nothing
        consumers.run_transform(events.read_events(spark, raw), clean, letters, str(tmp_path / "c1"), now).awaitTermination()
    told = [json.loads(r["value"]) for r in spark.read.option("recursiveFileLookup", "true").text(clean).collect()]
    assert sorted(t["event_type"] for t in told) == ["book.clean", "book.clean", "run.partition_complete"] and {t.get("identity_key") for t in told} == {f"isbn:{ISBN}", None}
    failures = sorted(json.loads(r["value"])["_failure"]["code"] for r in spark.read.option("recursiveFileLookup", "true").text(letters).collect())
    assert failures == ["invalid_record", "malformed", "unsupported_version"]
    streamed, whole = Catalogue(spark, str(tmp_path / "s")), Catalogue(spark, str(tmp_path / "b"))
    for _ in range(2):
        consumers.run_load(consumers.read_lines(spark, clean), streamed, lost, str(tmp_path / "c2"), now).awaitTermination()
    batch = spark.createDataFrame([("googlebooks", json.dumps(volume(i, t, ISBN)), None) for i, t in ((1, "The Key"), (2, "A Key"))], "source string, raw_payload string, source_updated timestamp")
    whole.load(batch, now)
    assert streamed.version() == 1
    for name in ("books", "book_authors", "authors"):
        assert sorted(map(str, streamed.tables()[name].collect())) == sorted(map(str, whole.tables()[name].collect()))


def test_command_line(spark, tmp_path, capsys):
    from quire.__main__ import main

    assert main(["queries"]) == 0 and "ranked_merge" in capsys.readouterr().out and main(["run", "nothing", "x", "y"]) == 2
    assert main(["run", "rows_per_source", "/root/testdata/sf0.001", str(tmp_path / "out")], spark) == 0 and spark.read.parquet(str(tmp_path / "out")).count() == 4
    seen = spark.createDataFrame([("googlebooks", json.dumps(volume(1, "The Key", ISBN)), datetime(2025, 1, 1))], "source string, raw_payload string, source_updated timestamp")
    seen.write.parquet(str(tmp_path / "seen"))
    assert main(["load", str(tmp_path / "cat"), str(tmp_path / "seen")], spark) == 0 and Catalogue(spark, str(tmp_path / "cat")).tables()["books"].count() == 1
    (tmp_path / "dump.txt").write_text("\n".join(f"line {i}" for i in range(50)))
    assert main(["slice", str(tmp_path / "dump.txt"), "7", str(tmp_path / "part")], spark) == 0
    assert [r["value"] for r in spark.read.text(str(tmp_path / "part")).collect()] == [f"line {i}" for i in range(7)]
