import json

from quire.operators import drift

SCHEMA = "feed string, file_id bigint, file_seq int, line_no int, fetched_at timestamp_ntz, doc string, file_seq_copy int"


def lines(spark, files):
    rows = [
        (feed, fid, seq, n, None, doc if doc is None or isinstance(doc, str) else json.dumps(doc), seq)
        for feed, fid, seq, docs in files
        for n, doc in enumerate(docs)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def found(spark, files):
    return {tuple(r) for r in drift.changes(lines(spark, files)).select("file_id", "change_kind", "old_name", "new_name").collect()}


def test_kinds_of_change(spark):
    one = [{"key": "a", "isbn": ["1", "2"], "pages": 3, "gone": "x"}, {"key": "b", "isbn": ["3"], "pages": 4, "gone": None}]
    two = [{"key": "a", "isbns": "1; 2", "pages": "3", "fresh": [{"name": "n"}]}, {"key": "b", "isbns": "3", "pages": "4"}]
    assert found(spark, [("f", 1, 1, one), ("f", 2, 2, two)]) == {
        (2, "renamed", "isbn", "isbns"), (2, "retyped", "isbn", "isbns"), (2, "retyped", "pages", "pages"), (2, "added", "", "fresh"), (2, "removed", "gone", ""),
    }


def test_different_content_is_no_rename(spark):
    assert found(spark, [("f", 1, 1, [{"key": "a", "x": "1"}]), ("f", 2, 2, [{"key": "a", "y": "2"}])]) == {(2, "removed", "x", ""), (2, "added", "", "y")}


def test_object_shapes_carry_the_same_content(spark):
    one = [{"key": "a", "isbn": ["978"], "language": ["eng"]}]
    two = [{"key": "a", "codes": [{"type": "ISBN_13", "value": "978"}], "languages": [{"key": "/languages/eng"}]}]
    kinds = {(k, o, n) for _, k, o, n in found(spark, [("f", 1, 1, one), ("f", 2, 2, two)])}
    assert {("renamed", "isbn", "codes"), ("renamed", "language", "languages")} <= kinds


def test_broken_null_and_empty_documents(spark):
    files = [("f", 1, 1, [None, "{broken", "[1]", {"key": "a", "t": ""}]), ("f", 2, 2, [{"key": "a", "t": []}, {"key": "a", "t": []}])]
    assert found(spark, files) == set()


def test_missing_predecessor_and_other_feeds_are_not_compared(spark):
    assert found(spark, [("f", 1, 1, [{"key": "a"}]), ("f", 3, 3, [{"key": "a", "z": 1}]), ("g", 4, 4, [{"key": "a", "q": 1}])]) == set()


def test_blocks_do_not_hide_changes(spark, monkeypatch):
    monkeypatch.setattr(drift, "BLOCK", 2)
    files = [("f", s, s, [{"key": "a", **({"x": 1} if s != 4 else {})}]) for s in range(1, 8)]
    assert found(spark, files) == {(4, "removed", "x", ""), (5, "added", "", "x")}


def test_empty_table(spark):
    assert drift.changes(lines(spark, [])).count() == 0


def test_consistent_table(spark):
    one = [{"key": "a", "isbn": ["1", "2"], "pages": 3}]
    two = [{"key": "a", "isbns": "1; 2", "pages": 3}]
    frame = lines(spark, [("f", 1, 1, one), ("f", 2, 2, two)])
    aliases = drift.alias_table(frame)
    rows = drift.consistent_table(frame, aliases).orderBy("file_id").collect()
    assert aliases["isbn"] == aliases["isbns"]
    assert [r[aliases["isbn"]] for r in rows] == [["1", "2"], ["1", "2"]] and [r["pages"] for r in rows] == [3.0, 3.0]
