import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quire.plans.load import Catalogue

SCHEMA = "source string, raw_payload string, source_updated timestamp"
ISBN, OTHER = "9780306406157", "9780804429573"


def google(i, title, isbn=None, **info):
    numbers = [{"type": "ISBN_13", "identifier": isbn}] if isbn else []
    return ("googlebooks", json.dumps({"id": i, "volumeInfo": {"title": title, "authors": ["Vega, Ana"], "publishedDate": "1900", "industryIdentifiers": numbers, **info}}), None)


def gutendex(i, title, **more):
    return ("gutendex", json.dumps({"id": i, "title": title, "authors": [{"name": "Vega, Ana"}], "languages": ["en"], **more}), None)


def load(spark, catalogue, rows, day):
    catalogue.load(spark.createDataFrame(rows, SCHEMA), F.lit(datetime(2025, 1, day)))
    tables = {n: f.collect() for n, f in catalogue.tables().items()}
    return {n: sorted((r.asDict() for r in rows), key=str) for n, rows in tables.items()}


def test_load_reload_and_change(spark, tmp_path):
    catalogue = Catalogue(spark, str(tmp_path / "c"))
    rows = [google("g1", "The Key", ISBN), google("g2", "The Loom"), gutendex(5, "The Sea", download_count=7, subjects=["Sea", "sea "]), ("goodreads", "{broken", None)]
    first = load(spark, catalogue, rows, 1)
    assert len(first["books"]) == 3 and len(first["book_sources"]) == 3 and len(first["subjects"]) == 1 and first["rejected_records"][0]["code"] == "invalid_record"
    again = load(spark, catalogue, rows, 2)
    for r in again["book_sources"]:
        assert (r["first_seen_at"].day, r["last_seen_at"].day) == (1, 2)
    assert {k: v for k, v in again.items() if k != "book_sources"} == {k: v for k, v in first.items() if k != "book_sources"}
    changed = load(spark, catalogue, [google("g2", "The Loom", publisher="Tarn House")], 3)
    moved = {b["title"]: b["updated_at"].day for b in changed["books"]}
    assert moved == {"The Key": 1, "The Loom": 3, "The Sea": 1}


def test_sources_of_one_isbn_share_a_book_and_series_are_kept(spark, tmp_path):
    catalogue = Catalogue(spark, str(tmp_path / "c"))
    card = ("goodreads", json.dumps({"bookId": "7", "title": "The Key (Saga, #2)", "author": {"name": "Ana Vega"}, "_edition": {"isbn13": ISBN}}), None)
    got = load(spark, catalogue, [google("g1", "The Key", ISBN), card], 1)
    assert len(got["books"]) == 1 and got["books"][0]["series_search_text"] == "Saga" and float(got["book_series"][0]["position"]) == 2.0
    assert [a["normalised_name"] for a in got["authors"]] == ["ana vega"]


def test_a_fallback_is_promoted_and_merged_into_its_owner(spark, tmp_path):
    catalogue = Catalogue(spark, str(tmp_path / "c"))
    before = load(spark, catalogue, [google("g1", "The Key", ISBN), google("g2", "A Key"), google("g3", "Alone")], 1)
    after = load(spark, catalogue, [google("g2", "A Key", ISBN), google("g3", "Alone", OTHER)], 2)
    ids = {s["source_id"]: s["book_id"] for s in after["book_sources"]}
    assert ids["g1"] == ids["g2"] and len(after["books"]) == 2
    alone = next(b for b in before["books"] if b["title"] == "Alone")
    promoted = next(b for b in after["books"] if b["title"] == "Alone")
    assert promoted["book_id"] == alone["book_id"] and promoted["identity_key"] == f"isbn:{OTHER}"
