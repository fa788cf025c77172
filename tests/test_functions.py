from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quire.functions import identity, numbers, similarity, text


def run(spark, make, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.select("i", make(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_fold_and_titles(spark):
    values = ["„Der Turm“ ‒ x", "  The “Key”—x ", "Straße", "é", "é", "", "   ", None]
    assert run(spark, text.title_form, values) == ['"der turm" ‒ x', 'the "key"-x', "strasse", "é", "é", None, None, None]


def test_author_forms(spark):
    values = ["Vega, Ana, 1857-1940", "Vega, Ana", "a, b, c", "É. Zola", "M. Ø.", " ", None, "Ana Vega (b. 1900)", "O'Brien, Flann", "de Saint-Exupéry, Antoine", "Agent 007", "Verne, Jules, 1828–1905", "Vega,", "Ana Vega 1900-"]
    assert run(spark, text.author_form, values) == ["ana vega", "ana vega", "a b c", "e zola", "m ø", None, None, "ana vega b 1900", "flann o'brien", "antoine de saint-exupery", "agent 007", "jules verne", "vega", "ana vega"]


def test_marc_and_html(spark):
    assert run(spark, text.strip_marc, ["Key $b a tale", "cost $5", "A$AP  x", "$b ", None]) == ["Key a tale", "cost $5", "A$AP  x", None, None]
    html = ["<p>One.</p><p>Two &amp; three.Four</p>", "a<br/>b", "&lt;b&gt;", "x\n\n\n\ny", "<p> </p>", None]
    assert run(spark, text.html_text, html) == ["One.\n\nTwo & three. Four", "a\nb", "<b>", "x\n\ny", None, None]


@pytest.mark.parametrize("value, year", [
    ("1997", 1997), ("c1997", 1997), ("[1997]", 1997), ("1997-03-01", 1997), ("MCMXCVII", 1997), ("did", None), ("12345", None), ("1399", None), ("2101", None),
    ("1399 1500", None), ("IIII MM", None), ("", None), (None, None),
])
def test_years(spark, value, year):
    assert run(spark, numbers.parse_year, [value]) == [year]


def test_isbns(spark):
    values = ["978-0-306-40615-7", "0306406152", "0-8044-2957-x", "9790000000001", "9770306406157", "9780306406158", "978–0306406157", "", None]
    assert run(spark, numbers.to_isbn13, values) == ["9780306406157", "9780306406157", "9780804429573", None, None, None, "9780306406157", None, None]
    many = [f"978{i:09d}" for i in range(9)]
    full = [m + str(-sum(int(c) * (1, 3)[k % 2] for k, c in enumerate(m)) % 10) for m in many]
    lists = [full[:8], full, ["9780306406157", "0306406152"], [], None, [None, "x"]]
    assert run(spark, numbers.canonical_isbn, lists, "array<string>") == [min(full[:8]), None, "9780306406157", None, None, None]


def test_numbers(spark):
    assert run(spark, numbers.series_position, ["0.5", "2.5", "1.2.3", "-1", "NaN", "Infinity", "1000000", "999999.994", None]) == [
        Decimal("0.50"), Decimal("2.50"), None, None, None, None, None, None, None,
    ]
    assert run(spark, numbers.rating, ["4.5", "5.01", "x", None]) == [Decimal("4.50"), None, None, None]
    assert run(spark, numbers.positive_int, ["12", "0", "-3", "true", None]) == [12, None, None, None, None]
    assert run(spark, numbers.author_year, ["-300", "2101", "x", None]) == [-300, None, None, None]


def test_languages_and_keys(spark):
    lists = [["en"], ["eng", "en"], ["en", "fr"], ["zzz"], [], None, ["fre"], ["swa"], ["Ben "], ["hau"], ["e1"], ["grc", "xx"]]
    assert run(spark, identity.select_language, lists, "array<string>") == ["eng", "eng", None, None, None, None, "fra", "swa", "ben", "hau", None, "grc"]
    frame = spark.createDataFrame([("t", None, 1), ("t", "", 1), ("", "a", 1), (None, "a", 1), ("t", "1", None)], "t string, a string, y int")
    keys = [r[0] for r in frame.select(identity.fallback_key(F.col("t"), F.col("a"), F.col("y"))).collect()]
    assert keys[0] == keys[1] and keys[2] is None and keys[3] is None and keys[4] != keys[0]
    same = run(spark, identity.payload_hash, ['{"a":1,"b":{"d":2,"c":3}}', '{ "b": {"c":3,"d":2}, "a":1}', "{broken", None])
    assert same[0] == same[1] and same[2] is None and same[3] is None


def test_similarity(spark):
    frame = spark.createDataFrame([("The Key", "the key"), ("a b c", "b c d"), ("abc", "abd"), ("", "x"), (None, "x"), ("戦争", "戦車"), ("戦争", "戦争"), ("Dune", "Dune Messiah")], "a string, b string")
    got = [r[0] for r in frame.select(similarity.similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 1.0 and got[1] == pytest.approx(2 * 2 / 6) and got[2] == pytest.approx(0.5 * 2 * 2 / 6) and got[3:7] == [0.0, 0.0, 0.0, 0.0] and got[7] == pytest.approx(2 / 3)


def test_series_and_covers(spark):
    titles = ["Key (Saga, #2.5)", "Some Book (Some Series)", "Key (Paperback, #1)", "Key (Omnibus)", "Key (1999)", "(Saga, #1)", "Key (Saga, #1.2.3)", "Key", None]
    got = [r and tuple(r) for r in run(spark, similarity.title_series, titles)]
    assert got == [("Saga", "2.5", "Key"), ("Some Series", None, "Some Book"), None, None, None, None, ("Saga", None, "Key"), None, None]
    covers = ["http://x/a._SX98_.jpg", "https://x/nophoto.png", "https://x/no-photo/1.jpg", "https://x/NO_PHOTO.jpg", "https://x/no-cover.jpg", "", None]
    assert run(spark, similarity.cover, covers) == ["https://x/a.jpg", None, None, None, "https://x/no-cover.jpg", None, None]
    assert run(spark, lambda c: similarity.series_id(c, F.lit("The Loom Cycle")), ["/series/12-the-loom-cycle", "/series/12", "/series/12-other", "/book/1", None]) == ["12", "12", None, None, None]
    assert [tuple(x) for x in run(spark, similarity.split_by_author, ["Stand by Me by Ana", "Alone"])] == [("Stand by Me", "Ana"), ("Alone", None)]
    assert [x and tuple(x) for x in run(spark, similarity.aria_series, ["Book 2 in the Loom series", "See Book 2.5 in the Loom series now", "Book . in the Loom series", "x", None])] == [("Loom", "2"), ("Loom", "2.5"), ("Loom", None), None, None]
