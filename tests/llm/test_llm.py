import random
from datetime import datetime

import numpy as np
import pytest

from quire.llm import canonical, linkage, mixing, stuffing, survivor, thesaurus
from quire.session import cut_lineage

TERMS = [(1, "Beekeeping"), (2, "Sea stories"), (3, "Fairs"), (4, "Science fiction"), (5, "Banking"), (6, "Baking"), (7, "One-act plays"), (8, "Wit and humor"), (9, "Naval history")]


@pytest.mark.parametrize("entry, found", [
    ("Beekeeping", [1]), ("beekeping", [1]), ("bekepnig", []), ("  SEA   STORIES. ", [2]), ("Stories, sea", [2]), ("sea_stories", [2]), ("Sea story", [2]), ("Sea stries", [2]),
    ("Sea stories -- Bibliography", [2]), ("Works on sea stories", [2]), ("subject: sea stories", [2]), ("Books / Sea stories / General", [2]), ("Sea stories; Beekeeping", [2, 1]),
    ("fairs, Science", []), ("Sci. fict.", [4]), ("SF", [4]), ("Banking", [5]), ("Baking", [6]), ("One--act plays", [7]), ("Wit & humour", [8]), ("History, naval", [9]), ("Naval history, History", [9]),
    ("", []), ("???", []), ("x" * 3000, []), ("Beekeeping (Somewhere)", [1]),
])
def test_entries(entry, found):
    assert canonical.resolve(canonical.Trie(TERMS, thesaurus.ALIASES), entry) == found


def test_automaton_against_brute_force():
    rng = random.Random(1)
    terms = [(i, "".join(rng.choice("abcd") for _ in range(rng.randrange(4, 11)))) for i in range(40)]
    trie = canonical.Trie(terms)

    def osa(a, b):
        d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
                if i and j and x == b[j - 1] and y == a[i - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a) - 1, len(b) - 1]

    for _ in range(200):
        text = "".join(rng.choice("abcd") for _ in range(rng.randrange(4, 11)))
        limit = canonical.allowed_distance(len(text))
        want: dict[int, int] = {}
        for path, ends in trie.paths.items():
            near = osa(text, path)
            for penalty, term in ends:
                if near <= min(limit, canonical.allowed_distance(len(path))) and near + penalty <= limit:
                    want[term] = min(want.get(term, 9), near + penalty)
        assert dict((t, d) for d, t in trie.search(text)) == want


def test_entries_count_once_per_record(spark):
    rows = [(1, ["Beekeeping", None, "Sea stories"], "clash"), (1, ["Beekeeping", None, "Sea stories"], "again"), (2, [], ""), (3, None, ""), (4, ["Origami"], "")]
    entries = canonical.entries_of(spark.createDataFrame(rows, "id bigint, subjects array<string>, entry string"), "gutendex", "id", "subjects")
    terms = spark.createDataFrame(TERMS, "term_id bigint, term string")
    assert sorted(map(tuple, canonical.canonical_terms(entries, terms).collect())) == [("gutendex", "1", 0, 1), ("gutendex", "1", 2, 2)]
    assert [tuple(r) for r in canonical.unmatched(entries, terms).collect()] == [("Origami", 1)]
    assert canonical.canonical_terms(entries.limit(0), terms.limit(0)).count() == 0


RECORD = "record_id bigint, source string, title string, subtitle string, authors array<struct<name:string>>, isbns array<string>, published string, publisher string, page_count int, languages array<string>, key string"


def record(i, source, title, author="Vega, Ana", year="1900", isbn=None, **more):
    names = [(a,) for a in ([author] if isinstance(author, str) else author or [])]
    return (i, source, title, more.get("subtitle"), names, [isbn] if isbn else [], year, more.get("publisher"), more.get("pages"), ["en"], "clash")


def library(n=90):
    """Two accounts each of n works by a few authors, of which some have a second volume or a guide with pages of its own."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(s) for s in ("bdfgklmnprstvz", "aeiou", "bdfgklmnprstvz", "aeiou", "lmnrst", "aeiou", "ckpt"))
    rows = []
    for i in range(n):
        title, author, year, pages = f"{rng.choice(["Letters from", "Notes of", "Under"])} {word()} {word()}", f"{word()}, Ana", 1500 + 2 * i, 100 + 31 * (i % 20)
        if i % 3:
            author = rows[-1][4][0][0]
        isbn = f"978{i:09d}{-(38 + sum(int(c) * (3, 1)[j % 2] for j, c in enumerate(f'{i:09d}'))) % 10}"
        house = f"{word()} books"
        rows += [record(1000 + 10 * i, "a", title, author, str(year), isbn, pages=pages, publisher=house), record(1001 + 10 * i, "b", title.title(), author, str(year + i % 2 * 9), isbn, pages=pages, publisher=house)]
        if i % 4 == 2:
            # Another's work of the same title and year, and another work under the same ISBN.
            rows += [record(1004 + 10 * i, "e", title, f"{word()}, Otto", str(year), pages=pages + 300), record(1005 + 10 * i, "e", f"{word()} {word()}", f"{word()}, Eva", str(year + 90), isbn, pages=pages + 300)]
        other = {0: f"{title}, Part 2", 1: f"A Reader's Guide to {title}"}.get(i % 4)
        if other:
            rows += [record(1002 + 10 * i, "c", other, author, str(year + 30), pages=pages + 200), record(1003 + 10 * i, "d", other, author, str(year + 30), pages=pages + 200)]
    return rows


def test_linkage(spark):
    rows = [
        record(1, "a", "The Amber Railway", "Ana Vega"), record(2, "b", "Amber Railway, The (Paperback)", "Vega, Ana", "c1901"), record(3, "c", "the ambeer railway : a facsimile", ["A. Vega"], None),
        record(4, "a", "The Amber Railway, Part 2"), record(5, "b", "Amber Railway, Volume Two", year="MCM"), record(6, "b", "The Amber Railway, Continued"), record(7, "c", "A Reader's Guide to The Amber Railway"),
        record(8, "b", "The Amber Railway", "Otto Klein", "1900"), record(9, "b", "Winter", "Otto Klein", isbn="9780306406157"), record(10, "c", "Summer", "Ana Vega", isbn="9780306406157"),
        record(11, "a", None), record(12, "b", ""), record(13, "a", "The Amber Railway", "Ana Vega"), record(14, "b", "Amber Railway $b a tale", None, "1900"),
    ] + library()
    got = {(r["record_a"], r["record_b"]) for r in linkage.matches(spark.createDataFrame(rows, RECORD)).collect()}
    assert {(1, 2), (1, 3), (2, 3), (2, 13), (3, 13), (4, 5)} <= got
    # What another author or a shared ISBN says is learnt from more candidates than a fixture has.
    assert not [p for p in got if {6, 7, 11, 12} & set(p)] and (1, 13) not in got and (1, 5) not in got
    assert linkage.matches(spark.createDataFrame([], RECORD)).count() == 0


def test_linkage_of_added_subtitles(spark):
    rows = [
        record(1, "a", "The Amber Railway"), record(2, "b", "The Amber Railway: Iron across the Moor"), record(3, "c", "The Amber Railway", year="1950"), record(4, "c", "The Amber Railway: Rails by Night"),
        record(5, "c", "The Amber Railway, Part 2: Iron across the Moor"), record(6, "c", "The Amber Railway: Study Guide"), record(7, "b", "The Amber Railway: Iron across the Moor", "Otto Klein"),
        record(8, "a", "Winter Bells", None, None, "9780306406157"), record(9, "b", "Winter Bells", None, None, "9780306406157", subtitle="Letters to Nobody"), record(10, "c", "Summer", None, None, "9780306406157"),
    ] + library()
    got = {(r["record_a"], r["record_b"]) for r in linkage.matches(spark.createDataFrame(rows, RECORD)).collect() if r["record_a"] < 100}
    assert {(1, 2), (1, 4), (8, 9)} <= got and not [p for p in got if {5, 6} & set(p)] and (2, 4) not in got


def test_placeholder_isbn_forms_no_block(spark):
    rows = [record(i, "ab"[i % 2], f"Number {chr(97 + i // 26)}{chr(97 + i % 26)} {chr(97 + i % 26) * 5}", f"Author{chr(97 + i % 26)}, Ana", str(1500 + 3 * i), "9780306406157") for i in range(60)]
    rows += [record(100, "a", "Winter Bells", None, None, "9780306406157"), record(101, "b", "Winter Bells", None, None, "9780306406157")]
    found = linkage.candidates(cut_lineage(linkage.keyed(cut_lineage(linkage.prepare(spark.createDataFrame(rows, RECORD))))))
    # One contrast per record with the ISBN, not each with each.
    assert 1 <= found.count() <= 100 and [(r["record_a"], r["record_b"]) for r in found.where("title > 0").collect()] == [(100, 101)]


def test_a_title_and_author_of_a_third_of_all_records(spark, monkeypatch):
    from quire.operators import skew

    rows = [record(i, "abc"[i % 3], "Poems" if i % 3 == 0 or i < 8 else f"Verse {chr(97 + i % 26)}{chr(97 + i // 26)}ing", "Vega, Ana", "1900") for i in range(120)]
    want = sorted((x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and x[1] != y[1] and x[2] == y[2] == "Poems")
    keyed = cut_lineage(linkage.keyed(cut_lineage(linkage.prepare(spark.createDataFrame(rows, RECORD)))))
    monkeypatch.setattr(skew.salted_join, "__defaults__", (10,))
    got = sorted((r["record_a"], r["record_b"]) for r in linkage.candidates(keyed).where("title > 0").collect())
    assert set(want) <= set(got) and len(got) == len(set(got))


def test_label_model_learns_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.6
    right = [0.9, 0.8, 0.7, 0.75]
    votes = np.stack([np.where(rng.random(4000) < 0.2, 0, np.where(rng.random(4000) < p, 1, -1) * np.where(truth, 1, -1)) for p in right], axis=1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = linkage.LabelModel(patterns, counts)
    posterior = model.posterior[inverse.ravel()]
    assert ((posterior > 0.5) == truth).mean() > 0.88 and abs(posterior.mean() - 0.6) < 0.1


def test_title_keys():
    key = lambda t, s=None: linkage.title_key(linkage.title_tokens(t, s))
    assert key("The Key: being the adventures of a pilot")[0] == key("Key, The", "being the adventures of a pilot")[0] == "key"
    assert key("Key: II")[1] == key("Key, Book Two")[1] == key("The Key v. 2")[1] == "2" and key("Study Guide to the Key")[2] == "study guide to"
    assert key("") is None and key(None) is None and key("???") is None and key("Home")[0] == "home" and key("Retold for Children") is not None
    assert linkage.year_of("MCMXCVII") == 1997 and linkage.year_of("[19--?]") is None and linkage.isbn13_of("0306406152 (pbk.)") == "9780306406157" and linkage.isbn13_of("123") is None


SOURCES, BOOKS = "book_id bigint, source string, source_id string, description string", "source string, source_id string, source_updated timestamp_ntz, description string, publisher string, page_count int, published string, book_id int"


def test_survivors(spark):
    whole = "A whole text about the book."
    rows = [
        (1, "goodreads", "1", "A text that is cut o…", "s.n.", 0, "n.d.", None), (1, "googlebooks", "2", whole, "Tarn House", 100, "MCM", datetime(2025, 1, 1)),
        (1, "googlebooks", "10", whole, "Tarn House", 101, "1901", datetime(2025, 1, 1)), (1, "gutendex", "3", whole, "X", 5, "1999", datetime(2026, 1, 1)),
        (2, "goodreads", "4", "No description available.", None, None, "[19--?]", None), (2, "gutendex", "5", "Printed on demand from a scanned copy. Ships within two working days.", "-", -1, "forthcoming", None),
        (3, "goodreads", "6", whole, "Y", 9, "1900", None),
    ]
    stored = spark.createDataFrame([(r[0], r[1], r[2], "clash") for r in rows], SOURCES)
    raw = spark.createDataFrame([(r[1], r[2], r[7], r[3], r[4], r[5], r[6], 0) for r in rows], BOOKS)
    of = survivor.of_several(survivor.accounts(stored, raw), stored)
    got = {tuple(r) for r in survivor.survivors(of, survivor.TRUST).collect()}
    assert got == {(1, f, "googlebooks", "10") for f in survivor.FIELDS}
    found = survivor.discover(survivor.claims(of))
    assert set(found) == {"googlebooks", "gutendex"} and found["googlebooks"] > found["gutendex"]
    assert survivor.survivors(of.limit(0)).count() == 0


@pytest.mark.parametrize("text, usable", [
    ("The whole story.", True), ("Cut off here...", False), ("Cut off (more)", False), ("Cut off &hellip;", False), ("No end", False), ("TBA", False), ("Book.", False),
    ("Keine Beschreibung vorhanden.", False), ("", False), (None, False), ("He said: \"Come home.\"", True),
])
def test_usable_descriptions(spark, text, usable):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(survivor.usable_description(frame["t"])).collect()[0][0] is usable


def shares(spark, texts):
    return {r["doc_id"]: r["share"] for r in stuffing.stuffing_shares(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}


def test_stuffing(spark):
    prose = "The villain, if he is one, waits for the night until the lantern gives way. Nobody in the town speaks of the orchard. "
    verse = "The miller went down to the sea at dawn,\nAnd the sail that she carried was drawn;\nRow, row for Avalon, and never look behind.\nRow, row for Avalon, and never look behind!\n"
    contents = "Contents\nI. The Amber Railway ...... 14\nII. On the Canal ...... 25\n" + prose
    annotated = f"The Canal. {prose}(https://books.x.example/1) Nobody will forgive the narrator for this.\n" * 2
    genuine = [prose * 3, verse * 2, contents, annotated, "Loved it.", None, "", " ​ ", "ok", prose * 400]
    stuffed = [
        "cheap books, read online, epub, cheap books, epub, read online, cheap books, epub, cheap books", "free ebook box set free ebook free ebook box set box set free ebook box set",
        "\n".join(f"https://shop.x{i}.example/deal/{i}" for i in range(6)), "\n".join(f"[Title {i}](http://a.example/p?id={i})" for i in range(6)), " ".join(f"#Tag{i}" for i in range(12)),
        "Home\nSign in\nSale\nImprint\nTerms\nGenres\nContact\nReturns\nShipping", "Get box set with free ebook: box set, free ebook, epub. Looking for box set? Box set, free ebook, box set here. Our box set is the best box set.",
        "c h e a p   b o o k s  r e a d   o n l i n e  c h e a p   b o o k s",
    ]
    got = shares(spark, genuine + stuffed)
    flagged = {r["doc_id"] for r in stuffing.stuffed_pages(spark.createDataFrame(list(enumerate(genuine + stuffed)), "doc_id bigint, text string")).collect()}
    assert flagged == set(range(len(genuine), len(genuine) + len(stuffed))), got


def test_repeated_segments(spark):
    keywords = "Order our garden furniture catalogue today for free delivery."
    prose = "The villain, if he is one, waits for the night until the lantern gives way. Nobody in the town speaks of the orchard. "
    lines = ["The miller went down to the sea at dawn,", "The sail that she carried was drawn and gone,", "A lantern was hung at the end of the lane,", "The ferryman waited a week for the rain,", "And nobody came to the harbour again,"]
    verse = "\n".join(f"{line}\nRow, row for Avalon, and never look behind." for line in lines)
    genuine = [verse, prose * 400, prose + keywords, "buy cheap books"]
    stuffed = ["buy cheap books\n" * 500, (keywords + "\n") * 300, (keywords + " ") * 300, (keywords + "\n") * 20 + prose * 3]
    frame = spark.createDataFrame(list(enumerate(genuine + stuffed)), "doc_id bigint, text string")
    assert {r["doc_id"] for r in stuffing.stuffed_pages(frame).collect()} == set(range(len(genuine), len(genuine) + len(stuffed)))
    got = {r["doc_id"]: r for r in stuffing.stuffing_shares(frame).collect()}
    assert got[len(genuine)]["n_words"] == 1500 and got[len(genuine) + 1]["share"] == 1 and got[0]["share"] == 0


def test_mixing(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["sea", "bee", "key", "map"]) for _ in range(rng.randrange(5, 40))), s, 7) for i, s in enumerate(["a"] * 300 + ["b"] * 60 + ["other"] * 20 + [None] * 10)]
    docs += [(1000, None, "a", 7), (1001, "", "b", 7)]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("missing", 0.1, 2)], "source string, target_share double, max_repeats int")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string, tokens int")
    mixed = mixing.mix(frame, targets).cache()
    uses = {r["doc_id"]: r["uses"] for r in mixed.collect()}
    assert all(0 <= u <= (1 if i < 300 else 3) for i, u in uses.items()) and not set(uses) & set(range(360, 380))
    got = {r["source"]: r["actual_share"] for r in mixing.shares(mixed, targets).collect()}
    assert got["a"] == pytest.approx(5 / 9, abs=0.03) and got["b"] == pytest.approx(4 / 9, abs=0.03) and got["missing"] == 0
    assert mixing.mix(frame.limit(0), targets).count() == 0 and mixing.mix(frame, targets.limit(0)).count() == 0


def test_sentences_that_repeat_a_keyword(spark):
    frames = ["I bought {} in the spring, which says something.", "My father kept {} at school, though the ending still puzzles me.", "Nobody returned {} before the wedding, but that was long ago.", "We read aloud from {} on a train, and I am glad of it."]
    spam = " ".join(f.format("The Burning Kiln of Harrowgate") for f in frames)
    plain = " ".join(f.format(x) for f, x in zip(frames, ("a lamp", "two hens", "the ladder", "old letters")))
    two = " ".join(f.format("The Burning Kiln of Harrowgate") for f in frames[:2])
    rows = [(1, spam), (2, plain), (3, two), (4, spam)]
    found = stuffing.stuffed_pages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in found.collect()) == [1, 4]


def test_shares_meet_their_targets_over_the_tables(spark):
    from quire.llm import queries

    rows = queries.p8_shares(spark, "/root/testdata/sf0.01").collect()
    have = sum(r["target_share"] for r in rows if r["tokens"] > 0)
    assert all(abs(r["actual_share"] - r["target_share"] / have) < 0.005 for r in rows if r["tokens"] > 0)


def test_a_page_of_a_megabyte_is_linear(spark):
    import time

    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(5000)]
    prose = " ".join("The " + rng.choice(words) + " of the " + rng.choice(words) + " went to a " + rng.choice(words) + " and was " + rng.choice(words) + "." for _ in range(18_000))
    tags = "\n".join("cheap " + " ".join(rng.choice(words[:40]) for _ in range(12)) for _ in range(12_000))
    rows = [(1, prose), (2, tags)]
    assert all(len(t) > 1_000_000 for _, t in rows)
    began = time.perf_counter()
    found = stuffing.stuffed_pages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [r["doc_id"] for r in found.collect()] == [2] and time.perf_counter() - began < 90
