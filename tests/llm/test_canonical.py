import pytest

from quire.llm import canonical, thesaurus

TERMS = [(1, "Cooking"), (2, "Gardening"), (3, "Fairs"), (4, "Science fiction"), (5, "Oceanography"), (6, "Naval history"), (7, "Baking"), (8, "Banking"), (9, "Child rearing")]


@pytest.mark.parametrize("entry, found", [
    ("Cooking, gardening", [1, 2]), ("Cookery, Gardening", [1, 2]), ("Fairs, science", []), ("History, naval", [6]), ("Painting, sign", []), ("Gardening, France", [2]),
])
def test_comma_entries(entry, found):
    assert canonical.resolve(canonical.Trie(TERMS, thesaurus.ALIASES), entry) == found


def test_search_returns_neighbours_of_an_exact_hit():
    assert canonical.Trie(TERMS).search("baking") == [(0, 7), (1, 8)]


def test_terms_of_one_form_are_all_found():
    trie = canonical.Trie([(1, "Alpha"), (2, "Alpha!"), (3, "Beta")], [("First letter", "alpha"), ("first letter", "Beta"), ("nothing", "Gamma")])
    assert trie.search("alpha") == [(0, 1), (0, 2)] and trie.search("first letter") == [(0, 1), (0, 2), (0, 3)] and trie.search("nothing") == []


def test_aliases_come_from_a_table_and_a_hot_entry_is_whole(spark, monkeypatch):
    from quire.operators import skew

    monkeypatch.setattr(skew.salted_join, "__defaults__", (20,))
    rows = [(i, ["Tilling"] if i % 3 == 0 else [f"Nothing {i}"]) for i in range(150)]
    entries = canonical.entries_of(spark.createDataFrame(rows, "id bigint, subjects array<string>"), "gutendex", "id", "subjects")
    terms, aliases = spark.createDataFrame(TERMS, "term_id bigint, term string"), spark.createDataFrame([("tilling", "Gardening"), (None, "x")], "alias string, term string")
    got = canonical.canonical_terms(entries, terms, aliases).collect()
    assert len(got) == 50 and {r["term_id"] for r in got} == {2}
    assert canonical.unmatched(entries, terms, aliases).count() == 100
