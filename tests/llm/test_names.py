import random

from quire.llm import names


def entities(spark, given):
    rows = names.name_entities(spark.createDataFrame([(n, 1) for n in given], "name string, entity int")).collect()
    return {r["name"]: r["entity"] for r in rows}


def test_segment_join_misses_nothing(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(140)})
    got = {(frozenset((r["shorter"], r["longer"])), r["distance"]) for r in names.segment_join(spark.createDataFrame([(w,) for w in words], "t string"), "t", long=6).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    near = lambda a, b, d: d <= 1 or d == 2 and (max(len(a), len(b)) >= 6 or sorted(a) == sorted(b))
    want = {(frozenset((a, b)), d) for i, a in enumerate(words) for b in words[:i] if near(a, b, d := distance(a, b)) and min(len(a), len(b)) > 2}
    # Texts shorter than the number of segments have an empty segment, which is no key.
    assert want <= got and all(d <= 2 for _, d in got)


def test_variants_of_persons(spark):
    one = ["Rebecca Lambert Jorolfafeld", "Jorolfafeld, Rebecca", "Becky L. Jorolfafeld", "Rebecca \"Becky\" Jorolfafeld", "R. Jorolfafeld", "Jorolfafeld RL", "by Rebecca Jorolfafeld",
           "Jorolfafeld, R. L. (Rebecca Lambert)", "Dr. Rebecca Jorolfafeld", "Jöro1fafeld, Rebecca", "Jorolfafeld, Rebecca, 1900-1950", "Rebecca Jorolfafeld (Author)", "Rebeca Joroltafeld", "Jorolfafeld Rebecca"]
    other = ["Octavia Jorolfafeld", "Jorolfafeld, O."]
    got = entities(spark, [*one, *other, *one])
    assert len({got[n] for n in one}) == 1 and len({got[n] for n in other}) == 1 and got[one[0]] != got[other[0]]


def test_ambiguous_initials_name_nobody(spark):
    got = entities(spark, ["Anna Plovdivsky", "Plovdivsky, Anna", "Agnes Plovdivsky", "Plovdivsky, Agnes", "A. Plovdivsky"])
    assert got["A. Plovdivsky"] not in (got["Anna Plovdivsky"], got["Agnes Plovdivsky"])


def test_organisations(spark):
    forms = ["Novul Botanical Society", "The Novul Botanical Society", "Botanical Society, Novul", "Novul (Botanical Society)", "Novul Botanical Soc.", "Novul Botanical Society, issuing body"]
    got = entities(spark, [*forms, "Kimes Botanical Society"])
    assert len({got[f] for f in forms}) == 1 and got["Kimes Botanical Society"] != got[forms[0]]


def test_nobody_and_odd_values(spark):
    got = entities(spark, [None, "", "  ", "???", "Anonymous", "Various", "x" * 5000, "Ana", "Ana"])
    assert "Anonymous" not in got and "" not in got and "Ana" in got
    assert names.name_pairs(spark.createDataFrame([], "name string")).count() == 0


def test_pairs_are_ordered(spark):
    pairs = names.name_pairs(spark.createDataFrame([("Ana Velasquez",), ("Velasquez, Ana",), ("ana velasquez",)], "name string")).collect()
    assert len(pairs) == 3 and all(p["name_a"] < p["name_b"] for p in pairs)


def test_a_surname_of_a_third_of_all_names(spark):
    given = [f"{a}{b}{c}" for a in "BDFGKL" for b in "aeiou" for c in ("rnold", "ntonia", "stolf")]
    many = [f"{g} Plovdivsky" for g in given] + [f"Plovdivsky, {g}" for g in given] + [f"{g} Xa{i:03d}wov" for i, g in enumerate(given)]
    got = entities(spark, many)
    assert all(got[f"{g} Plovdivsky"] == got[f"Plovdivsky, {g}"] for g in given) and len(set(got.values())) > 150
