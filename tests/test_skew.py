from quire.operators import skew


def test_a_key_of_a_third_of_all_rows_is_spread_and_loses_nothing(spark):
    rows = [(1 if i % 3 == 0 else i, i) for i in range(3000)]
    index = spark.createDataFrame(rows, "k bigint, a bigint")
    probe = spark.createDataFrame([(k, i) for k, i in rows if i < 60], "k bigint, b bigint")
    want = sorted((k, b, a) for k, b in [(r[0], r[1]) for r in rows if r[1] < 60] for k2, a in rows if k2 == k)
    assert sorted((r["k"], r["b"], r["a"]) for r in skew.salted_join(probe, index, ["k"], hot=100).collect()) == want
    salts = skew.hot_keys(index, ["k"], 100).collect()
    assert [(r["k"], r["__salts"]) for r in salts] == [(1, 11)]
    assert skew.salted_join(probe.limit(0), index, ["k"]).count() == 0 and skew.hot_keys(index, ["k"]) is None
