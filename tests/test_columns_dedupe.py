from epistar.operators import columns as colops
from epistar.operators import dedupe, projection


def test_rename_is_simultaneous_in_any_order(spark):
    df = spark.createDataFrame([("DEU", "DE", "Germany")], "country_code string, geoId string, country string")
    for mapping in (
        {"country_code": "territory_code", "geoId": "country_code", "country": "country_name"},
        {"geoId": "country_code", "country_code": "territory_code", "country": "country_name"},
    ):
        out = colops.rename_columns(df, mapping)
        assert sorted(out.columns) == ["country_code", "country_name", "territory_code"]
        r = out.first()
        assert (r.territory_code, r.country_code, r.country_name) == ("DEU", "DE", "Germany")


def test_rename_two_sources_one_target(spark):
    df = spark.createDataFrame([(None, "x"), ("y", None)], "Country string, geo_country string")
    out = colops.rename_columns(df, {"Country": "country_name", "geo_country": "country_name"})
    assert out.columns == ["country_name"]
    assert sorted(r.country_name for r in out.collect()) == ["x", "y"]


def test_snake_and_replace():
    assert colops.camel_to_snake("DoseAdditional1") == "dose_additional1"
    assert colops.camel_to_snake("NumberDosesReceived") == "number_doses_received"
    assert colops.camel_to_snake("YearWeekISO") == "year_week_iso"
    assert colops.camel_to_snake("year_week") == "year_week"


def test_present_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert colops.present_in(df, ["a", "z"]) == ["a"] and colops.present_in(df, None) == [] and colops.present_in(df, ["z"]) == []
    assert colops.has_all(df, ["a"]) and not colops.has_all(df, []) and not colops.has_all(df, ["a", "z"])


def test_fill_numeric_only_and_coerce(spark):
    df = spark.createDataFrame([(None, None, "n/a"), (1, "x", "12.0")], "n int, s string, t string")
    out = colops.fill_numeric_zero(colops.coerce_numbers(df, ["t"]))
    rows = sorted(out.collect(), key=lambda r: r.n)
    assert (rows[0].n, rows[0].s, rows[0].t) == (0, None, 0)
    assert rows[1].t == 12


def test_level_label_and_map(spark):
    df = spark.createDataFrame([("DE", "DE"), ("DE1", "DE"), (None, "DE")], "r string, c string")
    got = [r.l for r in df.select(projection.level_label("r", "c").alias("l")).collect()]
    assert got == ["country", "region", "region"]
    df = spark.createDataFrame([("dark red",), ("purple",)], "c string")
    got = [r.d for r in df.select(projection.map_with_fallback("c", {"dark red": "Weighted rate is 300 or more"}).alias("d")).collect()]
    assert got == ["Weighted rate is 300 or more", "purple"]


def test_level_split_needs_its_columns(spark):
    df = spark.createDataFrame([("cases", 5), ("deaths", 1)], "indicator string, weekly_count int")
    splits = [
        projection.LevelSplit("weekly_count", "indicator", {"cases": "cases"}),
        projection.LevelSplit("rate_14_day", "indicator", {"cases": "rate"}),
    ]
    out = projection.split_by_level(df, splits)
    assert "rate" not in out.columns
    assert sorted((r.indicator, r.cases) for r in out.collect()) == [("cases", 5), ("deaths", None)]


def test_merged_order_is_that_of_one_row(spark):
    df = spark.createDataFrame([("k", 1, "A", 50), ("k", None, "B", 3)], "k string, v int, file string, pos int")
    r = dedupe.merge_first_non_null(df, ["k"], ["file", "pos"]).first()
    assert (r.v, r.file, r.pos) == (1, "A", 50)


def test_large_integers_stay_exact(spark):
    rows = [("9210000000000000000",), ("9007199254740993",), ("9223372036854775807",), ("9223372036854775808",), ("12.0",), ("12.7",), ("-3.9",), ("x",), (None,), ("1.2e1",)]
    df = spark.createDataFrame(rows, "c string")
    got = [r[0] for r in df.select(colops.tolerant_number("c")).collect()]
    assert got == [9210000000000000000, 9007199254740993, 9223372036854775807, None, 12, 12, -3, None, None, 12]


def test_row_hash_keeps_the_place_of_a_null(spark):
    from epistar.functions.text import row_hash

    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "b", "")], "x string, y string, z string")
    assert df.select(row_hash("x", "y", "z").alias("h")).distinct().count() == 3


def test_undated_rows_come_last_in_running_totals(spark):
    from epistar.operators.series import running_total

    df = spark.createDataFrame([("k", None, 100), ("k", "2021-01-02", 2), ("k", "2021-01-01", 1), (None, "2021-01-01", 7)], "k string, d string, v int")
    got = {(r.k, r.d): r.v_cumulative for r in running_total(df, "k", "d", "v").collect()}
    assert got == {("k", "2021-01-01"): 1, ("k", "2021-01-02"): 3, ("k", None): 103, (None, "2021-01-01"): 7}


def test_first_non_null_interleaved(spark):
    df = spark.createDataFrame([(1, None, 2, 0), (1, 1, None, 1), (1, 9, 9, 2)], "k int, a int, b int, pos int")
    r = dedupe.merge_first_non_null(df, ["k"], ["pos"]).first()
    assert (r.a, r.b) == (1, 2)


def test_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, 1, 0), (None, 2, 1)], "k string, a int, pos int")
    out = dedupe.merge_first_non_null(df, ["k"], ["pos"]).collect()
    assert len(out) == 1 and out[0].a == 1


def test_merge_independent_of_partitioning(spark):
    rows = [(i % 7, (i * 37) % 11 if i % 3 else None, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, a int, pos int")
    base = sorted(tuple(r) for r in dedupe.merge_first_non_null(df, ["k"], ["pos"]).collect())
    for n in (1, 3, 17):
        again = sorted(tuple(r) for r in dedupe.merge_first_non_null(df.repartition(n), ["k"], ["pos"]).collect())
        assert again == base


def test_suffix_rules(spark):
    df = spark.createDataFrame(
        [("a", 1, 2.0, 5, 5, "x", 0, "p"), ("a", None, 4.0, 7, 7, "y", 1, None), ("a", 2, None, 1, 1, "x", 2, "q"),
         ("b", None, None, None, None, None, 3, None), ("c", None, 1.0, 1, 1, None, 4, None), ("c", None, None, None, None, None, 5, None)],
        "k string, v_sum int, v_mean double, v_max int, v_min int, tag_set string, pos int, other string",
    )
    got = {r.k: r for r in dedupe.merge_by_suffix(df, ["k"], ["pos"]).collect()}
    a = got["a"]
    assert (a.v_sum, a.v_mean, a.v_max, a.v_min, a.tag_set, a.other) == (3, 3.0, 7, 1, ["x", "y"], "p")
    assert got["b"].v_sum is None and got["b"].tag_set == []
    assert got["c"].v_sum == 0


def test_keep_first_and_distinct(spark):
    df = spark.createDataFrame([("x", 1, 2), ("x", 2, 1), ("y", 3, 3)], "k string, v int, pos int")
    got = {r.k: r.v for r in dedupe.keep_first(df, ["k", "v", "missing"], ["k"], ["pos"]).collect()}
    assert got == {"x": 2, "y": 3}
    assert dedupe.keep_first(df.select("k"), None, None).count() == 2


def test_two_distinct_keys_equal_measures_kept(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 1, 1)], "k string, v int, pos int")
    assert dedupe.keep_first(df, ["k", "v"], ["k"], ["pos"]).count() == 2


def test_split_by_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    uniq, dup = dedupe.split_by_duplicates(df, ["k"])
    assert sorted(r.v for r in uniq.collect()) == [3]
    assert sorted(r.v for r in dup.collect()) == [1, 2, 4, 5]


def test_union_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, opt string")
    b = spark.createDataFrame([(2,)], "id int")
    rows = sorted(tuple(r) for r in dedupe.union_all(a, b, a).collect())
    assert rows == [(1, "x"), (1, "x"), (2, None)]


def test_has_rows(spark):
    dim = spark.createDataFrame([(-1, "u")], "k int, v string")
    assert not dedupe.has_rows(dim, "k")
    assert dedupe.has_rows(dim)


def test_long_to_wide(spark):
    df = spark.createDataFrame(
        [("w1", "DE", "cases", 10, 0), ("w1", "DE", "deaths", 1, 1), ("w1", "DE", "cases", None, 2)],
        "yw string, t string, indicator string, n int, pos int",
    )
    r = dedupe.long_to_wide(df, ["yw", "t"], "indicator", {"cases": ("cases", "n"), "deaths": ("deaths", "n")}, ["pos"]).first()
    assert (r.cases, r.deaths) == (10, 1)


def test_combine_matches_on_the_row_key(spark):
    import pytest

    from epistar.operators.dedupe import combine

    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, a string")
    b = spark.createDataFrame([(1, 10), (None, 30), (9, 90)], "k int, b int")
    c = spark.createDataFrame([(None, 0.5)], "k int, c double")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert rows(combine(a, b, on="k")) == sorted([(1, "a", 10), (None, "c", 30)], key=str)
    assert rows(combine(a, None, b, c, on=["k"], how="left")) == sorted([(1, "a", 10, None), (2, "b", None, None), (None, "c", 30, 0.5)], key=str)
    assert rows(combine(a, on="k")) == rows(a)
    for bad in (lambda: combine(a, a, on="k"), lambda: combine(on="k"), lambda: combine(a, b, on="k", how="outer"), lambda: combine(a, b, on=[])):
        with pytest.raises(ValueError):
            bad()
