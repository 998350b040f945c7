import datetime as dt

from pyspark.sql import functions as F

from epistar.operators import lookup, series


def _lookup(spark):
    raw = spark.createDataFrame(
        [("Namibia", "NA", 0), ("Czechia", "CZ", 1), ("Virgin Islands US", "VI", 2), ("United States", "US", 3)],
        "Name string, Code string, _pos long",
    )
    return lookup.prepare_lookup(raw, pos_col="_pos")


def test_code_chain(spark):
    lk = _lookup(spark)
    df = spark.createDataFrame(
        [
            (1, "Namibia", None, None),
            (2, "Czechia ", None, None),
            (3, "Czech Republc", None, None),
            (4, "United States Virgin Islands", None, None),
            (5, "Atlantis", "ATL", "AX"),
            (6, "Nowhere", None, "NW"),
            (7, None, None, None),
        ],
        "id int, country_name string, territory_code string, country_code string",
    )
    got = {r.id: (r.country_code, r.country_name) for r in lookup.resolve_codes(df, lk).collect()}
    assert got[1][0] == "NA"
    assert got[2][0] == "CZ"
    assert got[3][0] is None  # 'czech republc' vs 'czechia' scores below 75
    assert got[4] == ("VI", "United States Virgin Islands")  # matched under its alias, name restored
    assert got[5][0] == "AT"
    assert got[6][0] == "NW"
    assert got[7][0] is None


def test_fuzzy_threshold_is_a_parameter(spark):
    lk = _lookup(spark)
    df = spark.createDataFrame([(1, "Czech Republc")], "id int, country_name string")
    got = lookup.resolve_codes(df, lk, min_score=35).first().country_code
    assert got == "CZ"


def test_fuzzy_ties_go_to_first_lookup_row(spark):
    raw = spark.createDataFrame([("abcx", "B", 1), ("abcy", "A", 0)], "Name string, Code string, _pos long")
    lk = lookup.prepare_lookup(raw, pos_col="_pos")
    names = spark.createDataFrame([("abcz",)], "_match_name string")
    best = lookup.best_fuzzy_matches(names, lk, 70).first()
    assert best.code_fuzzy == "A"


def test_fuzzy_plan_has_no_cross_join(spark):
    lk = _lookup(spark)
    df = spark.createDataFrame([(1, "Czechia x")], "id int, country_name string")
    plan = lookup.resolve_codes(df, lk)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_running_total_nulls_and_buckets(spark):
    rows = [("DE", dt.date(2021, 3, d), v, d) for d, v in [(1, 1), (2, None), (3, 2), (3, 5)]]
    rows.append(("FR", dt.date(2021, 3, 1), 4, 9))
    df = spark.createDataFrame(rows, "t string, d date, v int, pos int")
    for bucket in (None, F.lit(0), F.dayofmonth("d")):
        out = series.running_total(df, ["t"], ["d", "pos"], ["v"], bucket=bucket)
        got = sorted((r.t, r.d.day, r.pos, r.v_cumulative) for r in out.collect())
        assert got == [("DE", 1, 1, 1), ("DE", 2, 2, None), ("DE", 3, 3, 3), ("DE", 3, 3, 8), ("FR", 1, 9, 4)] or got == [
            ("DE", 1, 1, 1), ("DE", 2, 2, None), ("DE", 3, 3, 8), ("DE", 3, 3, 3), ("FR", 1, 9, 4)]


def test_running_total_matches_sequential_sum(spark):
    import random

    rng = random.Random(7)
    rows = [(rng.randint(0, 3), dt.date(2021, 1, 1) + dt.timedelta(days=rng.randint(0, 60)), rng.choice([None, 1, 2, 3]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, d date, v int, pos int")
    out = {r.pos: r.v_cumulative for r in series.running_total(df, ["k"], ["d", "pos"], ["v"], bucket=F.floor(F.unix_date("d") / 7)).collect()}
    expected = {}
    for k in range(4):
        acc = 0
        for _, d, v, pos in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[3])):
            if v is not None:
                acc += v
            expected[pos] = acc if v is not None else None
    assert out == expected


def test_previous_week_gap_counts_zero(spark):
    df = spark.createDataFrame(
        [("CZ", "R1", dt.date(2021, 3, 1), 10), ("CZ", "R1", dt.date(2021, 3, 15), 5), (None, None, dt.date(2021, 3, 8), 2), (None, None, dt.date(2021, 3, 15), 3)],
        "c string, r string, ws date, n int",
    )
    out = series.trailing_two_weeks(df, ["c", "r"], "ws", "n", "n14")
    got = sorted(((r.c, r.ws.day, r.n14) for r in out.collect()), key=str)
    assert got == sorted([("CZ", 1, 10), ("CZ", 15, 5), (None, 8, 2), (None, 15, 5)], key=str)


def test_week_interval_join_equals_between(spark):
    import random

    rng = random.Random(3)
    daily = spark.createDataFrame(
        [(rng.choice("AB"), dt.date(2021, 1, 1) + dt.timedelta(days=rng.randint(0, 90)), i) for i in range(200)],
        "t string, d date, id int",
    )
    weeks = sorted({(t, dt.date(2021, 1, 4) + dt.timedelta(weeks=w)) for t in "AB" for w in range(0, 12, 1) if (w + ord(t)) % 4})
    weekly = spark.createDataFrame([(t, ws, i) for i, (t, ws) in enumerate(weeks)], "t string, ws date, wid int")
    eq = series.week_interval_join(daily, weekly, ["t"], "d", "ws")
    gen = series.interval_join(daily, weekly.withColumn("we", F.date_add("ws", 6)), ["t"], "d", "ws", "we", bucket_days=5)
    brute = daily.alias("a").join(
        weekly.alias("b"), (F.col("a.t") == F.col("b.t")) & F.col("a.d").between(F.col("b.ws"), F.date_add(F.col("b.ws"), 6))
    )
    want = sorted((r.id, r.wid) for r in brute.select("a.id", "b.wid").collect())
    assert sorted((r.id, r.wid) for r in eq.collect()) == want
    assert sorted((r.id, r.wid) for r in gen.collect()) == want


def test_running_total_splits_a_hot_cell_with_a_struct_bucket(spark):
    # one (key, day) cell holds a third of all rows; a (day, pos range) bucket splits it
    rows = [(0, dt.date(2021, 1, 1) if i % 3 == 0 else dt.date(2021, 1, 1) + dt.timedelta(days=i % 30), 1, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k int, d date, v int, pos int")
    bucket = F.struct(F.col("d"), F.floor(F.col("pos") / 100))
    got = {r.pos: r.v_cumulative for r in series.running_total(df, ["k"], ["d", "pos"], ["v"], bucket=bucket).collect()}
    ordered = sorted(rows, key=lambda r: (r[1], r[3]))
    assert all(got[r[3]] == i for i, r in enumerate(ordered, 1))


def test_segment_blocking_finds_the_same_best_matches(spark):
    import random

    rng = random.Random(11)

    def word():
        return "".join(rng.choice("abcde ") for _ in range(rng.randint(1, 16))).strip() or "a"

    def mutate(w):
        w = list(w)
        for _ in range(rng.randint(0, 4)):
            p = rng.randint(0, len(w))
            op = rng.randint(0, 2)
            if op == 0:
                w.insert(p, rng.choice("abcde"))
            elif w:
                q = min(p, len(w) - 1)
                if op == 1:
                    w.pop(q)
                else:
                    w[q] = rng.choice("abcde")
        return "".join(w) or "b"

    base = [word() for _ in range(60)]
    lk = lookup.prepare_lookup(
        spark.createDataFrame([(w, f"C{i}", i) for i, w in enumerate(base)], "Name string, Code string, _pos long"),
        pos_col="_pos",
        materialize=False,
    )
    names = spark.createDataFrame(
        [(mutate(rng.choice(base)),) for _ in range(200)] + [(word(),) for _ in range(60)], "_match_name string"
    )
    for score in (55, 75, 88):
        window = sorted(tuple(r) for r in lookup.best_fuzzy_matches(names, lk, score, "window").collect())
        segments = sorted(tuple(r) for r in lookup.best_fuzzy_matches(names, lk, score, "segments").collect())
        assert window == segments and window


def test_large_lookup_path_resolves_codes(spark):
    lk = _lookup(spark)
    df = spark.createDataFrame([(1, "Czechia x"), (2, "Namibia")], "id int, country_name string")
    got = {r.id: r.country_code for r in lookup.resolve_codes(df, lk, blocking="segments").collect()}
    assert got == {1: "CZ", 2: "NA"}
    plan = lookup.resolve_codes(df, lk, blocking="segments")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fuzzy_lookup_fills_only_unmatched_rows(spark):
    lk = _lookup(spark)
    df = spark.createDataFrame([(1, "Czechia x", None), (2, "Czechia x", "ZZ")], "id int, name string, code_exact string")
    got = {r.id: r.code_fuzzy for r in lookup.fuzzy_lookup(df, "name", lk).collect()}
    assert got == {1: "CZ", 2: None}


def test_name_codes_one_row_per_distinct_name(spark):
    lk = _lookup(spark)
    names = spark.createDataFrame([("Namibia",), ("Namibia",), ("Czechia x",), (None,)], "_name string")
    rows = {r._name: (r._code_exact, r._code_fuzzy) for r in lookup.name_codes(names, lk).collect()}
    assert rows == {"Namibia": ("NA", None), "Czechia x": (None, "CZ")}


def test_interval_join_long_intervals_and_left_rows(spark):
    points = spark.createDataFrame(
        [("A", dt.date(2020, 1, 1) + dt.timedelta(days=d), d) for d in range(0, 400, 9)], "k string, d date, id int"
    )
    intervals = spark.createDataFrame(
        [("A", dt.date(2020, 1, 10), dt.date(2020, 6, 30), 1), ("A", dt.date(2020, 9, 1), dt.date(2020, 9, 1), 2)],
        "k string, s date, e date, iv int",
    )
    out = series.interval_join(points, intervals, ["k"], "d", "s", "e", bucket_days=7, how="left")
    got = {r.id: r.iv for r in out.collect()}
    want = {
        d: (1 if dt.date(2020, 1, 10) <= dt.date(2020, 1, 1) + dt.timedelta(days=d) <= dt.date(2020, 6, 30) else None)
        for d in range(0, 400, 9)
    }
    assert got == want


def test_interval_join_of_many_lengths_equals_all_pairs(spark):
    import random

    rng = random.Random(5)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
    pts = [(rng.choice("AB"), day(rng.randrange(9000)), i) for i in range(400)] + [("A", None, 400), (None, day(1), 401)]
    ivs = [(rng.choice("AB"), day(s := rng.randrange(9000)), day(s + rng.choice([0, 1, 6, 30, 364, 3000])), i) for i in range(120)]
    ivs += [("A", day(50), day(40), 120), ("A", None, day(9), 121), (None, day(0), day(9000), 122)]
    points = spark.createDataFrame(pts, "k string, d date, id int")
    intervals = spark.createDataFrame(ivs, "k string, s date, e date, iv int")
    pairs = {(p[2], v[3]) for p in pts for v in ivs if p[0] and p[0] == v[0] and p[1] and v[1] and v[1] <= p[1] <= v[2]}
    for width in (1, 7):
        got = [(r.id, r.iv) for r in series.interval_join(points, intervals, ["k"], "d", "s", "e", width).collect()]
        assert len(got) == len(pairs) and set(got) == pairs
        left = [(r.id, r.iv) for r in series.interval_join(points, intervals, ["k"], "d", "s", "e", width, "left").collect()]
        lone = {(p[2], None) for p in pts} - {(i, None) for i, _ in pairs}
        assert len(left) == len(pairs) + len(lone) and set(left) == pairs | lone
    none = intervals.where("iv < 0")
    assert series.interval_join(points, none, ["k"], "d", "s", "e").count() == 0
    assert series.interval_join(points, none, ["k"], "d", "s", "e", how="left").count() == len(pts)


def test_long_intervals_take_two_buckets(spark):
    intervals = spark.createDataFrame([("A", dt.date(2000, 1, 1), dt.date(2009, 12, 31))], "k string, s date, e date")
    points = spark.createDataFrame([("A", dt.date(2005, 5, 5))], "k string, d date")
    plan = series.interval_join(points, intervals, ["k"], "d", "s", "e")
    assert plan.count() == 1
    assert "NestedLoop" not in plan._jdf.queryExecution().executedPlan().toString()
