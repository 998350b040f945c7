import datetime as dt
import os

from pyspark.sql import functions as F

from epistar.operators.keys import assign_consecutive_keys, resolve_foreign_keys, with_unknown_member
from epistar.operators.warehouse import (
    insert_rows,
    list_versions,
    load_table,
    read_current,
    refresh_tables,
    upsert_rows,
    validate_against_spec,
)
from epistar.spec import DIM_COUNTRY, DIM_DATE, DIMENSIONS, FACT_CD_DAILY, TableSpec

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
T2 = dt.datetime(2024, 1, 3)


def test_consecutive_keys_match_row_number(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).cast("string").alias("bk")).distinct()
    keyed = assign_consecutive_keys(df.repartition(7), ["bk"], "k", start_after=10, num_partitions=5)
    got = sorted((r.bk, r.k) for r in keyed.collect())
    want = [(bk, 11 + i) for i, bk in enumerate(sorted(r.bk for r in df.collect()))]
    assert got == want


def test_unknown_member_once(spark):
    dim = spark.createDataFrame([(1, "DE", "Germany", "DEU", "Europe")], "dim_country_key int, country_code string, country_name string, territory_code string, continent string")
    once = with_unknown_member(dim, DIM_COUNTRY)
    twice = with_unknown_member(once, DIM_COUNTRY)
    assert twice.filter("dim_country_key = -1").count() == 1
    assert once.filter("dim_country_key = -1").first().country_code == "--"


def test_foreign_keys_unknown_and_missing_column(spark):
    dims = {
        "dim_date": spark.createDataFrame([(1, dt.date(2021, 3, 8))], "dim_date_key int, date date"),
        "dim_country": spark.createDataFrame([(5, "DE")], "dim_country_key int, country_code string"),
        "dim_source": spark.createDataFrame([(2, "TESSy")], "dim_source_key int, source_name string"),
    }
    fact = spark.createDataFrame(
        [(dt.date(2021, 3, 8), "DE", 10), (dt.date(2021, 3, 9), "XX", 3)], "date date, country_code string, cases int"
    )
    out = resolve_foreign_keys(fact, FACT_CD_DAILY, dims, DIMENSIONS)
    got = sorted((r.dim_date_key, r.dim_country_key, r.dim_source_key, r.cases) for r in out.collect())
    assert got == [(-1, -1, -1, 3), (1, 5, -1, 10)]
    assert out.count() == fact.count()  # J6 keeps every fact row


SPEC = TableSpec("t", "fact", ("k",), {"a": "string", "b": "bigint", "c": "string"}, key_types={"k": "bigint"})


def _rows(df):
    return sorted((r.k, r.a, r.b, r.c, r.created_ts, r.updated_ts) for r in df.collect())


def test_validate_rejects_missing_key_and_dedupes(spark):
    assert validate_against_spec(spark.createDataFrame([("x",)], "a string"), SPEC) is None
    rows, keys, supplied = validate_against_spec(spark.createDataFrame([(1, "y", 9), (1, "x", 8)], "k long, a string, extra int"), SPEC)
    assert keys == ["k"] and supplied == ["a"]
    assert [tuple(r) for r in rows.collect()] == [(1, "x")]


def test_upsert_supplied_columns_only(spark):
    base = insert_rows(None, spark.createDataFrame([(1, "a", 10, "keep"), (2, "b", 20, "keep")], "k long, a string, b long, c string"), SPEC, T0)
    src = spark.createDataFrame([(2, "B", None), (3, "c", 30)], "k long, a string, b long")
    out = upsert_rows(base, src, SPEC, T1)
    assert _rows(out) == [
        (1, "a", 10, "keep", T0, T0),
        (2, "B", None, "keep", T0, T1),
        (3, "c", 30, None, T1, T1),
    ]


def test_upsert_twice_is_idempotent(spark):
    base = insert_rows(None, spark.createDataFrame([(1, "a", 10, "x")], "k long, a string, b long, c string"), SPEC, T0)
    src = spark.createDataFrame([(1, "z", 5), (None, "n", 1)], "k long, a string, b long")
    once = upsert_rows(base, src, SPEC, T1)
    twice = upsert_rows(once, src, SPEC, T1)
    # a null key never matches, so it is inserted again; keyed rows are stable
    keyed = lambda df: sorted((r.k, r.a, r.b, r.c, r.created_ts, r.updated_ts) for r in df.collect() if r.k is not None)
    assert keyed(once) == keyed(twice) == [(1, "z", 5, "x", T0, T1)]
    assert once.filter("k IS NULL").count() == 1


def test_dimension_upsert_keeps_keys_and_adds_new(spark):
    src1 = spark.createDataFrame([("DE", "Germany"), ("FR", "France")], "country_code string, country_name string")
    d1 = insert_rows(None, src1, DIM_COUNTRY, T0)
    keys1 = {r.country_code: r.dim_country_key for r in d1.collect()}
    assert keys1 == {"--": -1, "DE": 1, "FR": 2}
    src2 = spark.createDataFrame([("IT", None, "ITA"), ("DE", "Deutschland", "DEU")], "country_code string, country_name string, territory_code string")
    d2 = upsert_rows(d1, src2, DIM_COUNTRY, T1)
    got = {r.country_code: (r.dim_country_key, r.country_name, r.territory_code) for r in d2.collect()}
    assert got["DE"] == (1, "Deutschland", "DEU")
    assert got["FR"] == (2, "France", None)
    assert got["IT"] == (3, None, "ITA")
    assert got["--"][0] == -1


def test_versioned_load_and_refresh(spark, scratch):
    root = os.path.join(scratch, "wh")
    refresh_tables(spark, {"dim_country": DIM_COUNTRY, "dim_date": DIM_DATE}, root, T0)
    table = os.path.join(root, "dim_country")
    assert read_current(spark, table).count() == 1  # only the unknown member
    src = spark.createDataFrame([("DE", "Germany")], "country_code string, country_name string")
    load_table(spark, DIM_COUNTRY, src, table, T1)
    load_table(spark, DIM_COUNTRY, src, table, T2)
    assert list_versions(spark, table) == [1, 2, 3]
    cur = {r.country_code: (r.dim_country_key, r.updated_ts) for r in read_current(spark, table).collect()}
    assert cur == {"--": (-1, T0), "DE": (1, T2)}


def test_consecutive_keys_on_a_generated_calendar(spark):
    from epistar.functions.calendar import date_dimension_rows, date_range_between

    spans = spark.createDataFrame([(dt.date(2020, 1, 6),), (dt.date(2026, 9, 3),)], "d date")
    days = spans.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).select(F.explode(date_range_between("lo", "hi")).alias("date"))
    keyed = assign_consecutive_keys(date_dimension_rows(days), ["date"], "k", num_partitions=13)
    rows = keyed.select("date", "k").collect()
    assert len(rows) == len({r.k for r in rows})
    assert all(r.date == dt.date(2020, 1, 6) + dt.timedelta(days=r.k - 1) for r in rows)


def test_versions_are_clustered_on_the_leading_key(spark, scratch):
    import pyarrow.parquet as pq

    from epistar.operators.warehouse import write_version

    df = spark.range(0, 500).select(((F.col("id") * 7919) % 500).alias("k")).coalesce(1)
    path = write_version(df, os.path.join(scratch, "clustered"), ["k"])
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    keys = pq.read_table(os.path.join(path, files[0])).column("k").to_pylist()
    assert keys == sorted(keys)


def test_size_checked_broadcast_and_roles(spark):
    from epistar.operators.sizing import bounded_broadcast, row_count_at_most

    df = spark.range(0, 10)
    assert row_count_at_most(df, 10) and not row_count_at_most(df, 9)
    small = bounded_broadcast(df, 10)
    big = bounded_broadcast(df, 5)
    joined_small = spark.range(0, 100).join(small, "id")._jdf.queryExecution().optimizedPlan().toString()
    joined_big = spark.range(0, 100).join(big, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in joined_small.lower() and "broadcast" not in joined_big.lower()
    roles = FACT_CD_DAILY.date_roles
    assert roles["dim_week_start_date_key"] == "week_start_date" and roles["dim_date_key"] == "date"
