"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from epistar.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = _sorted([tuple(_norm(r[c]) for c in cols) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = _sorted([tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()])
    assert got == want


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["week_start_date", "n_orders", "first_order_date", "last_order_date"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_plans_have_no_cross_or_nested_loop_joins(spark):
    for name, fn in QUERIES.items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


_SPARK_FAMILY = {"int": "int32", "bigint": "int64", "double": "float64", "string": "string", "date": "date", "boolean": "bool"}
_DUCK_FAMILY = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "bool"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    spark_types = {f.name: _SPARK_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString().replace(" ", "")) for f in df.schema.fields}
    rel = duck.sql(E.oracle_sql()[name])
    duck_types = {}
    for c, t in zip(rel.columns, rel.types):
        t = str(t)
        duck_types[c] = _DUCK_FAMILY.get(t, t.lower().replace(" ", ""))
    assert spark_types == duck_types


@pytest.mark.parametrize("name", ["h4_upsert", "a5_suffix_rules", "g1_date_dim", "w1_running_total", "t1_incremental_upsert"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[name](spark, SF)
        cols = sorted(df.columns)
        got = _sorted([tuple(_norm(r[c]) for c in cols) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    idx = [dcols.index(c) for c in cols]
    assert got == _sorted([tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()])


def _is_unpartitioned_window(line: str) -> bool:
    """A window spec without partition columns starts with a sort key or its frame."""
    spec = line[line.index("windowspecdefinition(") + len("windowspecdefinition("):]
    depth, first = 0, ""
    for ch in spec:
        if ch == "," and depth == 0:
            break
        depth += ch == "("
        depth -= ch == ")"
        first += ch
    return first.startswith("specifiedwindowframe") or " ASC" in first or " DESC" in first


def test_window_spec_parser(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10).withColumn("g", F.col("id") % 2)
    cases = [
        (df.withColumn("r", F.row_number().over(Window.orderBy("id"))), True),
        (df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("id"))), False),
        (df.withColumn("r", F.sum("id").over(Window.partitionBy("g"))), False),
    ]
    for frame, expected in cases:
        lines = [l for l in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "windowspecdefinition(" in l]
        assert lines and all(_is_unpartitioned_window(l) == expected for l in lines)


def test_plans_have_no_unpartitioned_window(spark):
    for name, fn in QUERIES.items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "windowspecdefinition(" in line:
                assert not _is_unpartitioned_window(line), (name, line)
