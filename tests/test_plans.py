"""Plan shape: the properties that matter at scale, read from the physical plans."""

import datetime as dt
import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from epistar.operators import dedupe, series

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_used_columns(spark):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", df_explain(E.queries()["w1_running_total"](spark, SF)))
    assert schemas and all("o_orderpriority" not in s for s in schemas)


def df_explain(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = df_explain(dedupe.keep_first(orders.filter(F.col("o_orderstatus") == "O"), ["o_custkey", "o_orderkey"], ["o_custkey"], ["o_orderkey"]))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)]" in text


def test_merges_aggregate_partially_before_the_shuffle(spark):
    for name in ("a4_first_non_null", "a5_suffix_rules", "a1_keep_first"):
        text = df_explain(E.queries()[name](spark, SF))
        # a partial aggregate sits below every exchange feeding the final one
        assert re.search(r"(HashAggregate|SortAggregate)[\s\S]*Exchange[\s\S]*(HashAggregate|SortAggregate)", text), name


def test_running_total_windows_are_split(spark):
    df = spark.createDataFrame([(1, dt.date(2021, 1, 1), 1, 0)], "k int, d date, v int, pos int")
    plan = _plan(series.running_total(df, ["k"], ["d", "pos"], ["v"]))
    # the row-level window is partitioned by range *and* key, never by key alone; what earlier ranges carry over is broadcast
    specs = re.findall(r"Window \[[^\]]*\], \[([^\]]*)\]", plan)
    assert any("_range" in s for s in specs) and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_hot_key_running_total_is_exact(spark):
    # one key holds a third of the rows
    rows = [(0 if i % 3 == 0 else i % 50, dt.date(2021, 1, 1) + dt.timedelta(days=i % 400), 1, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, d date, v int, pos int")
    out = series.running_total(df, ["k"], ["d", "pos"], ["v"])
    got = {r.pos: r.v_cumulative for r in out.collect()}
    for k in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[3]))
        for i, r in enumerate(ordered, 1):
            assert got[r[3]] == i


def test_one_hot_cell_is_spread_over_ranges(spark):
    # one key and one day hold a third of the rows, another third has neither
    def cell(i):
        return (7, dt.date(2021, 1, 1)) if i % 3 == 0 else (None, None) if i % 3 == 1 else (i % 9, dt.date(2021, 1, 1) + dt.timedelta(days=i % 40))

    rows = [(*cell(i), None if i % 11 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, d date, v int, pos int")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        for keys in (["k"], []):
            out = series.running_total(df, keys, ["d", "pos"], ["v"])
            got = {r.pos: r.v_cumulative for r in out.collect()}
            sums, want = {}, {}
            for k, d, v, pos in sorted(rows, key=lambda r: (r[1] is None, r[1] or dt.date.min, r[3])):
                group = k if keys else 0
                sums[group] = sums.get(group, 0) + (v or 0)
                want[pos] = None if v is None else sums[group]
            assert got == want
            # the ranges follow the rows: none holds much more than its share
            landed = spark.read.parquet(*out.inputFiles()).groupBy("_range").count().collect()
            assert len(landed) == 4 and max(r["count"] for r in landed) < 1.5 * len(rows) / 4
    finally:
        spark.conf.set(key, "true")


def test_dimension_side_is_broadcast_after_size_check(spark):
    plan = _plan(E.queries()["j6_dim_keys"](spark, SF))
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan
