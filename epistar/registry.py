"""Registered queries over the driver tables, one per operator family.

Each query re-expresses an operator of the surveillance ETL on the TPC-H-like
driver tables (the same shapes under other names: orders play daily reports,
ISO weeks of order dates play reporting weeks, customer/nation/region play
countries and continents, events play indicator rows). Every query reads
whole tables; none filters rows away to stay cheap.

``ORACLE_SQL`` holds the DuckDB SQL that must give the same rows.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epistar.functions import calendar as cal
from epistar.functions import text as tx
from epistar.functions.text import PLAIN_FORMS
from epistar.operators import columns as colops
from epistar.operators import dedupe, lookup, projection, series
from epistar.operators.keys import assign_consecutive_keys, resolve_foreign_keys, with_unknown_member
from epistar.operators.snapshot import publish, read_snapshot
from epistar.operators.warehouse import insert_rows, load_table, refresh_tables, upsert_rows
from epistar.plans.load import load_warehouse
from epistar.plans.vaccines import TARGET_DESCRIPTIONS
from epistar.session import cut_lineage, scratch_path
from epistar.sources.files import read_cleansed, read_lookup_csv, unseen_files, write_datasets
from epistar.spec import TableSpec

QueryFn = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_date(df: DataFrame) -> DataFrame:
    return df.withColumn("order_date", F.col("o_orderdate").cast("date"))


def _money(c) -> F.Column:
    """Exact money arithmetic: two decimals."""
    return colops.col_of(c).cast("decimal(18,2)")


# ----------------------------------------------------------------- calendar


def _orders_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the calendar spanning the orders' dates (no fixed range)."""
    orders = _order_date(_t(spark, sf_dir, "orders"))
    bounds = orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    days = bounds.select(F.explode(cal.date_range_between("lo", "hi")).alias("date"))
    return cal.date_dimension_rows(days)


def g1_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1+F10: calendar over the orders' span, with orders per day (0 on empty days)."""
    dim = _orders_date_dim(spark, sf_dir)
    per_day = (
        _order_date(_t(spark, sf_dir, "orders")).groupBy(F.col("order_date").alias("date")).agg(F.count(F.lit(1)).alias("n_orders"))
    )
    return dim.join(per_day, "date", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


def f2_iso_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week labels in both source spellings parsed back to Monday/Sunday."""
    orders = _order_date(_t(spark, sf_dir, "orders"))
    label = cal.iso_year_week_label("order_date")
    # urgent orders use the short ``YYYY-ww`` spelling, the rest ``YYYY-Www``
    year_week = F.when(F.col("o_orderpriority").startswith("1"), F.regexp_replace(label, "-W", "-")).otherwise(label)
    labelled = orders.select(year_week.alias("year_week"))
    year, week = cal.year_week_parts("year_week")
    start = cal.iso_week_start(year, week)
    parsed = labelled.select(
        "year_week",
        year.alias("iso_year"),
        week.alias("iso_week"),
        start.alias("week_start_date"),
        cal.iso_week_end(start).alias("week_end_date"),
        cal.iso_week_valid(year, week).alias("valid_week"),
    )
    return parsed.groupBy(*parsed.columns).agg(F.count(F.lit(1)).alias("n_orders"))


def _keyed_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _orders_date_dim(spark, sf_dir)
    return assign_consecutive_keys(dim, ["date"], "dim_date_key")


def j7_role_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6+J7: one date dimension joined in three roles (date, week start, week end)."""
    dim = _keyed_date_dim(spark, sf_dir)
    spec = TableSpec(
        "fact_orders",
        "fact",
        ("dim_date_key", "dim_week_start_date_key", "dim_week_end_date_key"),
        {},
        foreign_keys=(
            ("dim_date_key", "dim_date"),
            ("dim_week_start_date_key", "dim_date"),
            ("dim_week_end_date_key", "dim_date"),
        ),
    )
    dim_spec = TableSpec("dim_date", "dimension", ("date",), {}, surrogate_key="dim_date_key")
    fact = _order_date(_t(spark, sf_dir, "orders")).select(
        "o_orderkey",
        F.col("order_date").alias("date"),
        F.trunc("order_date", "week").alias("week_start_date"),
        F.date_add(F.trunc("order_date", "week"), 6).alias("week_end_date"),
    )
    out = resolve_foreign_keys(fact, spec, {"dim_date": dim}, {"dim_date": dim_spec})
    return out.select("o_orderkey", "dim_date_key", "dim_week_start_date_key", "dim_week_end_date_key")


# ----------------------------------------------------------------- merging


def a1_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: first event per user (by event id), projected columns only."""
    events = _t(spark, sf_dir, "events")
    first = dedupe.keep_first(events, ["user_id", "event_id", "event_type", "value"], ["user_id"], ["event_id"])
    return first.select(
        "user_id",
        F.col("event_id").alias("first_event_id"),
        F.col("event_type").alias("first_event_type"),
        F.col("value").alias("first_value"),
    )


def _events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose small values read as missing, so merges meet interleaved nulls."""
    events = _t(spark, sf_dir, "events")
    return events.withColumn("value", F.when(F.col("value") >= 10, F.col("value")))


# A wide result has a column a type: more types than this are no dimension to turn into columns, and fail.
MAX_EVENT_TYPES = 1000


def _event_types(events: DataFrame) -> list[str]:
    found = events.where("event_type is not null").select("event_type").distinct().limit(MAX_EVENT_TYPES + 1).collect()
    if len(found) > MAX_EVENT_TYPES:
        raise ValueError(f"more than {MAX_EVENT_TYPES} event types")
    return sorted(r["event_type"] for r in found)


def a4_first_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4+A6: per user, the first non-null value of each event type (long -> wide)."""
    events = _events_with_gaps(spark, sf_dir)
    value_map = {f"{t}_value": (t, "value") for t in _event_types(events)}
    # one aggregation: the per-type columns and the first value of any type
    wide = dedupe.long_to_wide(events, ["user_id"], "event_type", value_map, ["event_id"], carry=["value"])
    return wide.withColumnRenamed("value", "first_any_value")


def a5_suffix_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: merge by column suffix (_sum, _mean, _max, _min, _set, else first non-null)."""
    events = _events_with_gaps(spark, sf_dir)
    staged = events.select(
        "event_type",
        F.col("ts").cast("date").alias("event_date"),
        "event_id",
        _money("value").alias("value_sum"),
        F.col("value").alias("value_mean"),
        F.col("value").alias("value_max"),
        F.col("value").alias("value_min"),
        F.hour("ts").alias("hour_set"),
        "props",
    )
    merged = dedupe.merge_by_suffix(staged, ["event_type", "event_date"], ["event_id"])
    return merged.select(
        "event_type",
        "event_date",
        F.col("value_sum").cast("decimal(18,2)").alias("value_sum"),
        F.round("value_mean", 4).alias("value_mean"),
        "value_max",
        "value_min",
        F.array_join("hour_set", ",").alias("hour_set"),
        F.col("props").alias("first_props"),
    )


def a3_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3+J5: split rows by whether their (user, type, day) key repeats; count each side."""
    events = _t(spark, sf_dir, "events").withColumn("event_date", F.col("ts").cast("date"))
    sized = dedupe.with_group_size(events, ["user_id", "event_type", "event_date"], "n")
    # both sides are counted in one pass over the rows
    return sized.groupBy("event_type").agg(F.count_if(F.col("n") == 1).alias("n_unique_rows"), F.count_if(F.col("n") > 1).alias("n_dupe_rows"))


def u1_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers unioned by name; missing columns become null."""
    cust = _t(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    supp = _t(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"),
    )
    return dedupe.union_all(cust, supp)


# ----------------------------------------------------------------- projection


def p1_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simultaneous renames (a swap), CamelCase -> snake_case, pruning."""
    cust = _t(spark, sf_dir, "customer")
    renamed = colops.rename_columns(
        cust,
        {"c_custkey": "CustomerKey", "c_name": "c_mktsegment", "c_mktsegment": "c_name", "missing_col": "never"},
    )
    snake = colops.snake_case_columns(renamed)
    snake = colops.replace_in_names(snake, "c_acctbal", "account_balance")
    pruned = colops.select_existing(snake, ["customer_key", "c_name", "c_mktsegment", "account_balance", "absent"])
    return colops.drop_existing(pruned, "absent_too")


def p8_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values projected into per-flag columns, null where the flag differs."""
    li = _t(spark, sf_dir, "lineitem")
    splits = [
        projection.LevelSplit("l_quantity", "l_returnflag", {"R": "qty_returned", "A": "qty_accepted", "N": "qty_none"}),
        projection.LevelSplit("l_extendedprice", "l_linestatus", {"F": "price_final"}),
        projection.LevelSplit("no_such_column", "no_such_column", {"x": "never"}),
    ]
    out = projection.split_by_level(li, splits)
    return out.select("l_orderkey", "l_linenumber", "qty_returned", "qty_accepted", "qty_none", "price_final")


# Order status descriptions; unknown statuses describe themselves.
ORDER_STATUS_TEXT = {"F": "fulfilled", "O": "open"}


def p10_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10+P20: value map with fallback to the original value; lower-cased labels."""
    orders = _t(spark, sf_dir, "orders")
    mapped = orders.select(
        "o_orderstatus",
        projection.map_with_fallback("o_orderstatus", ORDER_STATUS_TEXT).alias("status_text"),
        "o_orderpriority",
    )
    mapped = colops.lower_case(mapped, "o_orderpriority", "not_there")
    return mapped.groupBy("o_orderstatus", "status_text", F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


def p16_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tolerant numeric parse (bad text -> null), then numeric nulls -> 0 only."""
    events = _t(spark, sf_dir, "events")
    raw = events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.regexp_extract("props", r":\s*([^,}]*)", 1))
        .alias("k"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("label"),
    )
    coerced = colops.coerce_numbers(raw, ["k"], "bigint")
    filled = colops.fill_numeric_zero(coerced)
    return colops.cast_existing(filled, {"k": "bigint", "absent": "int"})


def _customer_target_group() -> F.Column:
    """A target-group label per customer in one of the source spellings."""
    n = F.col("c_nationkey").cast("string")
    n_hi = (F.col("c_nationkey") + 4).cast("string")
    n_up = (F.col("c_nationkey") + 1).cast("string")
    form = F.col("c_custkey") % 9
    return (
        F.when(form == 0, F.concat(F.lit("Age"), n, F.lit("_"), n_hi))
        .when(form == 1, F.concat(F.lit("Age<"), n_up))
        .when(form == 2, F.concat(F.lit("Age"), n, F.lit("+")))
        .when(form == 3, F.concat(F.lit("1_Age"), n, F.lit("+")))
        .when(form == 4, F.concat(F.lit("1_Age<"), n_up))
        .when(form == 5, F.lit("AgeUNK"))
        .when(form == 6, F.lit("ALL"))
        .when(form == 7, F.lit("HCW"))
        .otherwise(F.lit("LTCF"))
    )


def f8_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8+P10: age limits and descriptions of target-group labels, customers per group."""
    cust = _t(spark, sf_dir, "customer").select(_customer_target_group().alias("target_group"))
    lower, upper = tx.age_band("target_group")
    banded = cust.select(
        "target_group",
        lower.alias("age_lower_limit"),
        upper.alias("age_upper_limit"),
        projection.map_with_fallback("target_group", TARGET_DESCRIPTIONS).alias("target_description"),
    )
    return banded.groupBy(*banded.columns).agg(F.count(F.lit(1)).alias("n_customers"))


def f7_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``|``-joined composite key and its SHA-256."""
    orders = _order_date(_t(spark, sf_dir, "orders"))
    keys = ["o_orderkey", "o_custkey", "o_orderstatus", "order_date"]
    return orders.select("o_orderkey", tx.composite_key(*keys).alias("row_key"), tx.row_hash(*keys).alias("row_hash"))


# ----------------------------------------------------------------- series


def w1_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running total of order value per customer; pending orders are null and skipped."""
    orders = _order_date(_t(spark, sf_dir, "orders")).select(
        "o_orderkey",
        "o_custkey",
        "order_date",
        F.when(F.col("o_orderstatus") != "P", _money("o_totalprice")).alias("price"),
    )
    out = series.running_total(orders, ["o_custkey"], ["order_date", "o_orderkey"], ["price"])
    return out.select("o_orderkey", "o_custkey", F.col("price_cumulative").cast("decimal(18,2)").alias("running_price"))


def _weekly_nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _order_date(_t(spark, sf_dir, "orders"))
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
    return joined.groupBy("c_nationkey", F.trunc("order_date", "week").alias("week_start_date")).agg(
        F.count(F.lit(1)).alias("n_orders_7")
    )


def j9_prev_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9+W2: 14-day count = this week's + last week's (0 when last week is missing)."""
    weekly = _weekly_nation_orders(spark, sf_dir)
    out = series.trailing_two_weeks(weekly, ["c_nationkey"], "week_start_date", "n_orders_7", "n_orders_14")
    return out.select("c_nationkey", "week_start_date", "n_orders_7", "n_orders_14")


def j4_week_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order counts matched to the weekly shipped quantity of the week holding the day."""
    daily = (
        _order_date(_t(spark, sf_dir, "orders"))
        .groupBy(F.col("o_orderstatus").alias("status"), F.col("order_date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    weekly = (
        _t(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_linestatus").alias("status"), F.trunc(F.col("l_shipdate").cast("date"), "week").alias("week_start_date"))
        .agg(F.sum(_money("l_quantity")).cast("decimal(18,2)").alias("week_qty"))
    )
    out = series.week_interval_join(daily, weekly, ["status"], "date", "week_start_date", "inner")
    return out.select("status", "date", "n_orders", "week_start_date", "week_qty")


# ----------------------------------------------------------------- lookups


def _segment_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The true segment list (derived from the data) with a code and a lookup order."""
    seg = _t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("Name")).distinct()
    seg = seg.withColumn("Code", F.substring("Name", 1, 3))
    seg = assign_consecutive_keys(seg, ["Name"], "_pos")
    return lookup.prepare_lookup(seg, "Name", "Code", "_pos")


def _perturbed_segment() -> F.Column:
    """A source spelling of the customer's segment: exact, typo, suffix, padded, reversed or wrong end."""
    seg = F.col("c_mktsegment")
    form = F.col("c_custkey") % 6
    dropped = F.expr(
        "lower(concat(substring(c_mktsegment, 1, CAST(c_custkey % length(c_mktsegment) AS INT)),"
        " substring(c_mktsegment, CAST(c_custkey % length(c_mktsegment) AS INT) + 2)))"
    )
    wrong_end = F.expr("concat(substring(c_mktsegment, 1, length(c_mktsegment) - 1), 'X')")
    return (
        F.when(form == 0, seg)
        .when(form == 1, dropped)
        .when(form == 2, F.concat(seg, F.lit(" CO")))
        .when(form == 3, F.concat(F.lit("THE  "), seg))
        .when(form == 4, F.reverse(seg))
        .otherwise(wrong_end)
    )


def _fuzzy_best(spark: SparkSession, sf_dir: str, blocking: str) -> DataFrame:
    lk = _segment_lookup(spark, sf_dir)
    names = _t(spark, sf_dir, "customer").select(_perturbed_segment().alias("name"))
    exact = lookup.exact_lookup(names, "name", lk, "code_exact")
    unmatched = exact.filter(F.col("code_exact").isNull()).select(F.col("name").alias("_match_name"))
    best = lookup.best_fuzzy_matches(unmatched, lk, lookup.FUZZY_MIN_SCORE, blocking, PLAIN_FORMS)
    return best.select(F.col("_match_name").alias("name"), "match_name", "match_score", F.col("code_fuzzy").alias("code"))


def j2_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2+F12+O2: best lookup entry for each distinct name the exact pass missed (score >= 75)."""
    return _fuzzy_best(spark, sf_dir, "window")


def j2_all_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2+F12 with token-set and partial forms: part names, reworded, against the list of all part names.

    The lookup has an entry for every distinct name and type. A name is asked for with its words moved, some added,
    or cut to a stretch of it.
    """
    part = _t(spark, sf_dir, "part")
    entry = F.concat_ws(" ", "p_name", "p_type")
    listed = part.groupBy(entry.alias("Name")).agg(F.min("p_partkey").cast("string").alias("Code"), F.min("p_partkey").alias("_pos"))
    lk = lookup.prepare_lookup(listed, "Name", "Code", "_pos")
    kind = F.col("p_partkey") % 3
    asked = (
        F.when(kind == 0, F.concat_ws(" ", "p_type", F.regexp_replace("p_brand", "#", " "), "p_name"))
        .when(kind == 1, F.concat(F.lit("a "), F.col("p_name"), F.lit(" of the old "), F.col("p_type")))
        .otherwise(F.concat(F.substring("p_name", 2, 100), F.lit("s"), F.col("p_type"), F.lit(" and others")))
    )
    best = lookup.best_fuzzy_matches(part.select(asked.alias("_match_name")), lk)
    return best.select(F.col("_match_name").alias("name"), "match_name", "match_score", F.col("code_fuzzy").alias("code"))


def j2_fuzzy_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 as run against a lookup too large to broadcast: exact segment blocking, same result."""
    return _fuzzy_best(spark, sf_dir, "segments")


def j3_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code = exact ?? fuzzy ?? territory prefix ?? original code, per customer."""
    lk = _segment_lookup(spark, sf_dir)
    cust = _t(spark, sf_dir, "customer").select(
        "c_custkey",
        _perturbed_segment().alias("country_name"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("T"), F.col("c_nationkey").cast("string"))).alias("territory_code"),
        F.concat(F.lit("X"), F.substring("c_mktsegment", 1, 1)).alias("country_code"),
    )
    out = lookup.resolve_codes(cust, lk, "country_name", "territory_code", "country_code", forms=PLAIN_FORMS)
    return out.select("c_custkey", "country_name", "country_code")


# ----------------------------------------------------------------- warehouse


def j6_dim_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6+J8+H6: nation surrogate keys on customers; unknown names and absent keys -> -1."""
    nation_spec = TableSpec(
        "dim_nation", "dimension", ("nation_name",), {}, surrogate_key="dim_nation_key", unknown_member={"nation_name": "-unknown-"}
    )
    region_spec = TableSpec(
        "dim_region", "dimension", ("region_name",), {}, surrogate_key="dim_region_key", unknown_member={"region_name": "-unknown-"}
    )
    nations = _t(spark, sf_dir, "nation").select(F.col("n_name").alias("nation_name"))
    dim_nation = with_unknown_member(assign_consecutive_keys(nations, ["nation_name"], "dim_nation_key"), nation_spec, check=False)
    regions = _t(spark, sf_dir, "region").select(F.col("r_name").alias("region_name"))
    dim_region = assign_consecutive_keys(regions, ["region_name"], "dim_region_key")
    fact_spec = TableSpec(
        "fact_customer",
        "fact",
        ("c_custkey",),
        {},
        foreign_keys=(("dim_nation_key", "dim_nation"), ("dim_region_key", "dim_region")),
    )
    cust = _t(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")))
        .otherwise(F.lit("NATION_X"))
        .alias("nation_name"),
    )
    out = resolve_foreign_keys(
        cust, fact_spec, {"dim_nation": dim_nation, "dim_region": dim_region}, {"dim_nation": nation_spec, "dim_region": region_spec}
    )
    return out.select("c_custkey", "dim_nation_key", "dim_region_key")


def h5_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5+H6: consecutive keys for (segment, nation) members, plus the -1 unknown member."""
    spec = TableSpec(
        "dim_segment_nation",
        "dimension",
        ("member",),
        {},
        surrogate_key="member_key",
        unknown_member={"member": "-unknown-"},
    )
    cust = _t(spark, sf_dir, "customer")
    nation = _t(spark, sf_dir, "nation")
    members = (
        cust.join(nation, cust.c_nationkey == nation.n_nationkey, "inner")
        .select(F.concat_ws("-", "c_mktsegment", "n_name").alias("member"))
        .distinct()
    )
    dim = with_unknown_member(assign_consecutive_keys(members, ["member"], "member_key"), spec, check=False)
    return dim.select("member_key", "member")


_BATCH_0 = _dt.datetime(2024, 1, 1)
_BATCH_1 = _dt.datetime(2024, 1, 2)
_BATCH_2 = _dt.datetime(2024, 1, 3)


def h4_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2-H4+H7: insert customers, upsert a balance feed (one column), then upsert new members."""
    spec = TableSpec(
        "customer_table",
        "fact",
        ("c_custkey",),
        {"c_name": "string", "c_acctbal": "double", "c_mktsegment": "string"},
        key_types={"c_custkey": "bigint"},
    )
    # each step is materialised, as a load writes every version before the next one
    base = cut_lineage(insert_rows(None, _t(spark, sf_dir, "customer"), spec, _BATCH_0))
    feed = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    step1 = cut_lineage(upsert_rows(base, feed, spec, _BATCH_1))
    newcomers = _t(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal")
    )
    step2 = upsert_rows(step1, newcomers, spec, _BATCH_2)
    return step2.select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        "c_mktsegment",
        F.col("created_ts").cast("date").alias("created_day"),
        F.col("updated_ts").cast("date").alias("updated_day"),
    )


def s11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose URL is not yet in the manifest of seen (labelled) pages."""
    pages = _t(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    labels = _t(spark, sf_dir, "labels")
    manifest = pages.join(labels, pages.page_id == labels.doc_id, "left_semi").select("path")
    return unseen_files(pages, manifest, ["path"]).select("page_id", F.col("path").alias("url"))


# Fixed value: the URL path pattern (scheme://host then the path up to ? or #).
URL_PATH_PATTERN = r"^[a-z]+://[^/]+(/[^?#]*)"


def s12_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed data-set name from each page URL's path."""
    pages = _t(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", URL_PATH_PATTERN, 1).alias("endpoint"))
    return pages.select("page_id", "endpoint", tx.dataset_slug("endpoint").alias("slug"))


def j10_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10+J11: inner and left horizontal combines on an explicit row key."""
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = _t(spark, sf_dir, "orders")
    n_orders = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    n_open = (
        orders.filter(F.col("o_orderstatus") == "O").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_open"))
    )
    inner = dedupe.combine(cust, n_orders, on="c_custkey")
    return dedupe.combine(inner, n_open, on="c_custkey", how="left")


# ----------------------------------------------------------------- star analysis


def _orders_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _order_date(_t(spark, sf_dir, "orders"))
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = _t(spark, sf_dir, "nation")
    region = _t(spark, sf_dir, "region")
    return (
        orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
        .join(F.broadcast(nation), F.col("c_nationkey") == nation.n_nationkey, "inner")
        .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "inner")
    )


def n1_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly orders per nation with the week's continent (region) total."""
    star = _orders_star(spark, sf_dir)
    weekly = star.groupBy("n_name", "r_name", F.trunc("order_date", "week").alias("week_start_date")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(_money("o_totalprice")).cast("decimal(18,2)").alias("value")
    )
    # the region total is a window over the already aggregated weekly rows
    # (a handful of nations per region and week), so the star is scanned once
    by_region_week = Window.partitionBy("r_name", "week_start_date")
    return weekly.withColumn("region_orders", F.sum("n_orders").over(by_region_week))


def n2_segment_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by customer segment and order priority."""
    star = _orders_star(spark, sf_dir)
    return star.groupBy("c_mktsegment", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(_money("o_totalprice")).cast("decimal(18,2)").alias("total_value"),
        F.countDistinct("c_custkey").alias("n_customers"),
    )


def n3_status_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations per order status per week."""
    star = _orders_star(spark, sf_dir)
    return star.groupBy(F.trunc("order_date", "week").alias("week_start_date"), "o_orderstatus").agg(
        F.countDistinct("n_nationkey").alias("n_nations")
    )


def n4_two_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two weekly facts (orders placed, quantity shipped) joined on the week."""
    orders = _order_date(_t(spark, sf_dir, "orders"))
    placed = orders.groupBy(F.trunc("order_date", "week").alias("week_start_date")).agg(F.count(F.lit(1)).alias("n_orders"))
    shipped = (
        _t(spark, sf_dir, "lineitem")
        .groupBy(F.trunc(F.col("l_shipdate").cast("date"), "week").alias("week_start_date"))
        .agg(F.sum(_money("l_quantity")).cast("decimal(18,2)").alias("qty_shipped"))
    )
    return placed.join(shipped, "week_start_date", "full_outer")


QUERIES: dict[str, QueryFn] = {
    "g1_date_dim": g1_date_dim,
    "f2_iso_week": f2_iso_week,
    "j7_role_date": j7_role_date,
    "a1_keep_first": a1_keep_first,
    "a3_group_sizes": a3_group_sizes,
    "a4_first_non_null": a4_first_non_null,
    "a5_suffix_rules": a5_suffix_rules,
    "u1_union": u1_union,
    "p1_rename": p1_rename,
    "p8_conditional": p8_conditional,
    "p10_map": p10_map,
    "p16_coerce": p16_coerce,
    "f8_age_band": f8_age_band,
    "f7_row_hash": f7_row_hash,
    "w1_running_total": w1_running_total,
    "j9_prev_week": j9_prev_week,
    "j4_week_interval": j4_week_interval,
    "j2_fuzzy": j2_fuzzy,
    "j2_fuzzy_segments": j2_fuzzy_segments,
    "j2_all_forms": j2_all_forms,
    "j3_fallback": j3_fallback,
    "j6_dim_keys": j6_dim_keys,
    "h5_surrogate": h5_surrogate,
    "h4_upsert": h4_upsert,
    "s11_manifest": s11_manifest,
    "s12_slug": s12_slug,
    "j10_combine": j10_combine,
    "n1_trend": n1_trend,
    "n2_segment_priority": n2_segment_priority,
    "n3_status_week": n3_status_week,
    "n4_two_facts": n4_two_facts,
}


# ----------------------------------------------------------------- whole pipelines on derived sources


def _nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _order_date(_t(spark, sf_dir, "orders")).select("o_custkey", "o_orderstatus", "order_date")
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _t(spark, sf_dir, "nation")
    region = _t(spark, sf_dir, "region")
    return (
        orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
        .join(F.broadcast(nation), F.col("c_nationkey") == nation.n_nationkey, "inner")
        .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "inner")
        .select("n_nationkey", "n_name", "r_name", "o_orderstatus", "order_date")
    )


def _nation_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _t(spark, sf_dir, "customer")
    return cust.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg((F.count(F.lit(1)) * 1000).alias("population"))


def _territory(key) -> F.Column:
    return F.concat(F.lit("T"), F.lpad(colops.col_of(key).cast("string"), 2, "0"))


def _cases_weekly_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly long layout: one row per nation, ISO week and indicator, plus continent totals."""
    rows = _nation_orders(spark, sf_dir).withColumn(
        "indicator",
        F.when(F.col("o_orderstatus") == "F", "cases").when(F.col("o_orderstatus") == "O", "deaths").otherwise("tests"),
    )
    rows = rows.withColumn("year_week", F.regexp_replace(cal.iso_year_week_label("order_date"), "-W", "-"))
    pop = _nation_population(spark, sf_dir)
    nations = rows.groupBy("n_nationkey", "n_name", "r_name", "year_week", "indicator").agg(
        F.count(F.lit(1)).alias("weekly_count")
    )
    nations = nations.join(pop, "n_nationkey", "inner").select(
        F.col("n_name").alias("country"),
        _territory("n_nationkey").alias("country_code"),
        F.col("r_name").alias("continent"),
        "population",
        "indicator",
        "weekly_count",
        "year_week",
        F.col("n_nationkey").cast("long").alias("_key"),
    )
    totals = rows.groupBy("r_name", "year_week", "indicator").agg(F.count(F.lit(1)).alias("weekly_count"))
    totals = totals.select(
        F.concat(F.col("r_name"), F.lit(" (total)")).alias("country"),
        F.lit(None).cast("string").alias("country_code"),
        F.col("r_name").alias("continent"),
        F.lit(None).cast("bigint").alias("population"),
        "indicator",
        "weekly_count",
        "year_week",
        F.lit(-1).cast("long").alias("_key"),
    )
    src = nations.unionByName(totals)
    by_series = Window.partitionBy("country", "indicator").orderBy("year_week").rowsBetween(Window.unboundedPreceding, 0)
    return src.select(
        "country",
        "country_code",
        "continent",
        "population",
        "indicator",
        "weekly_count",
        F.sum("weekly_count").over(by_series).alias("cumulative_count"),
        (F.col("weekly_count").cast("double") * 1000.0 / F.col("population")).alias("rate_14_day"),
        "year_week",
        F.lit("orders").alias("source"),
        F.lit("weekly").alias("_file"),
        "_key",
    ).withColumn("_pos", F.col("_key")).drop("_key")


def _cases_daily_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily layout: one row per nation and day; no cases that day reads as missing."""
    rows = _nation_orders(spark, sf_dir)
    daily = rows.groupBy("n_nationkey", "n_name", "r_name", "order_date").agg(
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("nf"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("no"),
    )
    daily = daily.join(_nation_population(spark, sf_dir), "n_nationkey", "inner")
    return daily.select(
        F.dayofmonth("order_date").alias("day"),
        F.month("order_date").alias("month"),
        F.year("order_date").alias("year"),
        F.when(F.col("nf") > 0, F.col("nf")).alias("cases"),
        F.col("no").alias("deaths"),
        F.col("n_name").alias("countriesAndTerritories"),
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("geoId"),
        _territory("n_nationkey").alias("countryterritoryCode"),
        F.col("population").alias("popData2020"),
        F.col("r_name").alias("continentExp"),
        F.lit("daily").alias("_file"),
        (F.col("n_nationkey").cast("long") * 100_000 + F.unix_date("order_date")).alias("_pos"),
    )


def _nation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _t(spark, sf_dir, "nation").select(
        F.col("n_name").alias("Name"), F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("Code"), F.col("n_nationkey").alias("_pos")
    )
    return lookup.prepare_lookup(nation, pos_col="_pos")


def _cases_deaths_outputs(spark: SparkSession, sf_dir: str, materialize: bool = False) -> dict[str, DataFrame]:
    from epistar.plans import cases_deaths

    # the derived source files are landed once, as extracted files would be
    inputs = [cut_lineage(_cases_weekly_source(spark, sf_dir)), cut_lineage(_cases_daily_source(spark, sf_dir))]
    return cases_deaths.transform(inputs, _nation_lookup(spark, sf_dir), materialize=materialize)


def d2_cases_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 weekly fact: indicator rows -> wide, merged per (year_week, territory); continents excluded."""
    return _cases_deaths_outputs(spark, sf_dir)["fact_cases_deaths_country_weekly"]


def d2_cases_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 daily fact: running totals per territory, 14-day rates from the week holding the day."""
    return _cases_deaths_outputs(spark, sf_dir)["fact_cases_deaths_country_daily"]


def d2_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 country lookup: first row per resolved country code, continent rows left out."""
    return _cases_deaths_outputs(spark, sf_dir)["dim_country"]


QUERIES.update(
    {
        "d2_cases_weekly": d2_cases_weekly,
        "d2_cases_daily": d2_cases_daily,
        "d2_countries": d2_countries,
    }
)


def _vaccine_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vaccine-tracker layout: one row per line item (country = supplier nation, vaccine = brand)."""
    li = _t(spark, sf_dir, "lineitem")
    supp = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    rows = li.join(supp, li.l_suppkey == supp.s_suppkey, "inner").join(part, li.l_partkey == part.p_partkey, "inner")
    country = F.concat(F.lit("C"), F.col("s_nationkey").cast("string"))
    decade = (F.col("p_size") / 10).cast("int") * 10
    size_form = F.col("p_size") % 5
    ship = F.col("l_shipdate").cast("date")
    qty = F.col("l_quantity").cast("bigint")
    return rows.select(
        cal.iso_year_week_label(ship).alias("YearWeekISO"),
        country.alias("ReportingCountry"),
        F.when(F.col("l_linenumber") <= 2, country)
        .otherwise(F.concat(country, F.lit("-R"), (F.col("l_linenumber") % 3).cast("string")))
        .alias("Region"),
        F.when(size_form == 0, F.lit("ALL"))
        .when(size_form == 1, F.concat(F.lit("Age"), decade.cast("string"), F.lit("_"), (decade + 9).cast("string")))
        .when(size_form == 2, F.lit("Age<18"))
        .when(size_form == 3, F.lit("Age80+"))
        .otherwise(F.lit("1_Age60+"))
        .alias("TargetGroup"),
        F.col("p_brand").alias("Vaccine"),
        qty.alias("FirstDose"),
        F.when(F.col("l_tax") > 0.05, F.lit("yes")).alias("FirstDoseRefused"),
        F.when(F.col("l_returnflag") != "R", qty - 1).alias("SecondDose"),
        F.col("l_linenumber").cast("bigint").alias("DoseAdditional1"),
        F.when(F.col("l_linestatus") == "O", F.lit(1).cast("bigint")).alias("UnknownDose"),
        F.when(F.col("l_discount") == 0, F.lit("n/a")).otherwise((qty * 10).cast("string")).alias("NumberDosesReceived"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")).alias("NumberDosesExported"),
        (F.col("s_nationkey") + 1000).cast("bigint").alias("Population"),
        F.when(F.col("l_discount") > 0.08, F.lit("bad")).otherwise(F.lit("900")).alias("Denominator"),
        F.lit("vaccine-tracker").alias("_file"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_pos"),
    )


def _vaccine_outputs(spark: SparkSession, sf_dir: str, materialize: bool = False) -> dict[str, DataFrame]:
    from epistar.plans import vaccines

    return vaccines.transform([_vaccine_source(spark, sf_dir)], materialize=materialize)


def d3_vaccine_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 national fact: renamed, snake-cased, coerced and zero-filled rows where region == country."""
    return _vaccine_outputs(spark, sf_dir)["fact_vaccine_tracker_country"].drop("_file", "_pos")


def d3_target_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 target-group lookup with age limits and descriptions."""
    return _vaccine_outputs(spark, sf_dir)["dim_target_group"]


def d3_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 region lookup: the regions of the region-level rows."""
    return _vaccine_outputs(spark, sf_dir)["dim_region"]


QUERIES.update(
    {
        "d3_vaccine_country": d3_vaccine_country,
        "d3_target_groups": d3_target_groups,
        "d3_regions": d3_regions,
    }
)


def _movement_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Movement-indicator inputs in the current and the archive layout.

    Continents (regions) play countries and nations play sub-national
    regions; both layouts describe the same (region, nation, week) cells, so
    the merge meets every key twice.
    """
    rows = _nation_orders(spark, sf_dir)
    wk = rows.groupBy("n_nationkey", "n_name", "r_name", F.trunc("order_date", "week").alias("ws")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("nf")
    )
    label = cal.iso_year_week_label("ws")
    location = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    pos = F.col("n_nationkey").cast("long") * 100_000 + F.unix_date("ws")
    current = wk.select(
        F.col("r_name").alias("Country"),
        F.substring("r_name", 1, 2).alias("CountryISO2Code"),
        location.alias("LocationCode"),
        F.col("n_name").alias("LocationName"),
        (F.col("n") * 10.0).alias("NotificationRate"),
        F.when(F.col("n_nationkey") % 2 == 0, "National").otherwise("Regional").alias("NotificationRateGeoLevel"),
        (F.col("nf") * 1.0).alias("VaccineUptake"),
        F.when(F.col("n") > 5, "National").otherwise("Regional").alias("VaccineGeoLevel"),
        (F.col("n") * 2.0).alias("TestingRate"),
        F.lit("Regional").alias("TestingGeoLevel"),
        (F.col("n") * 1.5).alias("WeightedRate"),
        F.when(F.col("n") >= 8, "Dark Red").when(F.col("n") >= 5, "Red").when(F.col("n") >= 3, "Orange").when(F.col("n") >= 2, "Green").alias("Colour"),
        label.alias("Week"),
        F.lit("movementindicators.json").alias("_file"),
        pos.alias("_pos"),
    )
    archive = wk.select(
        F.col("r_name").alias("country"),
        location.alias("geo_id_final"),
        F.col("n_name").alias("region"),
        F.regexp_replace(label, "-W", "-").alias("week"),
        F.when(F.col("nf") >= 1, "Purple").alias("colour"),
        (F.col("n") * 3.0).alias("subnational_rate_14"),
        F.when(F.col("nf") > 1, "TRUE").otherwise("FALSE").alias("regional_testing_data"),
        (F.col("nf") * 0.5).alias("positivity_rate_combined"),
        (F.col("n") * 4.0).alias("testing_rate_combined"),
        F.col("n").alias("national_cases_7"),
        (F.col("n_nationkey") + 1000).cast("bigint").alias("national_population"),
        F.lit("movementindicatorsarchive.json").alias("_file"),
        pos.alias("_pos"),
    )
    return [current, archive]


def _continent_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = _t(spark, sf_dir, "region").select(
        F.col("r_name").alias("Name"), F.substring("r_name", 1, 2).alias("Code"), F.col("r_regionkey").alias("_pos")
    )
    return lookup.prepare_lookup(region, pos_col="_pos")


def _movement_outputs(spark: SparkSession, sf_dir: str, materialize: bool = False) -> dict[str, DataFrame]:
    from epistar.plans import movement

    # the derived source files are landed once, as extracted files would be
    sources = [cut_lineage(src) for src in _movement_sources(spark, sf_dir)]
    return movement.transform(sources, _continent_lookup(spark, sf_dir), materialize=materialize)


def d1_movement_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 regional fact: both layouts merged per (country, region, week start), first non-null value wins."""
    return _movement_outputs(spark, sf_dir)["fact_movement_indicators_region"]


def d1_movement_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 national fact: 14-day cases from the previous week (0 if absent), first row per (country, week)."""
    return _movement_outputs(spark, sf_dir)["fact_movement_indicators_country"]


def d1_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 status lookup: lower-cased colours and their descriptions."""
    return _movement_outputs(spark, sf_dir)["dim_status"]


QUERIES.update(
    {
        "d1_movement_region": d1_movement_region,
        "d1_movement_country": d1_movement_country,
        "d1_status": d1_status,
    }
)


# ----------------------------------------------------------------- star analysis over assembled pipelines


def _star(outputs: dict[str, dict[str, DataFrame]], facts: list[str]):
    from epistar.plans.assemble import assemble_star

    return assemble_star(outputs, facts=facts)


def n1_cases_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1 on the star: weekly cases/deaths per country with continent totals (D2 -> D5/D6 -> N1)."""
    from epistar.plans.star import weekly_cases_trend

    dims, facts = _star({"nd": _cases_deaths_outputs(spark, sf_dir, materialize=True)}, ["fact_cases_deaths_country_weekly"])
    return weekly_cases_trend(facts, dims)


def n2_doses_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2 on the star: doses by target group and vaccine (D3 -> D5/D6 -> N2)."""
    from epistar.plans.star import doses_by_group_and_vaccine

    dims, facts = _star({"vt": _vaccine_outputs(spark, sf_dir, materialize=True)}, ["fact_vaccine_tracker_country"])
    return doses_by_group_and_vaccine(facts, dims)


def n3_status_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N3 on the star: regions per status colour per week (D1 -> D5/D6 -> N3)."""
    from epistar.plans.star import regions_per_status

    dims, facts = _star({"mi": _movement_outputs(spark, sf_dir, materialize=True)}, ["fact_movement_indicators_region"])
    return regions_per_status(facts, dims)


def n4_testing_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N4 on the star: national testing next to the regional average, per week and country."""
    from epistar.plans.star import testing_national_vs_regional

    dims, facts = _star(
        {"mi": _movement_outputs(spark, sf_dir, materialize=True)},
        ["fact_movement_indicators_country", "fact_movement_indicators_region"],
    )
    return testing_national_vs_regional(facts, dims)


QUERIES.update(
    {
        "n1_cases_star": n1_cases_star,
        "n2_doses_star": n2_doses_star,
        "n3_status_star": n3_status_star,
        "n4_testing_star": n4_testing_star,
    }
)


# ----------------------------------------------------------------- incremental load


T1_FILES, T1_BATCHES = 8, 4


def t1_incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders landed as chunk files, streamed through micro-batches of keyed upserts.

    Each order is a row of the table under its own key, so batches add up, a
    replayed batch changes nothing and the per-customer figures are taken when
    the table is read. The stream has several batches whatever the number of
    files the orders came in; a fresh stream checkpoint is used per run.
    """
    import uuid

    from epistar.operators.warehouse import read_current
    from epistar.session import scratch_path
    from epistar.streaming.incremental import stream_source, upsert_batches

    spec = TableSpec(
        "orders_seen", "fact", ("o_orderkey",), {"o_custkey": "bigint", "order_date": "date", "is_open": "boolean"}, key_types={"o_orderkey": "bigint"}
    )
    run = uuid.uuid4().hex
    root = scratch_path(spark, f"t1/{run}/warehouse")
    landing = scratch_path(spark, f"t1/{run}/landing")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    orders.repartition(T1_FILES, "o_orderkey").write.parquet(landing)
    stream = stream_source(spark, landing, orders.schema, fmt="parquet", max_files_per_trigger=T1_FILES // T1_BATCHES)

    def per_batch(batch: DataFrame) -> dict[str, DataFrame]:
        row = batch.withColumn("order_date", F.col("o_orderdate").cast("date")).withColumn("is_open", F.col("o_orderstatus") == "O")
        return {"orders_seen": row}

    query = upsert_batches(
        stream, per_batch, {"orders_seen": spec}, root, f"t1_{run}", checkpoint_location=scratch_path(spark, f"t1/{run}/stream")
    )
    query.awaitTermination()
    table = read_current(spark, f"{root}/orders_seen")
    return table.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count(F.when(F.col("is_open"), 1)).alias("open_orders"),
    )


QUERIES["t1_incremental_upsert"] = t1_incremental_upsert


def j4_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4, general form: each order matched to its nation's calendar-month shipping interval.

    Intervals are arbitrary date ranges (months of 28-31 days, all of one level), so the join
    spreads each interval over at most two buckets, equi-joins on (nation, bucket) and keeps
    ``start <= date <= end``. Intervals of one nation do not overlap, so an order matches at most one.
    """
    li = _t(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("ship"), "l_quantity")
    supp = _t(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nationkey"))
    months = (
        li.join(supp, li.l_suppkey == supp.s_suppkey, "inner")
        .groupBy("nationkey", F.trunc("ship", "month").alias("month_start"))
        .agg(F.sum(_money("l_quantity")).cast("decimal(18,2)").alias("month_qty"))
        .withColumn("month_end", F.last_day("month_start"))
    )
    orders = _order_date(_t(spark, sf_dir, "orders")).select("o_orderkey", "o_custkey", "order_date")
    cust = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    points = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner").select("o_orderkey", "nationkey", "order_date")
    out = series.interval_join(points, months, ["nationkey"], "order_date", "month_start", "month_end")
    return out.select("o_orderkey", "nationkey", "order_date", "month_start", "month_end", "month_qty")


QUERIES["j4_interval_join"] = j4_interval_join


# ----------------------------------------------------------------- files, loads and snapshots


def _run_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run of a query, in the shared checkpoint folder."""
    return scratch_path(spark, f"{name}/{uuid.uuid4().hex}")


def a2_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: distinct rows, with no key and a column that the table lacks."""
    return dedupe.keep_first(_t(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority", "no_such_column"], None)


def f5_previous_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders of each ISO week beside those of the week before (0 where it has none)."""
    weeks = _order_date(_t(spark, sf_dir, "orders")).groupBy(F.trunc("order_date", "week").alias("week_start_date")).agg(F.count(F.lit(1)).alias("n_orders"))
    before = weeks.select(F.col("week_start_date").alias("previous_start_date"), F.col("n_orders").alias("n_previous"))
    here = weeks.withColumn("previous_start_date", cal.previous_week_start("week_start_date"))
    return dedupe.combine(here, before, on="previous_start_date", how="left").withColumn("n_previous", F.coalesce("n_previous", F.lit(0)))


def s4_lookup_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as a ``Name,Code`` list and read back; a code spelled ``NA`` stays text."""
    folder = _run_folder(spark, "s4")
    code = F.when(F.col("c_mktsegment") == "BUILDING", "NA").otherwise(F.substring("c_mktsegment", 1, 2))
    _t(spark, sf_dir, "customer").select(F.col("c_name").alias("Name"), code.alias("Code")).write.option("header", True).csv(folder)
    return read_lookup_csv(spark, folder).select("Name", "Code")


def s7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders written as a data set, the others appended, the old content replaced first; read back whole."""
    folder = _run_folder(spark, "s7")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    is_open = F.col("o_orderstatus") == "O"
    write_datasets({"orders": orders}, folder)
    write_datasets({"orders": orders.where(is_open)}, folder)
    paths = write_datasets({"orders": orders.where(~is_open)}, folder, mode="append")
    return read_cleansed(spark, paths["orders"])


def h9_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two published loads around a refresh; each snapshot keeps its own rows.

    Open orders are loaded and published. The table is refreshed (its defaults only) and loaded with the orders that are
    not open; a reader sees the first snapshot until the second is published.
    """
    spec = TableSpec("orders_table", "fact", ("o_orderkey",), {"o_custkey": "bigint"}, key_types={"o_orderkey": "bigint"})
    root = _run_folder(spark, "h9")
    orders = _t(spark, sf_dir, "orders")
    is_open = F.col("o_orderstatus") == "O"
    load_table(spark, spec, orders.where(is_open), f"{root}/{spec.name}", _BATCH_0)
    publish(spark, root, [spec.name])
    refresh_tables(spark, {spec.name: spec}, root, _BATCH_1)
    meanwhile = read_snapshot(spark, root)[spec.name]
    load_table(spark, spec, orders.where(~is_open), f"{root}/{spec.name}", _BATCH_2)
    publish(spark, root, [spec.name])
    seen = {"during": meanwhile, "after": read_snapshot(spark, root)[spec.name], "first": read_snapshot(spark, root, 1)[spec.name]}
    return dedupe.union_all(*[df.select(F.lit(name).alias("seen"), "o_orderkey", "o_custkey") for name, df in seen.items()])


def _loaded(spark: SparkSession, name: str, outputs: dict[str, dict[str, DataFrame]]):
    """(facts, dimensions) of a warehouse loaded from the outputs (D4-D6) and read by its snapshot."""
    root = _run_folder(spark, name)
    # the calendar has every week of the facts, or the rows of those outside would share the unknown date
    facts = [df.select("week_start_date", "week_end_date") for out in outputs.values() for table, df in out.items() if table.startswith("fact_")]
    first, last = dedupe.union_all(*facts).agg(F.min("week_start_date"), F.max("week_end_date")).first()
    load_warehouse(spark, outputs, root, _BATCH_0, date_span_args={"start": last, "num_years": first.year - last.year - 1})
    tables = read_snapshot(spark, root)
    return tables, tables


def n2_loaded_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2 on the loaded warehouse (D3 -> D4-D6 -> snapshot): equals the assembled star's doses."""
    from epistar.plans.star import doses_by_group_and_vaccine

    return doses_by_group_and_vaccine(*_loaded(spark, "n2", {"vt": _vaccine_outputs(spark, sf_dir, materialize=True)}))


def n3_loaded_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N3 on the loaded warehouse (D1 -> D4-D6 -> snapshot): equals the assembled star's regions per status."""
    from epistar.plans.star import regions_per_status

    return regions_per_status(*_loaded(spark, "n3", {"mi": _movement_outputs(spark, sf_dir, materialize=True)}))


QUERIES.update(
    {
        "a2_distinct": a2_distinct,
        "f5_previous_week": f5_previous_week,
        "s4_lookup_csv": s4_lookup_csv,
        "s7_round_trip": s7_round_trip,
        "h9_snapshots": h9_snapshots,
        "n2_loaded_star": n2_loaded_star,
        "n3_loaded_star": n3_loaded_star,
    }
)
