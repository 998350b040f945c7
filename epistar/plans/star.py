"""Star-schema analysis (N1-N4) over the loaded warehouse, and the flagship
query used by the driver's smoke check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epistar.functions.calendar import date_dimension_rows, date_range_between
from epistar.operators.keys import assign_consecutive_keys, resolve_foreign_keys
from epistar.spec import TableSpec

_ORDER_FACT = TableSpec(
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
_DATE_DIM = TableSpec("dim_date", "dimension", ("date",), {}, surrogate_key="dim_date_key")


def weekly_orders_through_date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders keyed to a generated date dimension, then counted per ISO week.

    G1+F10 build a calendar covering every order's week (Monday of the first
    to Sunday of the last), H5 keys it, J7 resolves the three date roles, and
    the trend reads the week start back through its surrogate key.
    """
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date")
    )
    orders = orders.withColumns(
        {"week_start_date": F.trunc("date", "week"), "week_end_date": F.date_add(F.trunc("date", "week"), 6)}
    )
    bounds = orders.agg(F.min("week_start_date").alias("lo"), F.max("week_end_date").alias("hi"))
    days = bounds.select(F.explode(date_range_between("lo", "hi")).alias("date"))
    dim = assign_consecutive_keys(date_dimension_rows(days), ["date"], "dim_date_key")
    fact = resolve_foreign_keys(orders, _ORDER_FACT, {"dim_date": dim}, {"dim_date": _DATE_DIM}).select(
        "o_orderkey", "dim_date_key", "dim_week_start_date_key", "dim_week_end_date_key"
    )
    dim = dim.select("dim_date_key", "year", "week", "date")
    joined = fact.join(F.broadcast(dim), "dim_date_key", "inner")
    week_start = dim.select(F.col("dim_date_key").alias("dim_week_start_date_key"), F.col("date").alias("week_start_date"))
    joined = joined.join(F.broadcast(week_start), "dim_week_start_date_key", "left")
    return joined.groupBy("week_start_date").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.min("date").alias("first_order_date"),
        F.max("date").alias("last_order_date"),
    )


# ---------------------------------------------------------------- N1-N4 over the warehouse


def _dim(dims, name: str, *cols: str) -> DataFrame:
    # a written table: its file size decides whether it is broadcast
    return dims[name].select(*cols)


def weekly_cases_trend(facts: dict, dims: dict) -> DataFrame:
    """Weekly national cases and deaths with the continent's weekly totals."""
    fact = facts["fact_cases_deaths_country_weekly"]
    country = _dim(dims, "dim_country", "dim_country_key", "country_code", "continent")
    week = _dim(dims, "dim_date", F.col("dim_date_key").alias("dim_week_start_date_key"), F.col("date").alias("week_start_date"))
    rows = fact.join(country, "dim_country_key", "left").join(week, "dim_week_start_date_key", "left")
    per_country = rows.groupBy("continent", "country_code", "week_start_date").agg(
        F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths")
    )
    per_continent = per_country.groupBy("continent", "week_start_date").agg(
        F.sum("cases").alias("continent_cases"), F.sum("deaths").alias("continent_deaths")
    )
    return per_country.join(per_continent, ["continent", "week_start_date"], "left")


def doses_by_group_and_vaccine(facts: dict, dims: dict) -> DataFrame:
    """Vaccine doses by target group and vaccine."""
    fact = facts["fact_vaccine_tracker_country"]
    group = _dim(dims, "dim_target_group", "dim_target_group_key", "target_group", "age_lower_limit", "age_upper_limit")
    vaccine = _dim(dims, "dim_vaccine", "dim_vaccine_key", "vaccine_code")
    names = set(fact.columns)
    rows = fact.join(group, "dim_target_group_key", "left").join(vaccine, "dim_vaccine_key", "left")
    return rows.groupBy("target_group", "age_lower_limit", "age_upper_limit", "vaccine_code").agg(
        F.sum("first_dose").alias("first_dose"),
        F.sum("second_dose").alias("second_dose"),
        F.sum(
            sum(
                (F.coalesce(F.col(f"additional_dose_{i}"), F.lit(0)) for i in range(1, 6) if f"additional_dose_{i}" in names),
                F.lit(0),
            )
        ).alias("additional_doses"),
        F.sum("unknown_dose").alias("unknown_dose"),
    )


def regions_per_status(facts: dict, dims: dict) -> DataFrame:
    """Regions per status colour per week."""
    fact = facts["fact_movement_indicators_region"]
    status = _dim(dims, "dim_status", "dim_status_key", "colour_name")
    week = _dim(dims, "dim_date", F.col("dim_date_key").alias("dim_week_start_date_key"), F.col("date").alias("week_start_date"))
    rows = fact.join(status, "dim_status_key", "left").join(week, "dim_week_start_date_key", "left")
    return rows.groupBy("week_start_date", "colour_name").agg(F.countDistinct("dim_region_key").alias("n_regions"))


def testing_national_vs_regional(facts: dict, dims: dict) -> DataFrame:
    """National testing/positivity next to the average of the country's regions, per week."""
    def measure(df: DataFrame, name: str):
        return F.col(name) if name in df.columns else F.lit(None).cast("double")

    country_fact = facts["fact_movement_indicators_country"]
    region_fact = facts["fact_movement_indicators_region"]
    nat = country_fact.select(
        "dim_week_start_date_key",
        "dim_country_key",
        measure(country_fact, "testing_rate").alias("national_testing_rate"),
        measure(country_fact, "positivity_rate").alias("national_positivity_rate"),
    )
    reg = region_fact.groupBy("dim_week_start_date_key", "dim_country_key").agg(
        F.avg(measure(region_fact, "testing_rate")).alias("regional_testing_rate"),
        F.avg(measure(region_fact, "positivity_rate")).alias("regional_positivity_rate"),
        F.count(F.lit(1)).alias("n_regions"),
    )
    week = _dim(dims, "dim_date", F.col("dim_date_key").alias("dim_week_start_date_key"), F.col("date").alias("week_start_date"))
    country = _dim(dims, "dim_country", "dim_country_key", "country_code")
    return (
        nat.join(reg, ["dim_week_start_date_key", "dim_country_key"], "full_outer")
        .join(week, "dim_week_start_date_key", "left")
        .join(country, "dim_country_key", "left")
        .drop("dim_week_start_date_key", "dim_country_key")
    )
