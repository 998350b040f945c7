"""The date dimension, the six EU dimensions and the six facts.

Dimensions load before facts because facts resolve their surrogate keys from
the loaded dimensions. Every load is a versioned insert-or-upsert (H8).
Data sets from the three transforms are applied in source order (movement,
cases/deaths, vaccines), each upsert supplying only the columns it has, as
the reference loads one landed file after another.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from epistar.functions.calendar import date_dimension_rows, date_range_frame, date_span
from epistar.operators.contract import ContractReport, admit
from epistar.operators.snapshot import publish
from epistar.operators.warehouse import load_table, prepare_fact, read_current, refresh_tables
from epistar.spec import DIMENSIONS, FACTS, TableSpec

# Load order of dimensions and facts.
DIMENSION_ORDER = ["dim_country", "dim_region", "dim_source", "dim_status", "dim_target_group", "dim_vaccine"]
FACT_ORDER = [
    "fact_cases_deaths_country_daily",
    "fact_cases_deaths_country_weekly",
    "fact_movement_indicators_country",
    "fact_movement_indicators_region",
    "fact_vaccine_tracker_country",
    "fact_vaccine_tracker_region",
]
# Fixed value: the default date-dimension span, ten years back from the run date.
DATE_DIMENSION_YEARS = -10


def table_root(warehouse_root: str, name: str) -> str:
    return f"{warehouse_root.rstrip('/')}/{name}"


def date_dimension(
    spark: SparkSession,
    start: _dt.date | None = None,
    num_years: int | None = DATE_DIMENSION_YEARS,
    today: _dt.date | None = None,
) -> DataFrame:
    """D4 (G1+F10): the calendar rows of ``dim_date`` (keys are assigned on load)."""
    first, last = date_span(start, num_years, today)
    return date_dimension_rows(date_range_frame(spark, first, last))


def load_date_dimension(spark: SparkSession, warehouse_root: str, batch_ts: _dt.datetime, **span) -> str | None:
    """Load ``dim_date``; reruns upsert the same dates and keep their keys."""
    rows = date_dimension(spark, **span)
    return load_table(spark, DIMENSIONS["dim_date"], rows, table_root(warehouse_root, "dim_date"), batch_ts)


def load_dimensions(
    spark: SparkSession,
    outputs: Mapping[str, Mapping[str, DataFrame]],
    warehouse_root: str,
    batch_ts: _dt.datetime,
    report: ContractReport | None = None,
) -> dict[str, list[str]]:
    """Every dimension data set of every source, in source order.

    With a ``report`` every batch is held against its contract first (``operators/contract.py``).

    Tables are independent, so each table's loads run in their own thread
    (Spark schedules the jobs side by side); inside a table the sources are
    applied one after another, as their order decides which values win.
    """

    def load_one(dim: str) -> list[str]:
        paths = []
        for source in sorted(outputs):
            df = outputs[source].get(dim)
            if df is None:
                continue
            if report is not None:
                df = admit(df, DIMENSIONS[dim], source, batch_ts, report)
            path = load_table(spark, DIMENSIONS[dim], df, table_root(warehouse_root, dim), batch_ts, source_order(df))
            if path:
                paths.append(path)
        return paths

    return _per_table(DIMENSION_ORDER, load_one)


def source_order(df: DataFrame) -> list[str] | None:
    """The columns that say which of several rows of a key came first, where a source carries them."""
    return [c for c in ("_file", "_pos") if c in df.columns] or None


def _per_table(names, load_one) -> dict[str, list[str]]:
    with ThreadPoolExecutor(max_workers=4) as pool:
        futures = {name: pool.submit(load_one, name) for name in names}
        results = {name: f.result() for name, f in futures.items()}
    return {name: paths for name, paths in results.items() if paths}


def current_dimensions(spark: SparkSession, warehouse_root: str) -> dict[str, DataFrame]:
    dims = {}
    for name in DIMENSIONS:
        df = read_current(spark, table_root(warehouse_root, name))
        if df is not None:
            dims[name] = df
    return dims


def load_facts(
    spark: SparkSession,
    outputs: Mapping[str, Mapping[str, DataFrame]],
    warehouse_root: str,
    batch_ts: _dt.datetime,
    fact_specs: Mapping[str, TableSpec] = FACTS,
    report: ContractReport | None = None,
) -> dict[str, list[str]]:
    """Resolve dimension keys (J6-J8), numeric nulls -> 0 (P15), check the contract (with a ``report``), then load (H8)."""
    dims = current_dimensions(spark, warehouse_root)

    def load_one(fact: str) -> list[str]:
        spec = fact_specs[fact]
        paths = []
        for source in sorted(outputs):
            df = outputs[source].get(fact)
            if df is None:
                continue
            keyed = prepare_fact(df, spec, dims, DIMENSIONS)
            if report is not None:
                keyed = admit(keyed, spec, source, batch_ts, report)
            path = load_table(spark, spec, keyed, table_root(warehouse_root, fact), batch_ts, source_order(keyed))
            if path:
                paths.append(path)
        return paths

    return _per_table(FACT_ORDER, load_one)


def load_warehouse(
    spark: SparkSession,
    outputs: Mapping[str, Mapping[str, DataFrame]],
    warehouse_root: str,
    batch_ts: _dt.datetime,
    date_span_args: Mapping | None = None,
    refresh: bool = False,
    report: ContractReport | None = None,
) -> dict[str, list[str]]:
    """D4+D5+D6 (and H9 when ``refresh``): the whole load in dependency order, against the contracts with a ``report``.

    The versions it leaves are published as one snapshot at the end (``operators/snapshot.py``): a reader of snapshots
    sees the warehouse before the load or after it, also during a refresh or when the load fails.
    """
    if refresh:
        refresh_tables(spark, {**DIMENSIONS, **FACTS}, warehouse_root, batch_ts)
    written = {"dim_date": [p for p in [load_date_dimension(spark, warehouse_root, batch_ts, **(date_span_args or {}))] if p]}
    written.update(load_dimensions(spark, outputs, warehouse_root, batch_ts, report))
    written.update(load_facts(spark, outputs, warehouse_root, batch_ts, report=report))
    publish(spark, warehouse_root, [*DIMENSIONS, *FACTS])
    return written
