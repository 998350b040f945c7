"""Command-line run: transform the landed source files and load the warehouse.

    python -m epistar.cli --raw <folder> --warehouse <folder> [--run-date YYYY-MM-DD]
                          [--years -10] [--refresh] [--keep-snapshots 2] [--master local[8]]

The raw folder holds the landed files (``movementindicators*.json``,
``nationalcasedeath*.json``, ``vaccine-tracker*.json`` and the country list
``data.csv``). A family without files is skipped; without the country list
names are not resolved to codes. Every table is written as a new version
under the warehouse folder, and the load is published as one snapshot of it.
The run's own intermediate tables are removed at its end.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import os

from pyspark.sql import SparkSession

from epistar.operators.lookup import prepare_lookup
from epistar.operators.contract import ContractReport
from epistar.operators.snapshot import clean_up
from epistar.plans import cases_deaths, movement, vaccines
from epistar.plans.load import load_warehouse
from epistar.session import build_session, scratch_scope
from epistar.sources.declared import CASES_FIELDS, MOVEMENT_FIELDS, VACCINE_FIELDS, read_declared
from epistar.sources.files import find_files, read_lookup_csv

# Landed file patterns of the three source families and the country list.
MOVEMENT_FILES = "movementindicators*.json"
CASES_FILES = "nationalcasedeath*.json"
VACCINE_FILES = "vaccine-tracker*.json"
LOOKUP_FILE = "data.csv"


def transform_landed(spark: SparkSession, raw: str, land_partitions: int | None = None, counts: dict | None = None) -> dict:
    """The three transforms over whatever families are landed in ``raw``.

    Documents are read by their splits with declared fields, whatever their size, and landed as
    Parquet in the shared checkpoint folder, as a transform reads its inputs more than once.
    ``land_partitions`` spreads the rows of each over that many tasks (one shuffle).
    ``counts`` receives rows, and rows with undeclared keys, of every file.
    """
    lookup_path = find_files(spark, raw, LOOKUP_FILE)
    lookup = prepare_lookup(read_lookup_csv(spark, lookup_path[0]), pos_col="_pos") if lookup_path else None

    def inputs(pattern: str, fields: dict[str, str]):
        frames = []
        for path in find_files(spark, raw, pattern) or []:
            frame, read = read_declared(spark, path, fields, land_partitions)
            frames.append(frame)
            if counts is not None:
                counts[path] = read
        return frames

    outputs = {}
    if mi := inputs(MOVEMENT_FILES, MOVEMENT_FIELDS):
        outputs["mi"] = movement.transform(mi, lookup, materialize=True)
    if nd := inputs(CASES_FILES, CASES_FIELDS):
        result = cases_deaths.transform(nd, lookup, materialize=True)
        if result:
            outputs["nd"] = result
    if vt := inputs(VACCINE_FILES, VACCINE_FIELDS):
        outputs["vt"] = vaccines.transform(vt, materialize=True)
    return outputs


def run(
    spark: SparkSession,
    raw: str,
    warehouse: str,
    run_date: _dt.date,
    years: int,
    refresh: bool,
    land_partitions: int | None = None,
    report: ContractReport | None = None,
    counts: dict | None = None,
) -> dict:
    batch_ts = _dt.datetime.combine(run_date, _dt.time())
    span = {"today": run_date, "num_years": years}
    with scratch_scope(spark):
        outputs = transform_landed(spark, raw, land_partitions, counts)
        return load_warehouse(spark, outputs, warehouse, batch_ts, date_span_args=span, refresh=refresh, report=report)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="epistar", description=__doc__.splitlines()[0])
    parser.add_argument("--raw", required=True)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--run-date", type=_dt.date.fromisoformat, default=_dt.date.today())
    parser.add_argument("--years", type=int, default=-10)
    parser.add_argument("--refresh", action="store_true")
    parser.add_argument("--master", default=None)
    parser.add_argument("--land-partitions", type=int, default=None)
    parser.add_argument("--keep-snapshots", type=int, default=None, help="remove older snapshots, and the versions and files that only they read")
    parser.add_argument("--quarantine", default=None, help="folder of rows that break a table's contract (default: <warehouse>/_quarantine)")
    args = parser.parse_args(argv)
    spark = spark or build_session(args.master)
    raw = os.path.abspath(args.raw) if "://" not in args.raw else args.raw
    counts: dict = {}
    report = ContractReport(args.quarantine or f"{args.warehouse.rstrip('/')}/_quarantine")
    written = run(spark, raw, args.warehouse, args.run_date, args.years, args.refresh, args.land_partitions, report, counts)
    if args.keep_snapshots is not None:
        clean_up(spark, args.warehouse, args.keep_snapshots)
    print(json.dumps({**written, "sources": counts, "contract": report.batches}, indent=1))
    return written


if __name__ == "__main__":
    main()
