import datetime as dt
import os

from epistar.operators.lookup import prepare_lookup
from epistar.operators.warehouse import read_current
from epistar.plans import cases_deaths, movement, star, vaccines
from epistar.plans.load import load_warehouse, table_root
from epistar.sources.files import find_files, read_json_records, read_lookup_csv

BATCH = dt.datetime(2024, 5, 1)


def _inputs(spark, raw, pattern):
    return [read_json_records(spark, f) for f in find_files(spark, raw, pattern)]


def _outputs(spark, raw):
    lk = prepare_lookup(read_lookup_csv(spark, os.path.join(raw, "data.csv")), pos_col="_pos")
    return {
        "mi": movement.transform(_inputs(spark, raw, "movementindicators*.json"), lk),
        "nd": cases_deaths.transform(_inputs(spark, raw, "nationalcasedeath*.json"), lk),
        "vt": vaccines.transform(_inputs(spark, raw, "vaccine-tracker*.json")),
    }


def test_lookup_keeps_namibia(spark, landed):
    lk = read_lookup_csv(spark, os.path.join(landed, "data.csv"))
    assert lk.filter("Name = 'Namibia'").first().Code == "NA"


def test_cases_deaths(spark, landed):
    out = _outputs(spark, landed)["nd"]
    weekly = {r.country_code: r for r in out["fact_cases_deaths_country_weekly"].collect()}
    assert set(weekly) == {"DE", "NA"}  # continent rows are not country facts
    de = weekly["DE"]
    assert (de.cases, de.deaths, de.cases_cumulative, de.deaths_notification_rate) == (1000, 10, 5000, 0.1)
    assert de.week_start_date == dt.date(2021, 3, 8)
    daily = sorted((r.date.day, r.cases, r.cases_cumulative, r.deaths_cumulative, r.cases_notification_rate) for r in out["fact_cases_deaths_country_daily"].collect())
    # 1 March has no weekly row and is dropped; its cases still count in the running total
    assert daily == [(8, 100, 107, 1, 2.5), (9, None, None, 3, 2.5), (10, 50, 157, 3, 2.5)]
    assert {r.source_name for r in out["dim_source"].collect()} == {"TESSy", cases_deaths.DEFAULT_SOURCE}
    assert {r.country_code: r.territory_code for r in out["dim_country"].collect()} == {"DE": "DEU", "NA": "NAM"}


def test_movement(spark, landed):
    out = _outputs(spark, landed)["mi"]
    nat = {(r.country_code, r.week_start_date): r for r in out["fact_movement_indicators_country"].collect()}
    cz = [nat[("CZ", dt.date(2021, 3, d))].new_cases_last_14days for d in (8, 15, 22)]
    assert cz == [100, 170, 120]
    # same week number in two years stays two rows
    assert ("DE", dt.date(2021, 3, 8)) in nat and ("DE", dt.date(2022, 3, 7)) in nat
    status = {r.colour_name: r.colour_description for r in out["dim_status"].collect()}
    assert status["dark red"] == "Weighted rate is 300 or more" and status["purple"] == "purple"
    reg = {r.region_code: r for r in out["fact_movement_indicators_region"].collect() if r.region_code == "DE1"}
    assert reg["DE1"].notification_rate == 120.5 and reg["DE1"].testing_rate == 900.0


def test_vaccines(spark, landed):
    out = _outputs(spark, landed)["vt"]
    nat = {r.country_code: r for r in out["fact_vaccine_tracker_country"].collect()}
    assert nat["DE"].doses_received == 0  # "n/a" -> null -> 0
    assert nat["DE"].first_dose_refused is None  # strings keep their nulls
    assert nat["FR"].week_start_date == dt.date(2020, 12, 28)
    reg = out["fact_vaccine_tracker_region"].first()
    assert (reg.region_code, reg.denominator, reg.second_dose) == ("DE1", 12, 0)
    groups = {r.target_group: (r.age_lower_limit, r.age_upper_limit) for r in out["dim_target_group"].collect()}
    assert groups == {"Age10_14": (10, 14), "1_Age60+": (60, 200), "ALL": (0, 200)}


def test_load_warehouse_and_star(spark, landed, scratch):
    root = os.path.join(scratch, "warehouse")
    outputs = _outputs(spark, landed)
    span = {"start": dt.date(2022, 12, 31), "num_years": -3}
    load_warehouse(spark, outputs, root, BATCH, date_span_args=span, refresh=True)
    tables = {name: read_current(spark, table_root(root, name)) for name in [
        "dim_date", "dim_country", "dim_region", "dim_status", "dim_source", "dim_target_group", "dim_vaccine",
        "fact_cases_deaths_country_daily", "fact_cases_deaths_country_weekly", "fact_movement_indicators_country",
        "fact_movement_indicators_region", "fact_vaccine_tracker_country", "fact_vaccine_tracker_region"]}
    dims = {k: v for k, v in tables.items() if k.startswith("dim_")}
    facts = {k: v for k, v in tables.items() if k.startswith("fact_")}
    countries = {r.country_code: r for r in dims["dim_country"].collect()}
    assert {"--", "DE", "FR", "CZ", "NA"} <= set(countries)
    assert countries["DE"].territory_code == "DEU"  # a later source filled a column the first lacked
    weekly = facts["fact_cases_deaths_country_weekly"].collect()
    assert all(r.dim_country_key > 0 and r.dim_week_start_date_key > 0 for r in weekly)
    daily = facts["fact_cases_deaths_country_daily"]
    assert daily.filter("dim_source_key = -1").count() == 0
    trend = star.weekly_cases_trend(facts, dims).collect()
    assert any(r.continent == "Europe" and r.continent_cases == 1000 for r in trend)
    doses = star.doses_by_group_and_vaccine(facts, dims).collect()
    assert sum(r.first_dose for r in doses) == 17
    assert star.regions_per_status(facts, dims).count() > 0
    assert star.testing_national_vs_regional(facts, dims).count() > 0
    # a second identical load changes nothing but the audit time
    before = sorted(tuple(r)[:-2] for r in facts["fact_cases_deaths_country_weekly"].collect())
    load_warehouse(spark, outputs, root, dt.datetime(2024, 5, 2), date_span_args=span)
    after = sorted(tuple(r)[:-2] for r in read_current(spark, table_root(root, "fact_cases_deaths_country_weekly")).collect())
    assert before == after


def test_command_line_run(spark, landed, scratch):
    from epistar.cli import main

    wh = os.path.join(scratch, "wh_cli")
    written = main(
        ["--raw", landed, "--warehouse", wh, "--run-date", "2022-12-31", "--years", "-3", "--refresh", "--land-partitions", "3"],
        spark,
    )
    assert {"dim_date", "dim_country", "fact_cases_deaths_country_weekly", "fact_vaccine_tracker_country"} <= set(written)
    weekly = read_current(spark, table_root(wh, "fact_cases_deaths_country_weekly"))
    assert weekly.count() == 2


def test_transforms_without_country_list(spark, landed, scratch):
    out = cases_deaths.transform(_inputs(spark, landed, "nationalcasedeath*.json"), None)
    codes = {r.country_code for r in out["dim_country"].collect()}
    # the daily file's own code; weekly rows carry none without the list (a null-key group)
    assert codes == {"DE", None}


def test_daily_rows_without_a_week_can_be_kept(spark, landed):
    lk = prepare_lookup(read_lookup_csv(spark, os.path.join(landed, "data.csv")), pos_col="_pos")
    out = cases_deaths.transform(_inputs(spark, landed, "nationalcasedeath*.json"), lk, keep_unmatched_days=True)
    daily = {r.date.day: r for r in out["fact_cases_deaths_country_daily"].collect()}
    assert set(daily) == {1, 8, 9, 10}
    assert daily[1].cases_notification_rate is None and daily[1].cases_cumulative == 7
