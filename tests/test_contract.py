"""Contract checks: counts of one pass, quarantine, facts of one row per key in the assembled star."""

import datetime as dt
import json

from epistar.operators.contract import ContractReport, admit, contract_rules
from epistar.operators.warehouse import load_table, read_current
from epistar.plans.assemble import conform_fact
from epistar.spec import DIM_COUNTRY, FACT_CD_DAILY, FACTS

TS = dt.datetime(2024, 1, 1)
COUNTRY = "country_code string, country_name string, territory_code string, continent string, extra int"


def test_rows_that_break_a_rule_are_counted_and_kept_aside(spark, tmp_path):
    rows = [
        ("DE", "Germany", "DEU", "Europe", 1),
        (None, "Nowhere", "XXX", "Europe", 2),
        ("A" * 11, "Long code", "YYY", None, 3),
        ("A" * 10, "x" * 255, None, None, 4),
        (None, "y" * 256, None, None, 5),
    ]
    report = ContractReport(str(tmp_path / "q"))
    good = admit(spark.createDataFrame(rows, COUNTRY), DIM_COUNTRY, "mi", TS, report)
    assert sorted(r.extra for r in good.collect()) == [1, 4]
    assert report.batches == [
        {"table": "dim_country", "source": "mi", "rows": 5, "rejected": 3, "rules": {"null:country_code": 2, "length:country_code": 1, "length:country_name": 1}}
    ]
    kept = spark.read.parquet(str(tmp_path / "q" / "dim_country")).collect()
    assert {json.loads(r.row)["extra"]: sorted(r.rules) for r in kept} == {
        2: ["null:country_code"], 3: ["length:country_code"], 5: ["length:country_name", "null:country_code"],
    }
    admit(spark.createDataFrame(rows, COUNTRY), DIM_COUNTRY, "mi", TS, report)  # a rerun writes the same folder anew
    assert spark.read.parquet(str(tmp_path / "q" / "dim_country")).count() == 3 and report.rejected() == 6


def test_values_beyond_a_type_do_not_stop_the_load(spark, tmp_path):
    schema = "dim_date_key int, dim_country_key int, dim_source_key int, cases long, deaths_notification_rate double, deaths string"
    rows = [(1, 5, -1, 10, 1.5, "3"), (2, 5, 1, 2**40, 1.0, "1"), (3, 5, 1, 1, 1e9, "1"), (4, 5, 1, 1, 0.0, "many"), (None, 5, 1, 1, 0.0, "1"), (6, 5, 1, None, 0.0, "1")]
    report = ContractReport(str(tmp_path / "q"))
    good = admit(spark.createDataFrame(rows, schema), FACT_CD_DAILY, "nd", TS, report)
    root = str(tmp_path / "fact")
    load_table(spark, FACT_CD_DAILY, good, root, TS)
    assert [(r.dim_date_key, r.cases, r.deaths) for r in read_current(spark, root).collect()] == [(1, 10, 3)]
    assert report.batches[0]["rules"] == {
        "type:cases": 1, "type:deaths_notification_rate": 1, "type:deaths": 1, "null:dim_date_key": 1, "null:cases": 1, "unknown:dim_source_key": 1,
    }


def test_empty_batches_and_tables_without_the_columns(spark, tmp_path):
    report = ContractReport(str(tmp_path / "q"))
    assert admit(spark.createDataFrame([], COUNTRY), DIM_COUNTRY, "mi", TS, report).count() == 0
    assert admit(spark.createDataFrame([(1,)], "other int"), DIM_COUNTRY, "nd", TS, report).count() == 1
    assert [(b["rows"], b["rejected"]) for b in report.batches] == [(0, 0), (1, 0)]
    assert not (tmp_path / "q").exists()
    for spec in FACTS.values():
        assert set(spec.unique_keys) <= set(spec.required)
    assert "null:other" not in contract_rules(spark.createDataFrame([(1,)], "other int"), DIM_COUNTRY)


def test_assembled_facts_hold_one_row_per_key_like_the_loaded_table(spark, tmp_path):
    schema = "dim_date_key int, dim_country_key int, dim_source_key int, cases int, deaths int, _file string, _pos long"
    first = spark.createDataFrame([(1, 5, 1, 10, 1, "a", 2), (1, 5, 1, 20, 2, "a", 1), (2, None, 1, 3, 0, "a", 3), (2, None, 1, 4, 0, "a", 4)], schema)
    second = spark.createDataFrame([(1, 5, 1, 7), (3, 5, 1, 8)], "dim_date_key int, dim_country_key int, dim_source_key int, cases int")
    root = str(tmp_path / "fact")
    load_table(spark, FACT_CD_DAILY, first, root, TS, ["_file", "_pos"])
    one = ["dim_date_key", "dim_country_key", "dim_source_key", "cases", "deaths"]
    rows = lambda df: sorted((tuple(r) for r in df.select(*one).collect()), key=str)
    assert rows(conform_fact([first], FACT_CD_DAILY)) == rows(read_current(spark, root)) == [(1, 5, 1, 20, 2), (2, None, 1, 3, 0)]
    load_table(spark, FACT_CD_DAILY, second, root, TS)
    assert rows(conform_fact([first, second], FACT_CD_DAILY)) == rows(read_current(spark, root))
