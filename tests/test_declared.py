"""Declared fields: sources that differ in types, keys and layout read alike."""

import os

import pytest

from conftest import CASES_DAILY, CASES_WEEKLY, write_json
from epistar.cli import transform_landed
from epistar.operators.lookup import prepare_lookup
from epistar.plans import cases_deaths, movement, vaccines
from epistar.sources.declared import CASES_FIELDS, VACCINE_FIELDS, read_declared
from epistar.sources.files import find_files, read_json_records, read_lookup_csv


def _rows(df):
    names = sorted(c for c in df.columns if c != "_file")
    return sorted((tuple(None if r[c] is None else str(r[c]) for c in names) for r in df.collect()), key=str)


def test_declared_sources_give_the_outputs_of_inferred_ones(spark, landed):
    lk = prepare_lookup(read_lookup_csv(spark, os.path.join(landed, "data.csv")), pos_col="_pos")
    inferred = lambda pattern: [read_json_records(spark, f) for f in find_files(spark, landed, pattern)]
    want = {
        "mi": movement.transform(inferred("movementindicators*.json"), lk),
        "nd": cases_deaths.transform(inferred("nationalcasedeath*.json"), lk),
        "vt": vaccines.transform(inferred("vaccine-tracker*.json")),
    }
    counts = {}
    got = transform_landed(spark, landed, counts=counts)
    assert sum(c["rows"] for c in counts.values()) == 17 and not any(c["undeclared"] for c in counts.values())
    for source, tables in want.items():
        for name, table in tables.items():
            assert set(table.columns) == set(got[source][name].columns), name
            assert _rows(table) == _rows(got[source][name]), name


def test_text_and_numbers_of_one_field_read_alike(spark, scratch):
    as_numbers = [{"YearWeekISO": "2021-W10", "FirstDose": 7, "NumberDosesReceived": 12, "FirstDoseRefused": 2}]
    as_text = [{"YearWeekISO": "2021-W10", "FirstDose": "7", "NumberDosesReceived": "12.0", "FirstDoseRefused": "2"}]
    frames = [read_declared(spark, write_json(scratch, f"{k}.json", rows), VACCINE_FIELDS)[0] for k, rows in enumerate([as_numbers, as_text])]
    assert frames[0].dtypes == frames[1].dtypes
    assert [tuple(r)[:4] for r in frames[0].collect()] == [tuple(r)[:4] for r in frames[1].collect()] == [("2021-W10", 7, "2", 12)]


def test_columns_are_those_that_some_record_has(spark, scratch):
    rows = [*CASES_DAILY[:2], {**CASES_DAILY[2], "note": "x", "deaths": "none"}]
    rows = [{k: v for k, v in r.items() if k != "month" or i == 2} for i, r in enumerate(rows)]
    df, counts = read_declared(spark, write_json(scratch, "d.json", rows), CASES_FIELDS)
    assert "month" in df.columns and "note" not in df.columns and "year_week" not in df.columns
    assert counts == {"rows": 3, "undeclared": 1}
    assert [(r["_pos"], r["month"], r["deaths"]) for r in df.orderBy("_pos").collect()] == [(0, None, 1), (1, None, 2), (2, 3, None)]
    # a key that is null everywhere is a column still
    df, _ = read_declared(spark, write_json(scratch, "n.json", [{"year_week": "2021-10", "source": None}]), CASES_FIELDS)
    assert df.columns == ["year_week", "source", "_file", "_pos"]


def test_names_that_differ_in_case_are_one_column(spark, scratch):
    from epistar.sources.declared import MOVEMENT_FIELDS

    rows = [{"Country": None, "country": "Italy", "Week": "2021-W10"}, {"Country": "France", "country": "Italy"}]
    df, _ = read_declared(spark, write_json(scratch, "c.json", rows), MOVEMENT_FIELDS)
    assert [tuple(r)[:2] for r in df.orderBy("_pos").collect()] == [("Italy", "2021-W10"), ("France", None)]


def test_broken_and_empty_documents(spark, scratch):
    path = write_json(scratch, "cut.json", CASES_WEEKLY)
    body = open(path, encoding="utf8").read()
    with open(path, "w", encoding="utf8") as fh:
        fh.write(body[: len(body) // 2])
    with pytest.raises(ValueError):
        read_declared(spark, path, CASES_FIELDS)
    df, counts = read_declared(spark, write_json(scratch, "empty.json", []), CASES_FIELDS)
    assert df.columns == ["_file", "_pos"] and counts["rows"] == 0


def test_a_repeated_key_and_nested_values(spark, scratch):
    path = os.path.join(scratch, "twice.json")
    with open(path, "w", encoding="utf8") as fh:
        fh.write('[{"a": "1", "a": "2", "b": {"x": [1, "}"]}, "c": true}]')
    df, _ = read_declared(spark, path, {"a": "bigint", "b": "string", "c": "string"})
    assert [tuple(r)[:3] for r in df.collect()] == [(1, '{"x":[1,"}"]}', "true")]
