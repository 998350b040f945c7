"""The splittable records reader against the one-task reader."""

from __future__ import annotations

import json
import random

import pytest

from epistar.sources.files import read_json_records
from epistar.sources.records import read_records_split, split_records

SCHEMA = "a string, b bigint, c struct<d: array<struct<e: string>>>"


@pytest.fixture()
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    # ranges shorter than the longest record, so that records, strings and nested objects reach over several
    spark.conf.set(key, "701")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def records(seed, n):
    rng = random.Random(seed)
    tricky = ['x', '}', '{', '},{', '\\', '"', '\\"', '"}]', 'é', '\n', ']', '"records":[', '漢', ' ' * 30]
    text = lambda: "".join(rng.choice(tricky) for _ in range(rng.randint(0, 12)))
    out = []
    for k in range(n):
        nested = {"d": [{"e": text()} for _ in range(rng.randint(0, 4))]} if rng.random() < 0.7 else None
        out.append({"a": text() if k != 7 else "long } { \" " * 150, "b": k, "c": nested})
    return out


def documents(seed):
    recs = records(seed, 60)
    other = {"meta": {"x": {"y": "}"}, "list": [1, {"records": [{"a": "not this"}]}]}, "z": "records"}
    yield "plain", json.dumps({"records": recs})
    yield "pretty", json.dumps({**other, "records": recs, "tail": [{"a": "nor this"}]}, indent=2, ensure_ascii=False) + "\n\n"
    yield "array", json.dumps(recs, ensure_ascii=False)
    yield "array_pretty", json.dumps(recs, indent=1) + "\n"
    if seed == 5:
        return
    yield "marked", "﻿" + json.dumps({"records": recs})
    yield "marked_array", "﻿" + json.dumps(recs) + " "


def rows(df):
    return sorted((r["_pos"], r["a"], r["b"], str(r["c"])) for r in df.collect())


def test_many_tasks_read_what_one_task_reads(spark, scratch, small_splits):
    for name, text in documents(3):
        path = f"{scratch}/{name}.json"
        with open(path, "w", encoding="utf8", newline="") as fh:
            fh.write(text)
        split = read_records_split(spark, path, SCHEMA)
        want = [(k, r["a"], r["b"]) for k, r in enumerate(records(3, 60))]
        got = rows(split)
        assert [g[:3] for g in got] == want, name
        if not name.startswith("marked"):
            assert got == rows(read_json_records(spark, path, SCHEMA)), name
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 5


def test_several_documents_number_their_own_records(spark, scratch, small_splits):
    paths = []
    for k, (name, text) in enumerate(documents(5)):
        if k < 3:
            paths.append(f"{scratch}/{name}.json")
            with open(paths[-1], "w", encoding="utf8") as fh:
                fh.write(text)
    got = read_records_split(spark, paths, SCHEMA).groupBy("_file").count().collect()
    assert [r["count"] for r in got] == [60] * 3
    assert read_records_split(spark, paths, SCHEMA).groupBy("_file", "_pos").count().where("count > 1").count() == 0


@pytest.mark.parametrize("at", [5, 333, -1, -2])
def test_a_document_that_breaks_off_fails(spark, scratch, at):
    text = json.dumps({"records": records(8, 12)})
    path = f"{scratch}/cut.json"
    with open(path, "w") as fh:
        fh.write(text[:at])
    with pytest.raises(ValueError):
        split_records(spark, path)


@pytest.mark.parametrize("text", ['{"other": [{"a": "x"}]}', '{"records": [1, {"a": "x"}]}', '{"records": [{"a": "x"}, [2]]}', '[{"a": "x"}, "y"]', '"text"', '[{"a": "x"}]]'])
def test_other_shapes_fail(spark, scratch, text):
    path = f"{scratch}/odd.json"
    with open(path, "w") as fh:
        fh.write(text)
    with pytest.raises(ValueError):
        split_records(spark, path)


def test_empty_arrays_and_records_that_do_not_fit(spark, scratch):
    path = f"{scratch}/none.json"
    with open(path, "w") as fh:
        fh.write('{"records": [ ]}')
    assert read_records_split(spark, path, SCHEMA).count() == 0
    with open(path, "w") as fh:
        fh.write('{"records": [{"b": "not a number"}]}')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|failfast"):
        read_records_split(spark, path, SCHEMA).collect()
