"""Versions that share files: touched files only, epochs, null keys, failed writes, clean-up."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from epistar.operators import manifest as mf
from epistar.operators.warehouse import load_table
from epistar.spec import TableSpec

SPEC = TableSpec("t", "fact", ("k", "part"), {"a": "string", "b": "long"}, key_types={"k": "bigint", "part": "string"})
T = [dt.datetime(2024, 1, d) for d in range(1, 8)]
SCHEMA = "k long, part string, a string, b long"


def rows_of(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


@pytest.fixture()
def loaded(spark, scratch):
    root = os.path.join(scratch, "t")
    first = spark.range(0, 4000).select(F.col("id").alias("k"), F.lit("p").alias("part"), F.lit("x").alias("a"), F.col("id").alias("b"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    load_table(spark, SPEC, first, root, T[0])
    yield root
    spark.conf.set(key, "true")


def test_an_upsert_rewrites_the_files_it_hits_and_shares_the_rest(spark, loaded):
    before = mf.current_version(spark, loaded)
    assert len(before.files) >= 3 and sum(f["rows"] for f in before.files) == 4000
    load_table(spark, SPEC, spark.createDataFrame([(5, "p", "new", None), (9000, "p", "far", 1)], SCHEMA), loaded, T[1])
    after = mf.current_version(spark, loaded)
    old, new = {f["path"] for f in before.files}, {f["path"] for f in after.files}
    assert len(old - new) == 1 and len(old & new) == len(old) - 1
    got = {r["k"]: (r["a"], r["b"], r["created_ts"] == T[0]) for r in mf.read_current(spark, loaded).where("k in (5, 6, 9000)").collect()}
    assert got == {5: ("new", None, True), 6: ("x", 6, True), 9000: ("far", 1, False)}
    assert mf.read_current(spark, loaded).count() == 4001
    # new keys alone touch no file, inside the range of one or not
    load_table(spark, SPEC, spark.createDataFrame([(7, "other part", "y", 2)], SCHEMA), loaded, T[2])
    assert new < {f["path"] for f in mf.current_version(spark, loaded).files}
    # the older version still reads as it was
    assert mf.read_version(spark, before).count() == 4000


def test_null_keys_match_and_repeated_loads_change_nothing(spark, scratch):
    root = os.path.join(scratch, "n")
    source = spark.createDataFrame([(1, None, "x", 1), (None, None, "y", 2), (None, "p", "z", 3)], SCHEMA)
    for day in range(3):
        load_table(spark, SPEC, source, root, T[day])
    assert rows_of(mf.read_current(spark, root)) == rows_of(source)


def test_an_epoch_is_applied_once(spark, loaded):
    batch = lambda a: spark.createDataFrame([(1, "p", a, 1)], SCHEMA)
    path = load_table(spark, SPEC, batch("one"), loaded, T[1], commit=("stream", 4))
    # the table was committed, the stream's own checkpoint was not: the batch comes again
    assert load_table(spark, SPEC, batch("again"), loaded, T[2], commit=("stream", 4)) == path
    assert mf.list_versions(spark, loaded) == [1, 2]
    load_table(spark, SPEC, batch("two"), loaded, T[3], commit=("stream", 5))
    load_table(spark, SPEC, batch("other"), loaded, T[4], commit=("another", 0))
    assert mf.current_version(spark, loaded).epochs == {"stream": 5, "another": 0}
    assert mf.read_current(spark, loaded).where("k = 1").first()["a"] == "other"


def test_a_write_without_its_manifest_does_not_count(spark, loaded):
    spark.range(3).write.parquet(mf.version_path(loaded, 2))  # a job that failed before its commit
    assert mf.list_versions(spark, loaded) == [1] and mf.read_current(spark, loaded).count() == 4000
    load_table(spark, SPEC, spark.createDataFrame([(1, "p", "n", 1)], SCHEMA), loaded, T[1])
    assert mf.list_versions(spark, loaded) == [1, 3]


def test_old_versions_go_and_shared_files_stay(spark, loaded):
    for day, k in ((1, 5), (2, 3999), (3, 5)):
        load_table(spark, SPEC, spark.createDataFrame([(k, "p", f"d{day}", 1)], SCHEMA), loaded, T[day])
    want = rows_of(mf.read_current(spark, loaded))
    assert mf.remove_old_versions(spark, loaded, keep=1) >= 3
    assert mf.list_versions(spark, loaded) == [4] and rows_of(mf.read_current(spark, loaded)) == want
    assert mf.remove_old_versions(spark, loaded, keep=1) == 0


def test_files_out_of_range_are_not_looked_at(spark, loaded):
    version = mf.current_version(spark, loaded)
    near = mf.overlapping_files(version, spark.createDataFrame([(3, "p")], "k long, part string"), "k")
    assert [f["lo"] for f in near] == ["0"]
    assert mf.overlapping_files(version, spark.createDataFrame([(None, "p")], "k long, part string"), "k") == []
