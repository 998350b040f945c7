"""Snapshots of a warehouse: whole loads or nothing, clean-up by pointer, scratch that goes away."""

import datetime as dt
import os

import pytest

from conftest import write_json
from epistar.operators import manifest as mf
from epistar.operators import snapshot as sn
from epistar.operators.warehouse import load_table, refresh_tables
from epistar.session import cut_lineage, scratch_scope
from epistar.spec import TableSpec

SPECS = {n: TableSpec(n, "fact", ("k",), {"a": "string"}, key_types={"k": "bigint"}) for n in ("t", "u")}
T0 = dt.datetime(2024, 1, 1)


def load(spark, root, name, rows):
    load_table(spark, SPECS[name], spark.createDataFrame(rows, "k long, a string"), f"{root}/{name}", T0)


def state(spark, root, number=None):
    return {n: sorted((r["k"], r["a"]) for r in df.collect()) for n, df in sn.read_snapshot(spark, root, number).items()}


def test_a_reader_sees_whole_loads_only(spark, scratch):
    assert sn.read_snapshot(spark, scratch) == {}
    load(spark, scratch, "t", [(1, "x")])
    assert sn.publish(spark, scratch, ["t", "u"]) == 1  # u has no version yet
    assert state(spark, scratch) == {"t": [(1, "x")]}
    # a refresh that stops halfway: tables are emptied, one is loaded again, nothing is published
    refresh_tables(spark, SPECS, scratch, T0)
    load(spark, scratch, "u", [(9, "u")])
    assert mf.read_current(spark, f"{scratch}/t").count() == 0
    assert state(spark, scratch) == {"t": [(1, "x")]}
    load(spark, scratch, "t", [(2, "y")])
    assert sn.publish(spark, scratch, ["t", "u"]) == 2
    assert state(spark, scratch) == {"t": [(2, "y")], "u": [(9, "u")]}
    assert state(spark, scratch, 1) == {"t": [(1, "x")]}


def test_a_snapshot_is_not_replaced(spark, scratch):
    load(spark, scratch, "t", [(1, "x")])
    sn.publish(spark, scratch, ["t"])
    with pytest.raises(FileExistsError):
        mf.commit_text(spark, f"{scratch}/{sn.FOLDER}/000001.json", "{}")
    assert sn.snapshot_versions(spark, scratch) == {"t": 1}
    assert os.listdir(f"{scratch}/{sn.FOLDER}").count("000001.json") == 1 and len(sn.list_snapshots(spark, scratch)) == 1


def test_clean_up_keeps_what_a_kept_snapshot_reads(spark, scratch):
    assert sn.clean_up(spark, scratch) == {}
    for k in range(1, 5):
        load(spark, scratch, "t", [(k % 2, f"v{k}")])
        if k == 1:
            load(spark, scratch, "u", [(0, "once")])
        if k != 2:
            sn.publish(spark, scratch, ["t", "u"])
    load(spark, scratch, "t", [(7, "not published yet")])
    want = {n: state(spark, scratch, n) for n in (2, 3)}
    removed = sn.clean_up(spark, scratch, keep=2)
    assert sn.list_snapshots(spark, scratch) == [2, 3] and removed["t"] > 0 and removed["u"] == 0
    assert {n: state(spark, scratch, n) for n in (2, 3)} == want
    assert mf.list_versions(spark, f"{scratch}/t") == [3, 4, 5] and mf.read_current(spark, f"{scratch}/t").count() == 3
    assert sn.clean_up(spark, scratch, keep=2) == {"t": 0, "u": 0}
    with pytest.raises(ValueError):
        sn.clean_up(spark, scratch, keep=0)


def test_scratch_tables_of_a_scope_go_with_it(spark):
    before = cut_lineage(spark.range(5))
    with pytest.raises(RuntimeError), scratch_scope(spark) as folder:
        inner = cut_lineage(spark.range(7))
        assert inner.count() == 7 and len(os.listdir(folder)) == 1
        raise RuntimeError("a load that fails")
    assert not os.path.exists(folder) and before.count() == 5
    after = cut_lineage(spark.range(3))
    assert after.count() == 3 and folder not in after.inputFiles()[0]


def test_the_command_line_publishes_and_cleans_up(spark, scratch):
    from epistar.cli import main

    raw, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    os.makedirs(raw)
    write_json(raw, "vaccine-tracker.json", [{"YearWeekISO": "2021-W10", "ReportingCountry": "DE", "Region": "DE", "TargetGroup": "ALL", "Vaccine": "COM", "FirstDose": 3}])
    args = ["--raw", raw, "--warehouse", wh, "--run-date", "2022-01-01", "--years", "-1", "--refresh", "--keep-snapshots", "1"]
    tables = os.path.join(spark.conf.get("spark.checkpoint.dir"), "tables")
    main(args, spark)
    there = set(os.listdir(tables))
    main(args, spark)
    assert set(os.listdir(tables)) == there
    assert sn.list_snapshots(spark, wh) == [2]
    fact = sn.read_snapshot(spark, wh)["fact_vaccine_tracker_country"]
    assert [r["first_dose"] for r in fact.collect()] == [3]
    assert len(mf.list_versions(spark, f"{wh}/fact_vaccine_tracker_country")) == 1
