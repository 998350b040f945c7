import json
import os

import pytest

from epistar.sources import files


def _write(folder, name, payload):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf8") as fh:
        fh.write(payload if isinstance(payload, str) else json.dumps(payload))
    return path


def test_records_and_arrays_keep_file_order(spark, scratch):
    a = _write(scratch, "a.json", {"records": [{"x": 3}, {"x": 1}, {"x": 2}]})
    b = _write(scratch, "b.json", [{"x": 9}, {"x": 8}])
    rec = files.read_json_records(spark, a).orderBy("_pos").collect()
    assert [(r.x, r._pos) for r in rec] == [(3, 0), (1, 1), (2, 2)]
    arr = files.read_json_records(spark, b).orderBy("_pos").collect()
    assert [r.x for r in arr] == [9, 8]
    typed = files.read_json_records(spark, a, "x bigint, y string")
    assert typed.columns[:2] == ["x", "y"]
    # with a schema, both shapes are told apart from their first byte and read together
    both = files.read_json_records(spark, [a, b], "x bigint")
    assert sorted(r.x for r in both.collect()) == [1, 2, 3, 8, 9]
    assert files.json_shape(spark, a) == "object" and files.json_shape(spark, b) == "array"


def test_unsupported_json_raises(spark, scratch):
    bad = _write(scratch, "bad.json", "42")
    with pytest.raises(ValueError):
        files.read_json_records(spark, bad)
    with pytest.raises(ValueError):
        files.read_json_records(spark, bad, "x bigint")


def test_leading_blanks_and_byte_order_mark(spark, scratch):
    far = _write(scratch, "far.json", " \n" * 5000 + '{"records": [{"x": 1}]}')
    marked = _write(scratch, "bom.json", "\ufeff" + '[{"x": 2}]')
    assert files.json_shape(spark, far) == "object" and files.json_shape(spark, marked) == "array"
    assert [r.x for r in files.read_json_records(spark, far, "x bigint").collect()] == [1]


def test_shapes_mix_without_a_schema_and_broken_documents_fail(spark, scratch):
    a = _write(scratch, "a.json", {"records": [{"x": 3}]})
    b = _write(scratch, "b.json", [{"x": 9}])
    assert sorted(r.x for r in files.read_json_records(spark, [a, b]).collect()) == [3, 9]
    broken = _write(scratch, "broken.json", '{"records": [{"x": 1}, {"x": 2')
    with pytest.raises(Exception):
        files.read_json_records(spark, broken, "x bigint").collect()


def test_find_files_and_manifest(spark, scratch):
    assert files.find_files(spark, scratch, "nationalcasedeath*.json") is None
    for name in ("nationalcasedeath.json", "nationalcasedeath_archive.json", "other.json"):
        _write(scratch, name, [{"x": 1}])
    found = files.find_files(spark, scratch, "nationalcasedeath*.json")
    assert [os.path.basename(f) for f in found] == ["nationalcasedeath.json", "nationalcasedeath_archive.json"]
    listing = files.list_files(spark, os.path.join(scratch, "*.json"))
    manifest = listing.filter(listing.path.endswith("other.json")).select("path")
    new = {os.path.basename(r.path) for r in files.unseen_files(listing, manifest).collect()}
    assert new == {"nationalcasedeath.json", "nationalcasedeath_archive.json"}


def test_land_write_and_read_back(spark, scratch):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    path = files.land_parquet(df, os.path.join(scratch, "landed"), partitions=4)
    assert files.read_cleansed(spark, path).count() == 100
    out = files.write_datasets({"a": df, "b": df.limit(3)}, os.path.join(scratch, "clean"))
    files.write_datasets({"b": df.limit(2)}, os.path.join(scratch, "clean"), mode="append")
    assert files.read_cleansed(spark, out["b"]).count() == 5
    lines = _write(scratch, "rows.jsonl", '{"k": 1}\n{"k": 2}\n')
    assert files.read_cleansed(spark, lines, "jsonl").count() == 2
