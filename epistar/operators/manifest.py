"""Versioned Parquet tables whose versions share files.

``<table>/version=<n>/`` holds the data files that version added, and
``_manifest.json``: all files of the version (of older versions too), with the rows,
the range of the leading key and its nulls in each, the schema, and the last epoch of every stream
that wrote it. The manifest is put in place by one rename, last of all. A version
exists with its manifest, so a reader sees the old table or the new one, and a job that
fails in between leaves nothing behind that counts.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "_manifest.json"
_VERSION_RE = re.compile(r"version=(\d+)$")


@dataclass
class Version:
    """A committed version: ``files`` are dicts of path, rows, lo, hi (text of the leading key, or None) and nulls."""

    number: int
    schema: T.StructType
    lead: str | None
    files: list[dict] = field(default_factory=list)
    epochs: dict[str, int] = field(default_factory=dict)


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath, jvm = hadoop_fs(spark, path)
    stream = fs.open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, body: str) -> None:
    """Write a small file beside ``path`` and put it in place by one rename; one that is there already is not replaced."""
    fs, target, jvm = hadoop_fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(body.encode("utf8")))
    stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(f"{path} could not be committed")


def version_path(table_root: str, version: int) -> str:
    return f"{table_root.rstrip('/')}/version={version:06d}"


def list_versions(spark: SparkSession, table_root: str, complete_only: bool = True) -> list[int]:
    """Versions of a table, ascending; by default only committed ones (with a manifest)."""
    fs, root, jvm = hadoop_fs(spark, table_root)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        m = _VERSION_RE.match(status.getPath().getName())
        if m and (not complete_only or fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), MANIFEST))):
            out.append(int(m.group(1)))
    return sorted(out)


def read_manifest(spark: SparkSession, table_root: str, version: int) -> Version:
    raw = json.loads(read_text(spark, f"{version_path(table_root, version)}/{MANIFEST}"))
    return Version(version, T.StructType.fromJson(raw["schema"]), raw["lead"], raw["files"], raw["epochs"])


def current_version(spark: SparkSession, table_root: str) -> Version | None:
    versions = list_versions(spark, table_root)
    return read_manifest(spark, table_root, versions[-1]) if versions else None


def read_files(spark: SparkSession, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, version: Version) -> DataFrame:
    return read_files(spark, version.schema, [f["path"] for f in version.files])


def read_current(spark: SparkSession, table_root: str) -> DataFrame | None:
    """The last committed version of a table, or ``None`` if none exists."""
    version = current_version(spark, table_root)
    return None if version is None else read_version(spark, version)


def write_version(
    df: DataFrame,
    table_root: str,
    cluster_by: Sequence[str] = (),
    keep: Sequence[Mapping] = (),
    epochs: Mapping[str, int] | None = None,
) -> str:
    """Write ``df`` as files of the next version, commit it together with the files ``keep``, and return its path.

    Rows are written in ranges of ``cluster_by`` (all of it, so a leading key that many rows share is split), sorted
    within each file. Row groups outside a filter's range are skipped then, and a later batch meets the
    files of its own range only. Numbers of versions that a failed job left half-written are not used again.
    """
    spark = df.sparkSession
    versions = list_versions(spark, table_root, complete_only=False)
    path = version_path(table_root, (versions[-1] + 1) if versions else 1)
    if cluster_by:
        order = [F.col(c).asc_nulls_first() for c in cluster_by]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode("errorifexists").parquet(path)
    schema = spark.read.parquet(path).schema
    lead = cluster_by[0] if cluster_by else None
    key = F.col(lead) if lead else F.lit(None).cast("string")
    # reads the leading key's column only; a row a file
    stats = spark.read.schema(schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).cast("string").alias("lo"), F.max(key).cast("string").alias("hi"), F.count_if(key.isNull()).alias("nulls"))
    files = [dict(f) for f in keep] + [r.asDict() for r in stats.orderBy("path").collect()]
    body = json.dumps({"schema": json.loads(schema.json()), "lead": lead, "files": files, "epochs": dict(epochs or {})})
    commit_text(spark, f"{path}/{MANIFEST}", body)
    return path


def overlapping_files(version: Version, keys: DataFrame, lead: str) -> list[dict]:
    """Files of ``version`` whose range of the leading key meets that of ``keys`` (all if it has no ranges)."""
    if version.lead != lead or not version.files:
        return version.files
    kind = version.schema[lead].dataType
    span = keys.agg(F.min(lead).cast(kind).alias("a"), F.max(lead).cast(kind).alias("b"), F.count_if(F.col(lead).isNull()).alias("n")).first()
    rows = [(k, f["lo"], f["hi"], f["nulls"]) for k, f in enumerate(version.files)]
    listed = keys.sparkSession.createDataFrame(rows, "k int, lo string, hi string, nulls long")
    hit = F.lit(False)
    if span["a"] is not None:
        hit = (F.col("hi").cast(kind) >= F.lit(span["a"]).cast(kind)) & (F.col("lo").cast(kind) <= F.lit(span["b"]).cast(kind))
    hit = F.coalesce(hit, F.lit(False)) | (F.lit(span["n"] > 0) & (F.col("nulls") > 0))
    return [version.files[r["k"]] for r in listed.where(hit).select("k").collect()]


def files_with_keys(spark: SparkSession, version: Version, keys: DataFrame, names: Sequence[str]) -> list[dict]:
    """Files that hold at least one row with a key of ``keys`` (null-safe); reads the key columns of files in range."""
    near = overlapping_files(version, keys, names[0])
    if not near:
        return []
    seen = read_files(spark, version.schema, [f["path"] for f in near]).select(*names, F.col("_metadata.file_path").alias("_path"))
    side = keys.select(*[F.col(c).alias(f"_k_{c}") for c in names])
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in names]
    hit = {r["_path"] for r in seen.join(side, same, "left_semi").select("_path").distinct().collect()}
    return [f for f in near if f["path"] in hit]


def remove_old_versions(spark: SparkSession, table_root: str, keep: int = 2) -> int:
    """Drop all versions but the last ``keep`` and every data file that none of these lists; returns the files removed."""
    committed = list_versions(spark, table_root)
    return remove_versions(spark, table_root, set(committed[-keep:])) if committed else 0


def remove_versions(spark: SparkSession, table_root: str, pinned: set[int]) -> int:
    """Drop the versions below the last of ``pinned`` that are not in it, and every data file that no version left lists.

    Versions above it, committed or being written, are left alone. Returns the files removed.
    """
    committed = list_versions(spark, table_root)
    kept = [v for v in committed if v in pinned or v > max(pinned)]
    old = {v for v in committed if v not in kept}
    last = max(pinned)
    used = {f["path"] for v in kept for f in read_manifest(spark, table_root, v).files}
    removed = 0
    for number in list_versions(spark, table_root, complete_only=False):
        if number > last:
            continue
        fs, folder, jvm = hadoop_fs(spark, version_path(table_root, number))
        if number in old:
            fs.delete(jvm.org.apache.hadoop.fs.Path(folder, MANIFEST), False)
        left = 0
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if not name.endswith(".parquet"):
                continue
            if any(u.endswith(f"/{folder.getName()}/{name}") for u in used):
                left += 1
            else:
                fs.delete(status.getPath(), False)
                removed += 1
        if not left and number not in kept:
            fs.delete(folder, True)
    return removed
