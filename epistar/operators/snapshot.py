"""Warehouse snapshots (H9): one pointer for all tables, and clean-up by it.

A load writes several tables, one version after another. Who reads each table's last version meanwhile may
see emptied facts beside loaded dimensions. ``<warehouse>/_snapshots/<n>.json`` names a version of every table; it is
put in place by one rename when the whole load is done, so a reader of snapshots sees all of a load or nothing.
A load that fails leaves the last snapshot as it was.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from epistar.operators.manifest import commit_text, current_version, hadoop_fs, read_manifest, read_text, read_version, remove_versions

FOLDER = "_snapshots"
_NAME = re.compile(r"^(\d{6,})\.json$")


def _path(warehouse_root: str, number: int | None = None) -> str:
    folder = f"{warehouse_root.rstrip('/')}/{FOLDER}"
    return folder if number is None else f"{folder}/{number:06d}.json"


def list_snapshots(spark: SparkSession, warehouse_root: str) -> list[int]:
    fs, folder, _ = hadoop_fs(spark, _path(warehouse_root))
    if not fs.exists(folder):
        return []
    found = (_NAME.match(s.getPath().getName()) for s in fs.listStatus(folder))
    return sorted(int(m.group(1)) for m in found if m)


def snapshot_versions(spark: SparkSession, warehouse_root: str, number: int | None = None) -> dict[str, int]:
    """{table: version} of a snapshot, by default of the last; empty if there is none."""
    numbers = list_snapshots(spark, warehouse_root)
    if number is None and not numbers:
        return {}
    return json.loads(read_text(spark, _path(warehouse_root, numbers[-1] if number is None else number)))


def publish(spark: SparkSession, warehouse_root: str, tables: Iterable[str]) -> int:
    """Commit the tables' current versions as the next snapshot and return its number.

    Tables without a version are left out. Of two loads that publish at once one gets the number, the other fails
    (``FileExistsError``): loads of one warehouse follow one another.
    """
    versions = {}
    for name in tables:
        version = current_version(spark, f"{warehouse_root.rstrip('/')}/{name}")
        if version is not None:
            versions[name] = version.number
    numbers = list_snapshots(spark, warehouse_root)
    number = numbers[-1] + 1 if numbers else 1
    commit_text(spark, _path(warehouse_root, number), json.dumps(versions, sort_keys=True))
    return number


def read_snapshot(spark: SparkSession, warehouse_root: str, number: int | None = None) -> dict[str, DataFrame]:
    """All tables as one load left them: of the last snapshot, or of an earlier one that is kept."""
    root = warehouse_root.rstrip("/")
    versions = snapshot_versions(spark, root, number)
    return {name: read_version(spark, read_manifest(spark, f"{root}/{name}", v)) for name, v in versions.items()}


def clean_up(spark: SparkSession, warehouse_root: str, keep: int = 2) -> dict[str, int]:
    """Drop all snapshots but the last ``keep``, and of every table they name the versions and files that no kept one reads.

    Versions above the last snapshot's, of a load that runs or failed, are left alone. Returns the removed files by table.
    """
    if keep < 1:
        raise ValueError("keep at least one snapshot")
    root = warehouse_root.rstrip("/")
    numbers = list_snapshots(spark, root)
    if not numbers:
        return {}
    pinned: dict[str, set[int]] = {}
    for number in numbers:
        for name, version in snapshot_versions(spark, root, number).items():
            versions = pinned.setdefault(name, set())
            if number in numbers[-keep:]:
                versions.add(version)
    # pointers go first: a version is never removed while a snapshot that is there names it
    fs, _, jvm = hadoop_fs(spark, root)
    for number in numbers[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(_path(root, number)), False)
    return {name: remove_versions(spark, f"{root}/{name}", versions) for name, versions in pinned.items() if versions}
