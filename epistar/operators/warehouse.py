"""Validated insert and upsert into versioned Parquet tables (H2-H4, H7-H9).

Parquet has no row-level MERGE, so a load writes new files and commits a new
version of the table that lists them beside the files it left alone
(``operators/manifest.py``). The files being read are never
overwritten, and a failed job leaves the previous version intact.

An upsert rewrites the files that hold a key of the batch: the manifest's key ranges
leave few to look at, a semi-join on the key columns of those tells which are hit, and
only their rows meet the batch. Rows with new keys become files of their own.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epistar.operators.columns import fill_numeric_zero, present_in
from epistar.operators.dedupe import has_rows, keep_first
from epistar.operators.keys import assign_consecutive_keys, resolve_foreign_keys, unknown_member_row, with_unknown_member
from epistar.operators.manifest import (
    current_version,
    files_with_keys,
    list_versions,
    read_current,
    read_files,
    read_version,
    remove_old_versions,
    version_path,
    write_version,
)
from epistar.session import cut_lineage
from epistar.spec import AUDIT_COLUMNS, UNKNOWN_KEY, TableSpec

# Audit columns are wall-clock times without a zone (as the DDL's TIMESTAMP),
# so their values never depend on the session time zone.
AUDIT_TYPE = "timestamp_ntz"


def audit_time(batch_ts: _dt.datetime):
    """H7: a batch time as a zone-free timestamp literal."""
    return F.lit(batch_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(AUDIT_TYPE)


__all__ = ["current_version", "list_versions", "read_current", "remove_old_versions", "version_path", "write_version"]


def validate_against_spec(
    df: DataFrame, spec: TableSpec, order_cols: Sequence[str] | None = None
) -> tuple[DataFrame, list[str], list[str]] | None:
    """H2: keys present -> prune to table columns -> one row per key.

    Returns ``(rows, keys, supplied_columns)`` or ``None`` when a unique-key
    column is missing. The first row per key wins (by ``order_cols`` when
    given, else by the smallest row value with nulls last, which is
    deterministic). A dimension's member needs a whole business key: rows
    with a null in it are left out, and facts that point there fall to the
    unknown member.
    """
    found = one_row_per_key(df, spec, order_cols)
    if found is None:
        return None
    rows, keys, supplied = found
    return rows.select(*[F.col(c).cast(spec.type_of(c)).alias(c) for c in keys + supplied]), keys, supplied


def one_row_per_key(
    df: DataFrame, spec: TableSpec, order_cols: Sequence[str] | None = None
) -> tuple[DataFrame, list[str], list[str]] | None:
    """The rows of ``validate_against_spec`` in the types they came with."""
    keys = list(spec.unique_keys)
    if not set(keys).issubset(df.columns):
        return None
    supplied = present_in(df, [c for c in spec.columns if c not in keys])
    cols = keys + supplied
    rows = df.select(*cols, *[c for c in (order_cols or []) if c not in cols])
    if spec.kind == "dimension":
        rows = rows.dropna(subset=keys)
    if supplied:
        if order_cols:
            rows = keep_first(rows, cols, keys, order_cols)
        else:
            nulls_last = [x for c in supplied for x in (F.col(c).isNull(), F.col(c))]
            rows = rows.groupBy(*keys).agg(F.min_by(F.struct(*supplied), F.struct(*nulls_last)).alias("_r")).select(*keys, "_r.*")
    else:
        rows = rows.select(*keys).distinct()
    return rows.select(*cols), keys, supplied


def _typed_null(spec: TableSpec, col: str):
    return F.lit(None).cast(spec.type_of(col)).alias(col)


def _complete(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Order and type the columns as the table has them (absent ones null)."""
    names = set(df.columns)
    cols = []
    for c in spec.all_columns + list(AUDIT_COLUMNS):
        if c in names:
            t = AUDIT_TYPE if c in AUDIT_COLUMNS else spec.type_of(c)
            cols.append(F.col(c).cast(t).alias(c))
        else:
            cols.append(_typed_null(spec, c) if c not in AUDIT_COLUMNS else F.lit(None).cast(AUDIT_TYPE).alias(c))
    return df.select(*cols)


def insert_rows(
    target: DataFrame | None,
    source: DataFrame,
    spec: TableSpec,
    batch_ts: _dt.datetime,
    order_cols: Sequence[str] | None = None,
) -> DataFrame | None:
    """H3 (+H5, H7): append validated rows; dimensions get new surrogate keys.

    Returns the whole new table, or ``None`` if validation fails.
    """
    valid = validate_against_spec(source, spec, order_cols)
    if valid is None:
        return None
    rows, keys, _ = valid
    rows = rows.withColumns({"created_ts": audit_time(batch_ts), "updated_ts": audit_time(batch_ts)})
    if spec.surrogate_key:
        start = _max_key(target, spec)
        rows = assign_consecutive_keys(rows, keys, spec.surrogate_key, start)
    new = _complete(rows, spec)
    out = new if target is None else _complete(target, spec).unionByName(new)
    if spec.kind == "dimension" and spec.unknown_member:
        # H6: a dimension always holds its unknown member (added once)
        has_unknown = target is not None and not target.filter(F.col(spec.surrogate_key) == UNKNOWN_KEY).limit(1).isEmpty()
        if not has_unknown:
            unknown = unknown_member_row(source.sparkSession, spec).withColumns(
                {"created_ts": audit_time(batch_ts), "updated_ts": audit_time(batch_ts)}
            )
            out = out.unionByName(_complete(unknown, spec))
    return out


def _max_key(target: DataFrame | None, spec: TableSpec) -> int:
    if target is None:
        return 0
    value = target.agg(F.max(spec.surrogate_key)).first()[0]
    return max(int(value or 0), 0)


def upsert_rows(
    target: DataFrame,
    source: DataFrame,
    spec: TableSpec,
    batch_ts: _dt.datetime,
    order_cols: Sequence[str] | None = None,
) -> DataFrame | None:
    """H4 (+H5, H7): MERGE semantics on the unique keys; returns the whole new table.

    Matched rows take every *supplied* column from the source (a supplied
    null overwrites), keep unsupplied columns and ``created_ts``, and get
    ``updated_ts = batch_ts``. Unmatched source rows are inserted, with new
    surrogate keys for dimensions. Keys match null-safely, so a fact with a null in its key is
    one row however often it is loaded. Running the same
    source twice gives the same table apart from ``updated_ts``.
    """
    valid = validate_against_spec(source, spec, order_cols)
    if valid is None:
        return None
    src, keys, supplied = valid
    return _merged(target, _batch(src, keys, supplied), keys, supplied, spec, batch_ts, _max_key(target, spec) if spec.surrogate_key else 0)


def _batch(src: DataFrame, keys: Sequence[str], supplied: Sequence[str]) -> DataFrame:
    """The validated batch, written once: all steps of the merge, and retried tasks, read the same rows."""
    return cut_lineage(src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in supplied], F.lit(True).alias("_in_s")))


def _merged(
    target: DataFrame, src: DataFrame, keys: Sequence[str], supplied: Sequence[str], spec: TableSpec, batch_ts: _dt.datetime, start: int
) -> DataFrame:
    """``target`` with the batch merged in; new members are numbered after ``start``."""
    tgt = _complete(target, spec).withColumn("_in_t", F.lit(True))
    side = src.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in src.columns if c not in keys])
    both = tgt.join(side, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "full_outer")
    in_s, in_t = F.coalesce(F.col("_in_s"), F.lit(False)), F.coalesce(F.col("_in_t"), F.lit(False))
    merged_cols = {k: F.when(in_t, F.col(k)).otherwise(F.col(f"_k_{k}")) for k in keys}
    merged_cols |= {c: F.when(in_s, F.col(f"_s_{c}")).otherwise(F.col(c)) for c in supplied}
    merged_cols["created_ts"] = F.coalesce(F.col("created_ts"), audit_time(batch_ts))
    merged_cols["updated_ts"] = F.when(in_s, audit_time(batch_ts)).otherwise(F.col("updated_ts"))
    merged = both.withColumns(merged_cols)
    if not spec.surrogate_key:
        return _complete(merged, spec)
    inserted = assign_consecutive_keys(merged.filter(~in_t).drop(spec.surrogate_key), keys, spec.surrogate_key, start)
    return _complete(merged.filter(in_t), spec).unionByName(_complete(inserted, spec))


def prepare_fact(
    fact: DataFrame,
    spec: TableSpec,
    dimensions: Mapping[str, DataFrame],
    dim_specs: Mapping[str, TableSpec],
) -> DataFrame:
    """D6 step: resolve every foreign key (J6-J8), then numeric nulls -> 0."""
    out = resolve_foreign_keys(fact, spec, dimensions, dim_specs)
    return fill_numeric_zero(out)


# ---------------------------------------------------------------- storage


def load_table(
    spark: SparkSession,
    spec: TableSpec,
    source: DataFrame,
    table_root: str,
    batch_ts: _dt.datetime,
    order_cols: Sequence[str] | None = None,
    commit: tuple[str, int] | None = None,
) -> str | None:
    """H8: insert when the table holds no data rows, else upsert; commit a new version.

    For dimensions "holds data" ignores the unknown member (A7). ``commit`` names a stream and its epoch: the
    manifest records it, and an epoch that the table already holds is not applied again.
    """
    version = current_version(spark, table_root)
    epochs = dict(version.epochs) if version else {}
    if commit is not None:
        if epochs.get(commit[0], -1) >= commit[1]:
            return version_path(table_root, version.number)
        epochs[commit[0]] = commit[1]
    key = spec.surrogate_key if spec.kind == "dimension" else None
    current = read_version(spark, version) if version else None
    # files cluster on the unique keys; the leading one is a date key for most facts, the business key for dimensions
    if current is None or not has_rows(current, key, UNKNOWN_KEY):
        new = insert_rows(current, source, spec, batch_ts, order_cols)
        return None if new is None else write_version(new, table_root, spec.unique_keys, epochs=epochs)
    valid = validate_against_spec(source, spec, order_cols)
    if valid is None:
        return None
    rows, keys, supplied = valid
    batch = _batch(rows, keys, supplied)
    hit = files_with_keys(spark, version, batch.select(*keys), keys)
    paths = {f["path"] for f in hit}
    start = _max_key(current, spec) if spec.surrogate_key else 0
    new = _merged(read_files(spark, version.schema, sorted(paths)), batch, keys, supplied, spec, batch_ts, start)
    return write_version(new, table_root, spec.unique_keys, keep=[f for f in version.files if f["path"] not in paths], epochs=epochs)


def empty_table(spark: SparkSession, spec: TableSpec, batch_ts: _dt.datetime) -> DataFrame:
    """H9 (+H6): the table as created: empty, or just the unknown member for dimensions."""
    schema = ", ".join(
        f"`{c}` {(AUDIT_TYPE if c in AUDIT_COLUMNS else spec.type_of(c))}" for c in spec.all_columns + list(AUDIT_COLUMNS)
    )
    base = spark.createDataFrame([], schema)
    if spec.kind == "dimension" and spec.unknown_member:
        base = with_unknown_member(base, spec).withColumns(
            {"created_ts": audit_time(batch_ts), "updated_ts": audit_time(batch_ts)}
        )
    return base


def refresh_tables(
    spark: SparkSession, specs: Mapping[str, TableSpec], warehouse_root: str, batch_ts: _dt.datetime
) -> dict[str, str]:
    """H9: full refresh: every table restarts as a new version holding only its defaults."""
    return {
        name: write_version(empty_table(spark, spec, batch_ts), f"{warehouse_root.rstrip('/')}/{name}")
        for name, spec in specs.items()
    }
