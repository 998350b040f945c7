"""Surrogate keys (H5), unknown members (H6) and foreign-key resolution
(J6, J7, J8).

Consecutive surrogate keys are assigned without a global single-task sort:
new rows are range-partitioned by business key and numbered inside their
partition (fixed once by a written checkpoint table), each partition counts
its rows, the per-partition counts (one number per partition) are turned
into offsets, and every row's key is ``offset of its partition + position
inside it``. The numbers equal
``max(existing) + row_number() over (order by business key)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistar.operators.sizing import row_count_at_most
from epistar.session import cut_lineage
from epistar.spec import UNKNOWN_KEY, TableSpec

_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def assign_consecutive_keys(
    df: DataFrame,
    order_cols: Sequence[str],
    key_col: str,
    start_after: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """H5: ``key = start_after + rank by order_cols`` (1, 2, 3, ...), distributed.

    ``order_cols`` must be unique per row; ``start_after`` is the largest key
    already in use (0 for a new table).
    """
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    # Without an explicit count AQE sizes the range partitions from the data
    # (a five-row dimension does not get thousands of tasks); coalescing joins
    # neighbouring ranges, so partition order still follows key order.
    ranged = (
        (df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order))
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Partition ids and positions must be the same for the counts and for the
    # keys, so they are fixed once in the shared checkpoint folder: two
    # evaluations of the range shuffle (or a retried task) could otherwise
    # place rows differently.
    ranged = cut_lineage(ranged)
    # one count per range partition (at most n rows, bounded by configuration,
    # not by data) becomes a table of running offsets
    counts = sorted((r["_pid"], r["_cnt"]) for r in ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt")).collect())
    running, rows = 0, []
    for pid, cnt in counts:
        rows.append((pid, running))
        running += cnt
    offsets = df.sparkSession.createDataFrame(rows, "_pid int, _off long")
    keyed = ranged.join(F.broadcast(offsets), "_pid", "left")
    position = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS)
    return keyed.withColumn(key_col, (F.lit(start_after) + F.col("_off") + position + 1).cast("int")).drop("_pid", "_mid", "_off")


def unknown_member_row(spark, spec: TableSpec) -> DataFrame:
    """H6: the ``-1`` row of a dimension, typed like the table."""
    if not spec.unknown_member or not spec.surrogate_key:
        raise ValueError(f"{spec.name} has no unknown member")
    cols = [F.lit(UNKNOWN_KEY).cast("int").alias(spec.surrogate_key)]
    for c in spec.all_columns[1:]:
        cols.append(F.lit(spec.unknown_member.get(c)).cast(spec.type_of(c)).alias(c))
    return spark.range(1).select(*cols)


def with_unknown_member(dim: DataFrame, spec: TableSpec, check: bool = True) -> DataFrame:
    """H6: add the ``-1`` row once (idempotent: an existing ``-1`` row is kept).

    ``check=False`` skips the existence test for freshly keyed rows, whose
    keys start at 1.
    """
    if check and not dim.filter(F.col(spec.surrogate_key) == UNKNOWN_KEY).limit(1).isEmpty():
        return dim
    unknown = unknown_member_row(dim.sparkSession, spec)
    names = set(dim.columns)
    return dim.unionByName(unknown.select(*[c for c in unknown.columns if c in names]), allowMissingColumns=True)


def resolve_foreign_keys(
    fact: DataFrame,
    spec: TableSpec,
    dimensions: Mapping[str, DataFrame],
    dim_specs: Mapping[str, TableSpec],
    max_broadcast_rows: int | None = None,
    bounded_by_construction: frozenset[str] = frozenset({"dim_date"}),
) -> DataFrame:
    """Add every foreign key of ``spec`` to ``fact``.

    * ``dim_date`` plays several roles: the role column is read from the FK
      name (J7).
    * Other dimensions join on their business key; a miss gives ``-1`` (J6).
    * When the fact lacks the business key, the FK is the constant ``-1`` (J8).

    Whether a dimension is broadcast follows from its bytes: the file sizes of a
    written one, or what AQE measures of one that comes out of a shuffle. A
    calendar is bounded by construction (one row per day of the
    years 1-9999 at most, about 3.7 million rows of two columns) and always broadcast.
    With ``max_broadcast_rows`` a caller asks for a broadcast behind a row-count check,
    made once per dimension however many roles it plays.
    """
    out = fact
    small: dict[str, bool] = {}

    def side_of(dim_name: str, frame: DataFrame) -> DataFrame:
        if dim_name not in small:
            small[dim_name] = dim_name in bounded_by_construction or (
                max_broadcast_rows is not None and row_count_at_most(dimensions[dim_name], max_broadcast_rows)
            )
        return F.broadcast(frame) if small[dim_name] else frame

    for fk_col, dim_name in spec.foreign_keys:
        dim_spec = dim_specs[dim_name]
        dim = dimensions[dim_name]
        if dim_name == "dim_date":
            role = spec.date_roles.get(fk_col, "date")
            if role not in out.columns:
                out = out.withColumn(fk_col, F.lit(UNKNOWN_KEY))
                continue
            side = side_of(
                dim_name,
                dim.select(F.col("date").alias(f"_{fk_col}_bk"), F.col(dim_spec.surrogate_key).alias(f"_{fk_col}_v")),
            )
            out = out.join(side, F.col(role).cast("date") == F.col(f"_{fk_col}_bk"), "left")
        else:
            bks = list(dim_spec.unique_keys)
            if not all(b in out.columns for b in bks):
                out = out.withColumn(fk_col, F.lit(UNKNOWN_KEY))
                continue
            side = side_of(
                dim_name,
                dim.select(*[F.col(b).alias(f"_{fk_col}_{b}") for b in bks], F.col(dim_spec.surrogate_key).alias(f"_{fk_col}_v")),
            )
            cond = [F.col(b) == F.col(f"_{fk_col}_{b}") for b in bks]
            out = out.join(side, cond, "left")
        out = out.withColumn(fk_col, F.coalesce(F.col(f"_{fk_col}_v"), F.lit(UNKNOWN_KEY)).cast("int"))
        out = out.drop(*[c for c in out.columns if c.startswith(f"_{fk_col}_")])
    return out
