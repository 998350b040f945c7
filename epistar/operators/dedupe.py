"""Keep-first, first-non-null merging, suffix-rule merging and unions
(A1-A7, U1, J5).

Every "first" is defined by explicit order columns: Spark has no row order, so
the caller names the columns that encode file order (``_file``, ``_pos``) or
any other deterministic order. All merges are single ``groupBy`` aggregations
with ``min_by``: Spark combines partial results map-side before the shuffle,
so a key holding a third of all rows still arrives at its reducer as one
partial row per map task, never as a third of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epistar.operators.columns import present_in


def _ordering(order_cols: Sequence[str] | str) -> Column:
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    if not cols:
        raise ValueError("order columns are required for a deterministic first row")
    return F.struct(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])


def keep_first(
    df: DataFrame,
    cols: Sequence[str] | None,
    key: Sequence[str] | None,
    order_cols: Sequence[str] | str | None = None,
) -> DataFrame:
    """A1/A2: project ``cols`` and keep the first row per ``key``.

    Columns missing from ``df`` are ignored. With no (existing) key the
    whole projected row is the key (A2, ``distinct``). Null keys form one
    group. The first row is the one with the smallest ``order_cols``.
    """
    cols, key = present_in(df, cols), present_in(df, key)
    cols = cols or list(df.columns)
    if not key:
        return df.select(*cols).distinct()
    others = [c for c in cols if c not in key]
    if not others:
        return df.select(*key).distinct().select(*[c for c in cols if c in key] or key)
    if order_cols is None:
        raise ValueError("keep_first with a key needs order_cols")
    picked = F.min_by(F.struct(*[F.col(c) for c in others]), _ordering(order_cols)).alias("_first")
    out = df.groupBy(*key).agg(picked)
    return out.select(*[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in cols])


def first_non_null(c: str, order_cols: Sequence[str] | str) -> Column:
    """The value of ``c`` on the first row (by order) where it is not null."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), _ordering(order_cols)))


def merge_first_non_null(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | str) -> DataFrame:
    """A4: one row per key; every other column takes its first non-null value.

    Order columns are carried through as those of the group's first row, so a
    later merge can still order the merged rows.
    """
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    names = df.columns
    first_row = F.min(F.struct(*[F.col(c) for c in order]))
    aggs = []
    for c in names:
        if c in keys:
            continue
        if c in order:
            aggs.append(first_row[c].alias(c))
        else:
            aggs.append(first_non_null(c, order).alias(c))
    return df.groupBy(*keys).agg(*aggs).select(*names)


def _sum_of_group(c: Column, zero: Column) -> Column:
    """Sum; a group of several rows without a value gives 0, a lone row keeps its null."""
    return F.coalesce(F.sum(c), F.when(F.count(F.lit(1)) > 1, zero))


# A merge rule makes the aggregate of a column from the column and a typed zero.
MergeRule = Callable[[Column, Column], Column]
MERGE_RULES: dict[str, MergeRule] = {
    "set": lambda c, zero: F.array_sort(F.collect_set(c)),
    "sum": _sum_of_group,
    "mean": lambda c, zero: F.avg(c),
    "max": lambda c, zero: F.max(c),
    "min": lambda c, zero: F.min(c),
}


def merge_by_suffix(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | str, rules: Mapping[str, MergeRule] = MERGE_RULES
) -> DataFrame:
    """A5: merge rows per key; the part of a column's name after its last ``_`` picks the rule.

    Columns without a rule take their first non-null value by order, the
    order columns those of the first row. ``set`` gives the sorted distinct
    values, so it is meant for columns of few values per key.
    """
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    first_row = F.min(F.struct(*[F.col(c) for c in order]))

    def merged(name: str, kind) -> Column:
        rule = rules.get(name.rpartition("_")[2]) if "_" in name else None
        if rule is not None:
            return rule(F.col(name), F.lit(0).cast(kind) if isinstance(kind, T.NumericType) else F.lit(None))
        return first_row[name] if name in order else first_non_null(name, order)

    fields = {f.name: f.dataType for f in df.schema.fields}
    return df.groupBy(*keys).agg(*[merged(n, t).alias(n) for n, t in fields.items() if n not in keys]).select(*fields)


def long_to_wide(
    df: DataFrame,
    keys: Sequence[str],
    indicator: str,
    value_map: Mapping[str, tuple[object, str]],
    order_cols: Sequence[str] | str,
    carry: Iterable[str] = (),
) -> DataFrame:
    """One row per key, ``new = first non-null source where indicator == value``.

    This is P8 followed by A4 in a single aggregation: no intermediate wide
    row with nulls is ever materialised. ``carry`` columns take their first
    non-null value across all indicators.
    """
    ordering = _ordering(order_cols)
    aggs = []
    for new, (value, source) in value_map.items():
        hit = (F.col(indicator) == F.lit(value)) & F.col(source).isNotNull()
        aggs.append(F.min_by(F.col(source), F.when(hit, ordering)).alias(new))
    names = set(df.columns)
    aggs += [first_non_null(c, order_cols).alias(c) for c in carry if c in names]
    return df.groupBy(*keys).agg(*aggs)


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "dupe_count") -> DataFrame:
    """A3: rows per key, null keys counted as one group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "dupe_count") -> DataFrame:
    """A3+J5: every row with the number of rows of its key (null keys are keys).

    The size table has one row per key, so the join back is skew-safe under AQE (a hot key's partition is
    split on the large side only).
    """
    sizes = group_sizes(df, keys, name).select(*[F.col(k).alias(f"_g_{k}") for k in keys], name)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    return df.join(sizes, same, "inner").select(*df.columns, name)


def split_by_duplicates(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A3+J5: (rows whose key occurs once, rows whose key repeats)."""
    sized = with_group_size(df, keys, "_n")
    return sized.where(F.col("_n") == 1).drop("_n"), sized.where(F.col("_n") > 1).drop("_n")


def has_rows(df: DataFrame, key: str | None = None, unknown_value=-1) -> bool:
    """Does the table hold rows other than the unknown member?

    ``limit(1)`` lets Spark stop after the first qualifying row.
    """
    if key is not None and key in df.columns:
        df = df.filter(F.col(key) != F.lit(unknown_value))
    return not df.limit(1).isEmpty()


def union_all(*frames: DataFrame) -> DataFrame:
    """N-ary union by name; missing columns become null, duplicates kept."""
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def combine(*frames: DataFrame | None, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Frames side by side, matched on the row key ``on``.

    ``inner`` keeps the keys that all frames have, ``left`` those of the first (the others' columns null where
    they have none). Null keys match each other. A key should occur once in each frame; if not, its rows
    multiply as in any join. Other columns that two frames share raise ``ValueError``; ``None`` frames are skipped.
    """
    frames = [f for f in frames if f is not None]
    keys = [on] if isinstance(on, str) else list(on)
    if not frames or not keys:
        raise ValueError("combine needs at least one frame and a row key")
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    out = frames[0]
    for frame in frames[1:]:
        rest = [c for c in frame.columns if c not in keys]
        clash = sorted({c.lower() for c in rest} & {c.lower() for c in out.columns})
        if clash:
            raise ValueError(f"columns in more than one frame: {', '.join(clash)}")
        side = frame.select(*[F.col(k).alias(f"_on_{k}") for k in keys], *rest)
        out = out.join(side, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys], how).drop(*[f"_on_{k}" for k in keys])
    return out
