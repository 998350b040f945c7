"""Schema-adaptive column operators.

Source files of one family carry different columns, so every step first asks
which columns exist. That question is answered at plan time from
``df.columns``; the resulting plan is a single ``select`` per step, which
Catalyst collapses and prunes down to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def present_in(df: DataFrame, wanted: Iterable[str] | None) -> list[str]:
    """The wanted columns that ``df`` has, in the wanted order."""
    have = frozenset(df.columns)
    return [name for name in wanted or () if name in have]


def has_all(df: DataFrame, wanted: Iterable[str]) -> bool:
    """P5: ``df`` has every wanted column, and at least one is wanted."""
    wanted = frozenset(wanted)
    return len(wanted) > 0 and wanted <= frozenset(df.columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map, simultaneously, ignoring absent sources.

    Renames are resolved against the original names, so swaps such as
    ``{country_code: territory_code, geoId: country_code}`` work in any map
    order. When two present sources map to one target, the first non-null
    value (in map order) wins.
    """
    names = df.columns
    present = set(names)
    targets: dict[str, list[str]] = {}
    for src, dst in mapping.items():
        if src in present:
            targets.setdefault(dst, []).append(src)
    renamed_sources = {s for srcs in targets.values() for s in srcs}
    out: list[Column] = []
    emitted: set[str] = set()
    for name in names:
        if name in renamed_sources:
            dst = next(d for d, srcs in targets.items() if name in srcs)
            if dst in emitted:
                continue
            srcs = targets[dst]
            expr = F.col(srcs[0]) if len(srcs) == 1 else F.coalesce(*[F.col(s) for s in srcs])
            out.append(expr.alias(dst))
            emitted.add(dst)
        elif name in targets:
            # an untouched column whose name is taken by a rename target is replaced
            continue
        else:
            if name in emitted:
                continue
            out.append(F.col(name))
            emitted.add(name)
    return df.select(*out)


def replace_in_names(df: DataFrame, old: str, new: str) -> DataFrame:
    """Substring replace over every column name."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


# The two word-boundary patterns of the snake-case rule (a capital
# starting a lower-case word; a lower-case letter or digit before a capital).
_WORD_START = re.compile("(.)([A-Z][a-z]+)")
_CAPITAL_AFTER_LOWER = re.compile("([a-z0-9])([A-Z])")


def camel_to_snake(name: str) -> str:
    """``CamelCase`` / ``camelCase`` -> ``camel_case`` (applied to column names at plan time)."""
    name = _WORD_START.sub(r"\1_\2", name)
    name = _CAPITAL_AFTER_LOWER.sub(r"\1_\2", name)
    return name.lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """P3 over all column names."""
    return df.toDF(*[camel_to_snake(c) for c in df.columns])


def select_existing(df: DataFrame, *groups: Iterable[str] | None) -> DataFrame:
    """Select the listed columns that exist, in list order."""
    cols: list[str] = []
    for group in (present_in(df, wanted) for wanted in groups):
        cols.extend(c for c in group if c not in cols)
    return df.select(*cols)


def drop_existing(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns, ignoring absent ones."""
    present = set(df.columns)
    return df.drop(*[c for c in cols if c in present])


def add_if_missing(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant column only when the frame lacks it."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(value))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Per-column null defaults for columns that exist."""
    names = set(df.columns)
    present = {k: v for k, v in defaults.items() if k in names}
    if not present:
        return df
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in present.items()})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def fill_numeric_zero(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Null -> 0 on numeric columns only (strings keep their nulls)."""
    types = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)}
    cols = [c for c in (subset if subset is not None else df.columns) if c in types]
    if not cols:
        return df
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(types[c])) for c in cols})


def tolerant_number(c, as_type: str = "bigint") -> Column:
    """Text or number to ``as_type``; unparseable text becomes null.

    Whole numbers are read exactly, up to the target's own range. Only other
    text goes through a decimal, then a double, so ``"12.0"``, ``12.7`` and
    ``"1.2e1"`` become 12 for integer targets. What the target cannot hold is
    null.
    """
    text = F.trim(col_of(c).cast("string"))
    as_double = text.try_cast("double")
    if as_type in ("double", "float"):
        return as_double.cast(as_type)
    whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast(as_type))
    cut = F.when(text.rlike(r"^[+-]?[0-9]*\.[0-9]*$"), F.regexp_extract(text, r"^([+-]?[0-9]+)", 1).try_cast(as_type))
    return F.coalesce(whole, cut, F.when(~text.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$"), as_double.try_cast(as_type)))


def coerce_numbers(df: DataFrame, cols: Iterable[str], as_type: str = "bigint") -> DataFrame:
    """P16 over the columns that exist."""
    names = set(df.columns)
    present = [c for c in cols if c in names]
    if not present:
        return df
    return df.withColumns({c: tolerant_number(c, as_type) for c in present})


def cast_existing(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Declared casts for the columns that exist."""
    names = set(df.columns)
    present = {c: t for c, t in types.items() if c in names}
    if not present:
        return df
    return df.withColumns({c: F.col(c).cast(t) for c, t in present.items()})


def lower_case(df: DataFrame, *cols: str) -> DataFrame:
    """P20: lower-case the listed columns that exist."""
    names = set(df.columns)
    present = [c for c in cols if c in names]
    if not present:
        return df
    return df.withColumns({c: F.lower(F.col(c)) for c in present})


def level_by_columns(df: DataFrame, rules: Iterable[tuple[str, str]], name: str = "level") -> DataFrame | None:
    """Label the whole frame by the first rule whose column exists.

    ``rules`` is ``[(column, label), ...]``. Returns ``None`` when no rule
    applies, so the caller can skip the input.
    """
    names = set(df.columns)
    for column, label in rules:
        if column in names:
            return df.withColumn(name, F.lit(label))
    return None
