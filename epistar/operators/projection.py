"""Value-level projections: conditional projection (P8), two-way level label
(P9), value map with fallback (P10) and masked updates (P21).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistar.operators.columns import col_of

@dataclass(frozen=True)
class LevelSplit:
    """One value column, told apart by one level column: ``outputs`` maps a level to its new column."""

    value: str
    level: str
    outputs: Mapping[object, str]


def split_by_level(df: DataFrame, splits: Sequence[LevelSplit]) -> DataFrame:
    """Per split, a column for each level that holds the value on that level's rows and null elsewhere.

    A split whose value or level column the frame lacks adds nothing.
    """
    have = set(df.columns)
    added = {
        name: F.when(F.col(s.level) == F.lit(level), F.col(s.value))
        for s in splits if {s.value, s.level} <= have
        for level, name in s.outputs.items()
    }
    return df.withColumns(added) if added else df


def level_label(region, country, same: str = "country", other: str = "region") -> Column:
    """``country`` where region equals country, else ``region`` (null counts as different)."""
    return F.when(col_of(region) == col_of(country), F.lit(same)).otherwise(F.lit(other))


def map_with_fallback(c, mapping: Mapping[str, str]) -> Column:
    """P10: mapped value, or the original value when the map has no entry."""
    source = col_of(c)
    out = source
    for key, value in reversed(list(mapping.items())):
        out = F.when(source == F.lit(key), F.lit(value)).otherwise(out)
    return out


def replace_values(c, aliases: Mapping[str, str]) -> Column:
    """Swap whole values by an alias map (e.g. a name and its working alias)."""
    return map_with_fallback(c, aliases)

