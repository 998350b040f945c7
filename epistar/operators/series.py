"""Time-series operators: running totals (W1), trailing windows (W2),
previous-week lookup (J9) and week-interval joins (J4).

Skew: a window partitioned only by an entity key sends all of that entity's
rows to one task. The running total here is a distributed prefix scan instead:
rows are placed in ranges of (key, order), each range sums on its own, and what a key
summed up in earlier ranges is added. Ranges follow the data, so a hot key, or a hot day of one,
is spread over as many of them as it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epistar.session import cut_lineage


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def running_total(
    df: DataFrame,
    keys: Sequence[str] | str,
    order_cols: Sequence[str] | str,
    value_cols: Sequence[str] | str,
    bucket: Column | None = None,
    suffix: str = "_cumulative",
) -> DataFrame:
    """Cumulative sum of each value column per key, ordered by ``order_cols``.

    A row whose value is null gets null, and does not break the sum of
    later rows (1, null, 2 -> 1, null, 3). Rows without an order value come after all others; null keys are a key.
    The order should be unique in a key: tied rows are summed in any order.

    Rows are placed by ranges of (key, order) and written once, as another evaluation of a range shuffle need not
    place them alike. With ``bucket``, a monotone function of the order (e.g. the day), nothing is
    written: totals per (key, bucket) are prefix-summed instead, and one (key, bucket) is ordered in one task.
    """
    if bucket is None:
        return _range_scan(df, _as_list(keys), _as_list(order_cols), _as_list(value_cols), suffix)
    keys, order, values = _as_list(keys), _as_list(order_cols), _as_list(value_cols)
    staged = df.withColumn("_bucket", bucket)

    # level 1: per (key, bucket) totals, partially aggregated map-side
    totals = staged.groupBy(*keys, "_bucket").agg(*[F.sum(v).alias(f"_bt_{v}") for v in values])
    # level 2: prefix sums of earlier buckets over the per-key bucket calendar
    by_bucket = Window.partitionBy(*keys).orderBy(F.col("_bucket").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_bucket").alias("_key__bucket"),
        *[F.coalesce(F.sum(f"_bt_{v}").over(by_bucket), F.lit(0)).alias(f"_off_{v}") for v in values],
    )
    # level 3: running sums inside each (key, bucket)
    in_order = [F.col(c).asc_nulls_last() for c in order]
    within = Window.partitionBy(*keys, "_bucket").orderBy(*in_order).rowsBetween(Window.unboundedPreceding, 0)
    staged = staged.withColumns({f"_in_{v}": F.sum(v).over(within) for v in values})
    same_cell = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in [*keys, "_bucket"]]
    joined = staged.join(offsets, on=same_cell, how="left")
    out = joined.withColumns(
        {
            f"{v}{suffix}": F.when(F.col(v).isNotNull(), F.col(f"_off_{v}") + F.col(f"_in_{v}"))
            for v in values
        }
    )
    helpers = [f"_key_{k}" for k in [*keys, "_bucket"]]
    return out.drop("_bucket", *helpers, *[f"_in_{v}" for v in values], *[f"_off_{v}" for v in values])


def _range_scan(df: DataFrame, keys: list[str], order: list[str], values: list[str], suffix: str) -> DataFrame:
    """Running totals by ranges; only a range's first key can have begun in an earlier range."""
    in_order = [F.col(c).asc_nulls_last() for c in order]
    ranged = df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *in_order)
    placed = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))
    totals = placed.groupBy("_range", *keys).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    # a key has one row a range here; rows that carry nothing over are left out, so one a range at most remains
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    if not keys:
        earlier = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_range").alias("_key__range"),
        F.count(F.lit(1)).over(earlier).alias("_before"),
        *[F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_off_{v}") for v in values],
    ).where("_before > 0")
    within = Window.partitionBy("_range", *keys).orderBy(*in_order).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumns({f"_in_{v}": F.sum(v).over(within) for v in values})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    out = summed.join(F.broadcast(carried), [F.col("_range") == F.col("_key__range"), *same], "left")
    totals_of = {f"{v}{suffix}": F.when(F.col(v).isNotNull(), F.coalesce(F.col(f"_off_{v}"), F.lit(0)) + F.col(f"_in_{v}")) for v in values}
    return out.select(*df.columns, *[total.alias(name) for name, total in totals_of.items()])


def previous_period_value(
    df: DataFrame,
    keys: Sequence[str],
    period_col: str,
    value_col: str,
    out_col: str,
    step_days: int = 7,
    default=0,
) -> DataFrame:
    """Value of the same key ``step_days`` earlier, ``default`` when that period is absent.

    Rows must be unique on (keys, period), as they are after a merge. Then
    the previous row of a key (by period) is the period ``step_days``
    earlier exactly when its period says so; otherwise (a gap) the default
    applies, unlike a plain ``lag(1)``. A key's window partition holds one
    row per period, so it is bounded by the calendar, not by the data.
    Keys compare null-safely (nulls form one partition).
    """
    by_key = Window.partitionBy(*keys).orderBy(period_col)
    prev_period = F.lag(F.col(period_col)).over(by_key)
    prev_value = F.lag(F.col(value_col)).over(by_key)
    hit = F.date_add(prev_period, step_days) == F.col(period_col)
    return df.withColumn(out_col, F.when(hit, F.coalesce(prev_value, F.lit(default))).otherwise(F.lit(default)))


def trailing_two_weeks(
    df: DataFrame,
    keys: Sequence[str],
    week_start_col: str,
    week_value_col: str,
    out_col: str,
) -> DataFrame:
    """14-day total = this week's 7-day total + the previous week's (0 if absent)."""
    prev_col = f"_{out_col}_prev"
    out = previous_period_value(df, keys, week_start_col, week_value_col, prev_col, 7, 0)
    return out.withColumn(out_col, F.col(week_value_col) + F.col(prev_col)).drop(prev_col)


def week_interval_join(
    daily: DataFrame,
    weekly: DataFrame,
    keys: Sequence[str],
    date_col: str,
    week_start_col: str,
    how: str = "inner",
) -> DataFrame:
    """Attach to each daily row the weekly row whose Monday..Sunday holds its date.

    ISO weeks run Monday..Sunday, so ``week_start <= date <= week_start + 6``
    equals ``trunc(date, 'week') == week_start``: a plain equi-join.
    ``weekly`` should be unique on (keys, week start).
    """
    w = weekly.withColumnRenamed(week_start_col, "_w_start")
    d = daily.withColumn("_w_start", F.trunc(F.col(date_col), "week"))
    return d.join(w, on=[*keys, "_w_start"], how=how).withColumnRenamed("_w_start", week_start_col)


MAX_LEVEL = 11  # 4^11 days are more than the calendar of the years 1-9999 has


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    point_col: str,
    start_col: str,
    end_col: str,
    bucket_days: int = 1,
    how: str = "inner",
) -> DataFrame:
    """J4, general form: ``key equal and start <= point <= end`` for arbitrary date intervals.

    Buckets come in levels of ``bucket_days`` times 1, 4, 16, ... days. An interval belongs to the first level
    whose buckets are as long as it is, so it covers two buckets at most, whatever its length. A point is
    joined on (keys, level, bucket) once per level in use, which the intervals tell (``MAX_LEVEL`` + 1 numbers at most);
    intervals of about one length, as weeks or months, make one level and no copy of a point. The ``between``
    test then removes false hits, at most eight days for one. Null bounds, and bounds in the wrong order, match nothing.
    ``how`` is ``inner`` or ``left``; clashing column names are left to the caller.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    day = F.unix_date(F.col(start_col).cast("date")), F.unix_date(F.col(end_col).cast("date"))
    length = day[1] - day[0] + 1
    level = sum((F.when(length > bucket_days * 4**k, 1).otherwise(0) for k in range(MAX_LEVEL)), F.lit(0))
    sized = intervals.where(length > 0).withColumn("_level", level.cast("int"))
    levels = sorted(r["_level"] for r in sized.select("_level").distinct().collect())
    width = bucket_days * F.pow(F.lit(4), F.col("_level")).cast("long")
    iv = sized.withColumn("_bucket", F.explode(F.sequence(F.floor(day[0] / width), F.floor(day[1] / width))))
    iv = iv.select(*[F.col(k).alias(f"_iv_{k}") for k in keys], *[c for c in iv.columns if c not in keys])
    same_key = [F.col(k) == F.col(f"_iv_{k}") for k in keys]
    between = F.col(point_col).between(F.col(start_col), F.col(end_col))
    out = [*points.columns, *[c for c in intervals.columns if c not in keys]]
    point_day = F.unix_date(F.col(point_col).cast("date"))

    def bucket(k: int) -> Column:
        return F.floor(point_day / (bucket_days * 4**k))

    if len(levels) == 1 or not levels:
        at = points.withColumn("_point_bucket", bucket(levels[0] if levels else 0))
        return at.join(iv, [*same_key, F.col("_point_bucket") == F.col("_bucket"), between], how).select(*out)
    places = F.array(*[F.struct(F.lit(k).alias("k"), bucket(k).alias("b")) for k in levels])
    at = points.withColumn("_place", F.explode(places))
    hit = [*same_key, F.col("_place.k") == F.col("_level"), F.col("_place.b") == F.col("_bucket"), between]
    matched = at.join(iv, hit, "inner").select(*out)
    if how == "inner":
        return matched
    # a point without a match at any level: one anti join a level, each on points that are not copied
    rest = points
    for k in levels:
        side = iv.where(F.col("_level") == k)
        rest = rest.withColumn("_point_bucket", bucket(k))
        rest = rest.join(side, [*same_key, F.col("_point_bucket") == F.col("_bucket"), between], "left_anti").drop("_point_bucket")
    return matched.unionByName(rest, allowMissingColumns=True)
