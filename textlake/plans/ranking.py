"""Ranks and running totals over whole tables, without a one-task window.

The rows are cut into ranges of the ordering key. Totals per range are small, so their
prefix sums are too; inside a range an ordinary window finishes the job. Any split points
give the same result, so they may come from a sample.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 512
SAMPLES_PER_RANGE = 20


def split_points(keys: DataFrame, order: list[str], rows_per_range: int = ROWS_PER_RANGE) -> list:
    """Ordering-key tuples that cut `keys` into ranges of similar row counts."""
    keys = keys.select(*order)
    count = keys.count()
    ranges = min(MAX_RANGES, math.ceil(count / rows_per_range))
    if ranges <= 1:
        return []
    wanted = ranges * SAMPLES_PER_RANGE
    picked = keys.sample(min(1.0, 2.0 * wanted / count), seed=7).limit(4 * wanted)
    picked = picked.orderBy(*order).collect()  # bounded by 4 * MAX_RANGES * SAMPLES_PER_RANGE
    step = max(1, len(picked) // ranges)
    points = []
    for row in picked[step::step]:
        if not points or tuple(row) != points[-1]:
            points.append(tuple(row))
    return points[: ranges - 1]


def range_number(df: DataFrame, order: list[str], points: list) -> Column:
    """Number of the range a row falls in, found by halving."""
    key, types = F.struct(*[F.col(c) for c in order]), dict(df.dtypes)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        values = zip(order, points[mid], strict=True)
        edge = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in values])
        return F.when(key < edge, search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(points))


def running_total(
    df: DataFrame,
    order: list[str],
    value: Column | None = None,
    group: list[str] | None = None,
    out: str = "running",
    points: list | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add the running sum of `value` (default 1, giving the rank) in ascending order.

    `order` must be unique inside a group. With `group`, totals restart per group and a
    group that owns most rows is still cut into many ranges.
    """
    group = group or []
    value = F.lit(1) if value is None else value
    if points is None:
        points = split_points(df, order, rows_per_range)
    df = df.withColumn("_value", value.cast("bigint"))
    if not points:
        # one range only, i.e. at most rows_per_range rows
        window = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
        window = window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum("_value").over(window)).drop("_value")
    df = df.withColumn("_range", range_number(df, order, points))
    inside = (
        Window.partitionBy(*group, "_range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    totals = df.groupBy(*group, "_range").agg(F.sum("_value").alias("_total"))
    if group:
        before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        df = df.join(totals.drop("_total"), [*group, "_range"])
        offset = F.col("_offset")
    else:
        sums = {r["_range"]: r["_total"] for r in totals.collect()}  # one row per range
        offsets, total = [], 0
        for i in range(len(points) + 1):
            offsets.append(total)
            total += sums.get(i, 0)
        offset = F.get(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("_range"))
    df = df.withColumn(out, offset + F.sum("_value").over(inside))
    return df.drop("_value", "_range", "_offset")


def grand_total(df: DataFrame, value: Column) -> int:
    return df.agg(F.coalesce(F.sum(value), F.lit(0)).cast("bigint")).first()[0]
