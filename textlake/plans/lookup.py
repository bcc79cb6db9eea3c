"""Key lookups that hold up when a few keys own most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.plans.staging import stacked

MAX_ROWS = 2_000_000  # most rows a broadcast side may have
MAX_BYTES = 64_000_000  # most key bytes a broadcast side may have


def _key_bytes(table: DataFrame, keys: list[str]) -> Column:
    return sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(0))


def _level(weight: str) -> Column:
    """Size class of a weight: the power of two below it."""
    return F.floor(F.log2(F.greatest(F.col(weight), F.lit(1))))


def _hot_level(table: DataFrame, keys: list[str], weight: str, max_rows: int, max_bytes: int) -> int:
    """Lowest size class such that all keys from there on up may be broadcast."""
    levels = (
        table.groupBy(_level(weight).alias("lv"))
        .agg(F.count("*").alias("n"), F.sum(_key_bytes(table, keys)).alias("b"))
        .orderBy(F.desc("lv"))
        .collect()  # at most 64 rows
    )
    rows, size, cut = 0, 0, 64
    for level in levels:
        rows, size = rows + level["n"], size + level["b"]
        if rows > max_rows or size > max_bytes:
            break
        cut = level["lv"]
    return cut


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str | None = None,
    how: str = "left",
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Join rows to a lookup table.

    The whole table is broadcast when its size allows. Beyond that, the keys that the
    weight column says are most frequent are broadcast and never shuffled, and only the
    rows of the remaining keys are shuffled; together both parts cover every row.
    `table` should be a written table, because it is measured first.
    """
    size = table.agg(F.count("*").alias("n"), F.coalesce(F.sum(_key_bytes(table, keys)), F.lit(0)).alias("b")).first()
    values = table.drop(weight) if weight else table
    if size["n"] <= max_rows and size["b"] <= max_bytes:
        return rows.join(F.broadcast(values), keys, how)
    if weight is None:
        return rows.join(values, keys, how)
    is_hot = _level(weight) >= _hot_level(table, keys, weight, max_rows, max_bytes)
    hot = table.where(is_hot).drop(weight)
    cold = table.where(~is_hot).drop(weight)
    near = rows.join(F.broadcast(hot), keys, "inner")
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, how)
    return stacked([near, far])
