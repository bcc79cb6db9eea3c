"""Eight-bit quantization of vectors and its error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Q_MIN, Q_MAX = -128, 127
ZERO_POINT = 0


def _scale(vectors: DataFrame, column: str) -> Column:
    """(largest - smallest value of the whole table) / 255, as a scalar subquery."""
    smallest = F.min(F.array_min(column)).cast("double")
    largest = F.max(F.array_max(column)).cast("double")
    return vectors.agg(((largest - smallest) / F.lit(float(Q_MAX - Q_MIN))).alias("s")).scalar()


def quantize_int8(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Add `scale` and `q` (array<tinyint>); rounding is half to even, results are clipped.

    One narrow pass after the global minimum and maximum; values never leave their row. A
    table whose values are all equal has no scale, and `q` is NULL there.
    """
    scaled = vectors.withColumn("scale", F.nullif(_scale(vectors, column), F.lit(0.0)))
    step = lambda x: F.rint((x.cast("double") - ZERO_POINT) / F.col("scale"))
    clipped = F.transform(column, lambda x: F.greatest(F.least(step(x), F.lit(Q_MAX)), F.lit(Q_MIN)).cast("tinyint"))
    return scaled.withColumn("q", F.when(F.col("scale").isNotNull(), clipped))


def dequantize_error(quantized: DataFrame, column: str = "embedding") -> DataFrame:
    """Add `restored`, `error` (absolute, per value) and `mean_error` (per vector)."""
    restored = F.transform("q", lambda q: (q.cast("double") - ZERO_POINT) * F.col("scale"))
    out = quantized.withColumn("restored", restored)
    out = out.withColumn("error", F.zip_with(column, "restored", lambda x, y: F.abs(x.cast("double") - y)))
    mean = F.aggregate("error", F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size("error"), F.lit(0))
    return out.withColumn("mean_error", mean)


def mean_absolute_error(errors: DataFrame) -> DataFrame:
    total = F.sum(F.aggregate("error", F.lit(0.0), lambda s, x: s + x))
    return errors.agg((total / F.sum(F.size("error"))).alias("mean_absolute_error"))
