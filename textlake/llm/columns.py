"""Columns that a stage carries along without reading them."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame


def carried(docs: DataFrame, read: Collection[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stage's rows of docs, with the columns of docs.

    Columns that the stage doesn't read bear names of their own meanwhile, so none of them
    meets a column that the stage makes.
    """
    given = docs.columns
    inside = [c if c in read else f"carried_{i}" for i, c in enumerate(given)]
    return stage(docs.toDF(*inside)).select(inside).toDF(*given)
