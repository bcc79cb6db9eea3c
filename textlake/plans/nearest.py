"""Exact k best rows for a set of queries, with the k best kept inside each task.

Each task scores its rows against a block of queries and keeps only the k best per query,
so nothing of size rows x queries is ever emitted or shuffled. A block of queries is
bounded; more queries than one block take one more pass over the rows each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlake.plans.inverted import Lists
from textlake.plans.ranking import running_total
from textlake.plans.staging import stage, stacked

QUERY_BLOCK = 2048  # dense query vectors sent to the tasks at once
SPARSE_QUERY_BLOCK = 256  # sparse queries sent at once …
SPARSE_CELL_BLOCK = 40_000  # … and their terms, give or take one query

Score = Callable[[pd.DataFrame], np.ndarray]


Found = tuple[np.ndarray, np.ndarray, np.ndarray]  # query number, row id, score


def prune(found: Found, k: int) -> Found:
    """The k highest scores per query, ties to the smaller id."""
    query, ids, scores = found
    order = np.lexsort((ids, -scores, query))
    query = query[order]
    first = np.searchsorted(query, query)  # where the query's rows begin
    order = order[np.arange(len(query)) - first < k]
    return tuple(part[order] for part in found)


def candidates(ids: np.ndarray, values: np.ndarray, k: int) -> Found:
    """Cells of a rows x queries array that reach the k-th best of their query; NaN never does."""
    filled = np.where(np.isnan(values), -np.inf, values)
    if len(ids) > k:
        floor = np.partition(filled, len(ids) - k, axis=0)[len(ids) - k]
    else:
        floor = np.full(values.shape[1], -np.inf)
    rows, query = np.nonzero((filled >= floor) & np.isfinite(filled))
    return prune((query, ids[rows], filled[rows, query]), k)


def scan_block(
    rows: DataFrame, id_col: str, names: list[int], score: Score, k: int, excluded: list[list[int]] | None = None
) -> DataFrame:
    """One pass: (query_id, id, score), at most k rows per query and task.

    `score` turns a batch into a rows x queries array; NaN cells are no match.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: Found = (np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0))
        for batch in batches:
            if batch.empty:
                continue
            ids, values = batch[id_col].to_numpy("int64"), score(batch)
            for q, barred in enumerate(excluded or []):
                values[np.isin(ids, barred), q] = np.nan
            new = candidates(ids, values, k)
            kept = prune(tuple(np.concatenate(p) for p in zip(kept, new, strict=True)), k)
        if len(kept[0]):
            yield pd.DataFrame({"query_id": np.asarray(names)[kept[0]], id_col: kept[1], "score": kept[2]})

    return rows.mapInPandas(run, f"query_id bigint, {id_col} bigint, score double")


def keep_best(parts: list[DataFrame], rows: DataFrame, id_col: str, k: int) -> DataFrame:
    if not parts:
        return rows.sparkSession.createDataFrame([], f"query_id bigint, {id_col} bigint, score double, rank int")
    found = stacked(parts)
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def dense_matrix(column: str) -> Callable[[pd.DataFrame], np.ndarray]:
    return lambda batch: np.stack(batch[column].to_numpy()).astype("float64")


def bucket_matrix(column: str, dims: int) -> Callable[[pd.DataFrame], np.ndarray]:
    """Counts per bucket from arrays of bucket numbers."""

    def build(batch: pd.DataFrame) -> np.ndarray:
        lists = batch[column].to_numpy()
        sizes = np.fromiter((len(x) for x in lists), "int64", len(lists))
        flat = np.concatenate(lists).astype("int64") if sizes.sum() else np.empty(0, "int64")
        cells = np.repeat(np.arange(len(lists)), sizes) * dims + flat
        return np.bincount(cells, minlength=len(lists) * dims).reshape(len(lists), dims).astype("float64")

    return build


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    lengths = np.sqrt(np.outer((a * a).sum(axis=1), (b * b).sum(axis=1)))
    return np.divide(a @ b.T, lengths, out=np.zeros(lengths.shape), where=lengths > 0)


def nearest(
    rows: DataFrame,
    id_col: str,
    queries: DataFrame,
    k: int,
    matrix: Callable[[pd.DataFrame], np.ndarray],
    measure: Callable[[np.ndarray, np.ndarray], np.ndarray],
    excluded_col: str | None = None,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, id, score, rank) of the k rows that measure highest against each query.

    `matrix` turns a batch of rows, or of queries, into vectors: both have the same column.
    """
    queries = stage(queries, "queries")
    count = queries.count()
    if count > query_block:
        queries = stage(running_total(queries, ["query_id"], out="_n"), "queries")
        blocks = [queries.where(F.col("_n").between(i + 1, i + query_block)) for i in range(0, count, query_block)]
    else:
        blocks = [queries]
    parts = []
    for block in blocks:
        taken = block.orderBy("query_id").toPandas()  # at most query_block rows
        if taken.empty:
            continue
        vectors = matrix(taken)
        excluded = [list(x) for x in taken[excluded_col]] if excluded_col else None
        parts.append(
            scan_block(
                rows, id_col, taken["query_id"].tolist(), lambda b, v=vectors: measure(matrix(b), v), k, excluded
            )
        )
    return keep_best(parts, rows, id_col, k)


def nearest_sparse(rows: DataFrame, id_col: str, queries: DataFrame, k: int, digits: int = 6) -> DataFrame:
    """k rows with the highest dot product per query; rows without a shared term do not match.

    rows: (id, cells array<struct<term, weight>>); queries: (query_id, term, weight), one
    row per term.
    """
    sizes = queries.groupBy("query_id").agg(F.count("*").alias("_cells"))
    sizes = running_total(stage(sizes, "query-sizes"), ["query_id"], out="_n")
    sizes = running_total(sizes, ["query_id"], F.col("_cells"), out="_upto")
    placed = sizes.select(
        "query_id",
        F.floor((F.col("_n") - 1) / SPARSE_QUERY_BLOCK).alias("_a"),
        F.floor((F.col("_upto") - F.col("_cells")) / SPARSE_CELL_BLOCK).alias("_b"),
    )
    queries = stage(queries.join(placed, "query_id"), "query-terms")
    parts = []
    for block in queries.select("_a", "_b").distinct().orderBy("_a", "_b").collect():
        cells = queries.where((F.col("_a") == block["_a"]) & (F.col("_b") == block["_b"]))
        taken = cells.select("query_id", "term", "weight").orderBy("query_id", "term").toPandas()
        names = sorted(taken["query_id"].unique().tolist())
        terms = {t: i for i, t in enumerate(sorted(taken["term"].unique()))}
        weights = np.zeros((len(terms), len(names)))
        weights[taken["term"].map(terms), taken["query_id"].map({q: i for i, q in enumerate(names)})] = taken["weight"]
        parts.append(_scan_lists(rows, id_col, names, terms, weights, k, digits))
    return keep_best(parts, rows, id_col, k)


def _scan_lists(rows: DataFrame, id_col: str, names: list[int], terms: dict[str, int], weights: np.ndarray, k: int, digits: int) -> DataFrame:
    """One pass: (query_id, id, score), at most k rows per query and task, by inverted lists of each batch."""
    slack = 10.0**-digits
    asked = [(np.flatnonzero(weights[:, q]), weights[weights[:, q] != 0, q]) for q in range(len(names))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(list(terms), pa.string())
        kept: Found = (np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0))
        bars = np.full(len(names), -np.inf)
        for batch in batches:
            cells = batch.column("cells")
            ids = batch.column(id_col).to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.list_value_length(cells), 0).to_numpy()
            flat = cells.flatten()
            which = pc.index_in(flat.field("term"), known)
            hit = which.is_valid().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(ids)), sizes)[hit]
            lists = Lists(row, which.drop_null().to_numpy(), flat.field("weight").to_numpy(zero_copy_only=False)[hit], len(ids), len(terms))
            found = [kept]
            for q, (own, weight) in enumerate(asked):
                near, scores = lists.best(own, weight, k, bars[q], slack)
                if len(near):
                    found.append((np.full(len(near), q), ids[near], np.round(scores, digits)))
            kept = prune(tuple(np.concatenate(p) for p in zip(*found, strict=True)), k)
            ends = np.searchsorted(kept[0], np.arange(len(names)), "right")
            full = np.bincount(kept[0], minlength=len(names)) == k
            bars[full] = kept[2][ends[full] - 1]
        if len(kept[0]):
            yield pa.RecordBatch.from_pydict({"query_id": np.asarray(names)[kept[0]], id_col: kept[1], "score": kept[2]})

    return rows.mapInArrow(run, f"query_id bigint, {id_col} bigint, score double")
