"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Vectors are scaled to length one and quantised to int8, x = s * q + e with a known length of
e. For two vectors the product of the codes gives the cosine up to
|e1| + |e2| + |e1| * |e2|, by Cauchy and Schwarz, so pairs below the threshold by more than
that are dropped for certain and only the others are recomputed in double precision.

Equal vectors form one class. Classes are dealt out to groups around pivots; two groups meet
only if the angles to their pivots allow a pair (triangle inequality). Groups are written once.
Round by round all tasks get a block of them, bounded in bytes, and compare it with the groups
that they read, so no vector is copied to the groups that it meets and disk grows with the table
alone. A task works tile by tile and returns counts of links per vector and a spanning forest
of them, never all pairs.

Defined results: vectors that are null, empty or zero, hold null or non-finite components,
or lie so near to zero or infinity that they have no length, link with nothing. Vectors of
different length never link. Equal vectors, repeated rows included, link. A null vec_id counts
as larger than any other. An empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.arrays import mix, spreads
from textlake.llm.graph import components
from textlake.plans.staging import stage, stacked

THRESHOLD = 0.95
GROUP = 4096  # vectors of a group, about
MOST_GROUPS = 1024  # pivots are broadcast
TILE = 1024  # vectors multiplied at once
BLOCK = 32_000_000  # bytes of vectors that all tasks get at once, or one group
MOST_FILES = 256  # of the written groups

_CLASS = "vec_id bigint, class string, unit array<double>"


def unit_vectors(lists: list) -> list[np.ndarray | None]:
    found = []
    for x in lists:
        x = None if x is None else np.asarray([np.nan if v is None else v for v in x] if None in x else x, "float64")
        if x is None or not len(x) or not np.isfinite(x).all():
            found.append(None)
            continue
        top = np.abs(x).max()
        x = x / top if top > 0 else x
        length = np.sqrt((x * x).sum())
        found.append(x / length if length > 0 else None)
    return found


def normalized(vectors: DataFrame) -> DataFrame:
    """(vec_id, class, unit): vectors of length one; class names equal given vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding").to_pylist()
            units = unit_vectors(lists)
            names = []
            for unit in units:
                if unit is None:
                    names.append(None)
                    continue
                bits = (unit + 0.0).view("uint64")
                places = spreads(len(bits), 5)
                one, two = mix(bits ^ places).sum(dtype="uint64"), mix(mix(bits + places)).sum(dtype="uint64")
                names.append(f"{len(bits)}-{int(one):016x}{int(two):016x}")
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(names, pa.string()), pa.array([None if u is None else u.tolist() for u in units], pa.list_(pa.float64()))],
                names=["vec_id", "class", "unit"],
            )

    return vectors.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(run, _CLASS)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scales, lengths of the errors, rounded up) of the rows of x."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype("int8")
    error = x - codes * scale[:, None]
    return codes, scale, np.sqrt((error * error).sum(axis=1)) * (1 + 1e-9) + 1e-12


def possible(a: tuple, b: tuple, threshold: float) -> np.ndarray:
    """Which pairs of quantised rows may reach the threshold.

    One product in float32, of codes with scaled codes, against a bound for each row of a: the largest
    errors of both sides, and what float32 may lose in so many terms.
    """
    near = a[0].astype("float32") @ (b[0].astype("float32") * b[1].astype("float32")[:, None]).T
    one, two = a[2].max(initial=0), b[2].max(initial=0)
    slack = one + two + one * two + (a[0].shape[1] + 8) * 2.0**-23 * (1 + one) * (1 + two)
    least = np.nextafter(((threshold - 1e-12 - slack) / a[1]).astype("float32"), np.float32(-np.inf))
    return near >= least[:, None]


def links_between(x: np.ndarray, y: np.ndarray | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of x, rows of y) that link, tile by tile; without y, each pair of x once."""
    other = x if y is None else y
    a = [(i, quantised(x[i : i + TILE])) for i in range(0, len(x), TILE)]
    b = a if y is None else [(j, quantised(y[j : j + TILE])) for j in range(0, len(y), TILE)]
    for i, qa in a:
        for j, qb in b:
            if y is None and j < i:
                continue
            rows, cols = np.nonzero(possible(qa, qb, threshold))
            if y is None and i == j:
                rows, cols = rows[rows < cols], cols[rows < cols]
            for at in range(0, len(rows), 1 << 17):
                r, c = rows[at : at + (1 << 17)] + i, cols[at : at + (1 << 17)] + j
                hit = np.einsum("ij,ij->i", x[r], other[c]) >= threshold
                yield r[hit], c[hit]


def forest(pairs_a: np.ndarray, pairs_b: np.ndarray, parent: np.ndarray) -> list[int]:
    """Numbers of the pairs that join two trees; parent is changed."""

    def top(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    used = []
    for k, (a, b) in enumerate(zip(pairs_a.tolist(), pairs_b.tolist(), strict=True)):
        a, b = top(a), top(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            used.append(k)
    return used


def _pivots(classes: DataFrame, count: int, length: int) -> np.ndarray:
    """A few of the vectors, by hash of their class; at most MOST_GROUPS."""
    rows = classes.where(F.size("unit") == length).orderBy(F.xxhash64("class"), "class").limit(count).select("unit").collect()
    return np.array([r["unit"] for r in rows])


def _blocks(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """First and last cells of blocks that hold no more than so many vectors, or a single cell; sizes: (cell, n) in order."""
    found, held = [], 0
    for cell, n in sizes:
        if found and held + n <= most:
            found[-1], held = (found[-1][0], cell), held + n
        else:
            found.append((cell, cell))
            held = n
    return found


def _matrix(column: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _linked(classes: DataFrame, count: int, length: int, threshold: float) -> list[DataFrame]:
    """Written (class, other, n): links to n vectors of other classes; other is set for a spanning forest."""
    groups = int(min(MOST_GROUPS, max(1, np.ceil(count / GROUP))))
    spark = classes.sparkSession
    pivots = spark.sparkContext.broadcast(_pivots(classes, groups, length))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["unit"].to_numpy())
            near = np.clip(x @ pivots.value.T, -1, 1)
            group = near.argmax(axis=1)
            yield batch.assign(group=group, angle=np.arccos(near[np.arange(len(x)), group]))

    dealt = stage(
        classes.where(F.size("unit") == length).mapInPandas(deal, "class string, unit array<double>, n bigint, group int, angle double"),
        "vectors",
    )
    sizes = dealt.groupBy("group").agg(F.max("angle").alias("angle"), F.count("*").alias("n")).orderBy("group").collect()
    # a group that holds more than its share is cut into parts, its cells
    parts = [max(1, -(-r["n"] // GROUP)) for r in sizes]
    starts = np.cumsum([0, *parts])
    radius, chosen = np.array([r["angle"] for r in sizes]), [r["group"] for r in sizes]
    angles = np.arccos(np.clip(pivots.value @ pivots.value.T, -1, 1))[np.ix_(chosen, chosen)]
    reach = float(np.arccos(threshold)) + 1e-6
    meets = angles - radius[:, None] - radius <= reach
    np.fill_diagonal(meets, True)
    places = [(g, int(starts[i]), parts[i]) for i, g in enumerate(chosen)]
    table = spark.createDataFrame(places, "group int, start int, parts int")  # at most MOST_GROUPS numbers
    cell = (F.col("start") + F.pmod(F.xxhash64("class"), F.col("parts"))).cast("int")
    placed = dealt.join(F.broadcast(table), "group").select("class", "unit", "n", cell.alias("cell"))
    placed = stage(placed.repartition(int(min(starts[-1], MOST_FILES)), "cell").sortWithinPartitions("cell"), "vector-cells")
    cells = placed.groupBy("cell").agg(F.count("*").alias("n")).orderBy("cell").collect()
    blocks = _blocks([(r["cell"], r["n"]) for r in cells], max(GROUP, BLOCK // (8 * length)))
    group_of = np.repeat(np.arange(len(parts)), parts)  # by cell
    return [_links_with(placed, first, last, length, threshold, group_of, meets) for first, last in blocks]


def _links_with(placed: DataFrame, first: int, last: int, length: int, threshold: float, group_of: np.ndarray, meets: np.ndarray) -> DataFrame:
    """Written links of all vectors with those of the cells from first to last; of two cells, one looks at the other."""
    block = placed.where(F.col("cell").between(first, last)).toArrow()  # BLOCK bytes or a cell
    names, n = block.column("class").to_pylist(), block.column("n").to_numpy()
    shared = placed.sparkSession.sparkContext.broadcast((names, _matrix(block.column("unit"), length), n, block.column("cell").to_numpy()))

    def rows(names: list, others: list, n: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(others, pa.string()), pa.array(n, pa.int64())], names=["class", "other", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, block, n, cells = shared.value
        counts, parent = np.zeros(len(names), "int64"), np.arange(len(names))
        for batch in batches:
            units, times = _matrix(batch.column("unit"), length), batch.column("n").to_numpy()
            own, at = batch.column("class").to_pylist(), batch.column("cell").to_numpy()
            sums, ends = np.zeros(len(own), "int64"), []
            trees = np.concatenate([parent, np.arange(len(names), len(names) + len(own))])
            for c in np.unique(at):
                looks = (cells == c) | (((cells + c) % 2 == 0) == (cells > c)) & meets[group_of[c], group_of[cells]]
                x, y = np.flatnonzero(at == c), np.flatnonzero(looks)
                if not len(y):
                    continue
                for a, b in links_between(units[x], block[y], threshold):
                    a, b = x[a], y[b]
                    once = cells[b] != c
                    once[~once] = [own[i] < names[j] for i, j in zip(a[~once], b[~once], strict=True)]
                    a, b = a[once], b[once]
                    np.add.at(sums, a, n[b])
                    np.add.at(counts, b, times[a])
                    ends += [(own[a[k]], names[b[k]]) for k in forest(a + len(names), b, trees)]
            parent = trees[: len(names)]  # a tree's top is its least number
            hit = np.flatnonzero(sums)
            yield rows([own[i] for i in hit], [None] * len(hit), sums[hit])
            yield rows([a for a, _ in ends], [b for _, b in ends], [0] * len(ends))
        hit = np.flatnonzero(counts)
        yield rows([names[i] for i in hit], [None] * len(hit), counts[hit])

    found = stage(placed.mapInArrow(run, "class string, other string, n bigint"), "vector-links")
    shared.destroy()
    return found


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per vector."""
    rows = stage(normalized(vectors), "units")
    # one of the equal vectors stands for all of them
    sums = rows.where("class is not null").groupBy("class").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.first("unit").alias("unit")
    )
    classes = stage(sums, "vector-classes")
    lengths = classes.groupBy(F.size("unit").alias("length")).agg(F.count("*").alias("n")).orderBy("length").collect()
    none = classes.select("class", F.lit(None).cast("string").alias("other"), F.lit(0).cast("bigint").alias("n")).limit(0)
    found = [none]
    for r in lengths:  # as many as there are lengths of vectors, mostly one
        found += _linked(classes.select("class", "unit", "n"), r["n"], r["length"], threshold)
    found = stage(stacked(found), "vector-links")
    roots = components(found.where("other is not null").select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")))
    counts = found.groupBy("class").agg(F.sum("n").alias("links"))
    known = classes.drop("unit").join(counts, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
    known = stage(
        known.select("class", "first_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "class").alias("root")),
        "vector-classes",
    )
    least = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = known.join(least, "root").select("class", "n_links", "component_id")
    linked = rows.where("class is not null").join(known, "class").select("vec_id", "n_links", "component_id")
    alone = rows.where("class is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
