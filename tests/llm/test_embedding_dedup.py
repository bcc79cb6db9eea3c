from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import roots
from textlake.llm import embedding_dedup
from textlake.llm.embedding_dedup import possible, quantised

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors: list[tuple]) -> list[tuple]:
    """(vec_id, n_links, component_id, kept); ids are distinct."""
    vectors = sorted(vectors)
    units = []
    for _, v in vectors:
        good = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
        v = np.array(v, "float32").astype("float64") if good else None
        units.append(v if v is not None and np.abs(v).max() > 0 else None)
    pairs = []
    for a in range(len(units)):
        for b in range(a):
            x, y = units[a], units[b]
            if x is not None and y is not None and len(x) == len(y):
                if (x @ y) / math.sqrt((x @ x) * (y @ y)) >= 0.95:
                    pairs.append((a, b))
    links, root = [0] * len(vectors), roots(len(vectors), pairs)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    return [(vectors[i][0], links[i], vectors[root[i]][0], root[i] == i) for i in range(len(vectors))]


def cases() -> list[tuple]:
    rng = np.random.default_rng(3)
    centres, found = rng.normal(size=(25, 16)), []
    for c in centres:
        for _ in range(rng.integers(1, 25)):
            found.append((c + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.3])).tolist())
    found += [found[0]] * 30 + [[2 * x for x in found[0]]]
    found += [None, [], [0.0] * 16, [math.nan] + [1.0] * 15, [math.inf] + [1.0] * 15, [None] + [1.0] * 15]
    found += [[1.0, 2.0], [1.0, 2.0], [1.0, 2.1], [1e-30] * 16, [1e30] * 16, [1.0] * 16, [-1.0] * 16]
    ids = list(range(len(found)))
    random.Random(4).shuffle(ids)
    return list(zip(ids, found, strict=True))


@pytest.mark.parametrize(("group", "tile"), [(4096, 1024), (40, 16)])
def test_links_and_components(spark, monkeypatch, group, tile):
    monkeypatch.setattr(embedding_dedup, "GROUP", group)
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    vectors = cases()
    df = spark.createDataFrame(vectors, SCHEMA).repartition(3).withColumn("unit", F.lit("x")).withColumn("label", F.lit(1))
    assert sorted(tuple(r) for r in embedding_dedup.near_vectors(df).collect()) == brute(vectors)


@pytest.mark.parametrize("block", [1, 16 * 8 * 100])
def test_blocks_of_groups_without_copies_of_vectors(spark, monkeypatch, block):
    plans, stage = [], embedding_dedup.stage
    monkeypatch.setattr(embedding_dedup, "GROUP", 40)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block, raising=False)
    monkeypatch.setattr(embedding_dedup, "stage", lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stage(df, label))
    vectors = cases()
    found = embedding_dedup.near_vectors(spark.createDataFrame(vectors, SCHEMA).repartition(3))
    assert sorted(tuple(r) for r in found.collect()) == brute(vectors)
    assert plans and not any("Generate" in plan for plan in plans)  # no vector is multiplied by the groups that it meets


def test_bounds_are_rigorous():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 24))
    x[:100] = x[100:] + rng.normal(size=(100, 24)) * 0.25
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    codes = quantised(x)
    assert not ((x @ x.T >= 0.95) & ~possible(codes, codes, 0.95)).any()
    assert possible(codes, codes, 0.95).mean() < 0.05


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    expected = brute([tuple(r) for r in table.select("vec_id", "embedding").collect()])
    assert sorted(tuple(r) for r in embedding_dedup.near_vectors(table).collect()) == expected


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, None)]
    found = sorted(map(str, (tuple(r) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())))
    assert found == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)]))
    assert embedding_dedup.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
