"""The skew-safe building blocks against brute force, on small inputs cut into many parts."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlake.operators import features, nextword, vocab
from textlake.plans.lookup import lookup
from textlake.plans.nearest import cosines, dense_matrix, nearest, nearest_sparse
from textlake.plans.ranking import running_total
from textlake.plans.staging import stage


@pytest.fixture(scope="module")
def numbers(spark):
    pick = random.Random(5)
    data = [("hot" if i % 3 else f"g{i % 7}", i * 7919 % 1000, f"k{i:04d}", pick.randint(0, 9)) for i in range(900)]
    return data, stage(spark.createDataFrame(data, "g string, a int, b string, v int"), "numbers")


@pytest.mark.parametrize("rows_per_range", [10, 200, 10**6])
def test_running_total(numbers, rows_per_range):
    data, table = numbers
    found = running_total(table, ["a", "b"], F.col("v"), out="t", rows_per_range=rows_per_range)
    total, expected = 0, {}
    for _, a, b, v in sorted(data, key=lambda r: (r[1], r[2])):
        total += v
        expected[b] = total
    assert {r.b: r.t for r in found.collect()} == expected


@pytest.mark.parametrize("rows_per_range", [10, 10**6])
def test_rank_inside_a_hot_group(numbers, rows_per_range):
    data, table = numbers
    found = running_total(table, ["a", "b"], group=["g"], out="n", rows_per_range=rows_per_range)
    seen, expected = {}, {}
    for g, _, b, _ in sorted(data, key=lambda r: (r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        expected[b] = seen[g]
    assert {r.b: r.n for r in found.collect()} == expected


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limits", [{}, {"max_rows": 3}, {"max_rows": 0}, {"max_bytes": 9}])
def test_lookup_parts_cover_every_row(spark, how, limits):
    rows = spark.createDataFrame([(i, f"k{min(i, 12) % 11}" if i % 5 else None) for i in range(60)], "i int, key string")
    table = stage(spark.createDataFrame([(f"k{j}", j * 10, 2 ** (10 - j)) for j in range(9)], "key string, val int, n bigint"), "t")
    found = lookup(rows, table, ["key"], weight="n", how=how, **limits)
    plain = rows.join(table.drop("n"), "key", how)
    assert sorted(found.select("i", "val").collect()) == sorted(plain.select("i", "val").collect(), key=lambda r: tuple(r)) if how == "inner" \
        else sorted((r.i, r.val or -1) for r in found.collect()) == sorted((r.i, r.val or -1) for r in plain.collect())


@pytest.mark.parametrize("block", [3, 100])
@pytest.mark.parametrize("parts", [1, 5])
def test_nearest_equals_brute_force(spark, block, parts):
    rng = np.random.default_rng(3)
    points = rng.integers(-2, 3, (80, 4)).astype(float)
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, v array<double>").repartition(parts)
    queries = rows.where("id < 10").select(F.col("id").alias("query_id"), "v", F.array("id").alias("not_these"))
    measure = lambda a, b: np.round(cosines(a, b), 6)
    found = nearest(rows, "id", queries, 4, dense_matrix("v"), measure, "not_these", query_block=block)
    scores = np.round(cosines(points, points[:10]), 6)
    for q in range(10):
        best = sorted((-scores[i, q], i) for i in range(80) if i != q)[:4]
        got = found.where(F.col("query_id") == q).orderBy("rank").collect()
        assert [(-r.score, r.id) for r in got] == best


@pytest.mark.parametrize("cells", [2, 40_000])
def test_sparse_search_equals_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr("textlake.plans.nearest.SPARSE_CELL_BLOCK", cells)
    pick = random.Random(1)
    pages = {i: {f"t{pick.randint(0, 20)}": pick.randint(1, 5) / 4 for _ in range(6)} for i in range(30)}
    asked = {q: {f"t{pick.randint(0, 25)}": pick.randint(1, 5) / 4 for _ in range(4)} for q in range(5)}
    asked[5] = {"unknown": 1.0}
    rows = spark.createDataFrame(
        [(i, [(t, float(w)) for t, w in cells_.items()]) for i, cells_ in pages.items()],
        "page_id bigint, cells array<struct<term:string,weight:double>>",
    )
    queries = spark.createDataFrame(
        [(q, t, float(w)) for q, terms in asked.items() for t, w in terms.items()], "query_id bigint, term string, weight double"
    )
    found = nearest_sparse(rows, "page_id", queries, 3).collect()
    for q, terms in asked.items():
        dots = {i: sum(w * terms.get(t, 0) for t, w in p.items()) for i, p in pages.items()}
        best = sorted((-round(d, 6), i) for i, d in dots.items() if d > 0)[:3]
        assert sorted((-r.score, r.page_id) for r in found if r.query_id == q) == best

ROOT = Path(__file__).resolve().parents[1]


def test_top_p_in_many_ranges_is_the_same(spark):
    text = " ".join(f"aa w{i % 40:02d}" for i in range(300)) + " bb cc bb dd"
    tokens = features.tokenized(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
    pairs = nextword.pair_table(tokens)
    one = sorted(nextword.next_token_top_p(pairs, 0.9).collect())
    assert one == sorted(nextword.next_token_top_p(pairs, 0.9, rows_per_range=5).collect())
    assert len([r for r in one if r.prev == "aa"]) == 36


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_results_do_not_depend_on_partitioning(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(parts)
    weights = features.tfidf(features.tokenized(docs))
    lengths = weights.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("l"))
    assert lengths.where(F.abs(F.col("l") - 1) > 1e-9).count() == 0
    ids = vocab.word_vocab_first_seen(docs).agg(F.sum(F.hash("token", "id").cast("bigint"))).first()[0]
    alone = vocab.word_vocab_first_seen(docs.coalesce(1)).agg(F.sum(F.hash("token", "id").cast("bigint"))).first()[0]
    assert ids == alone


def test_a_query_runs_from_another_folder(tmp_path):
    """Workers import the package though neither path nor folder leads there; staging needs no setting."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", {str(tmp_path / "warehouse")!r}).getOrCreate())
from textlake.catalog import QUERIES
sys.path.remove({str(ROOT)!r})
for name in ("tfidf", "most_similar"):
    print("rows", QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_CONF_DIR")}
    env["SPARK_CONF_DIR"] = str(tmp_path)  # no defaults, so no checkpoint folder
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    counts = [int(line.split()[1]) for line in done.stdout.splitlines() if line.startswith("rows")]
    assert len(counts) == 2 and min(counts) > 0, done.stderr[-2000:]
    assert (tmp_path / "warehouse" / "staged").is_dir()
