"""Best dot products by inverted lists with bounds against all products."""

from __future__ import annotations

import numpy as np
import pytest

from textlake.plans import inverted, nearest


def cells(rng, n_rows: int, n_terms: int) -> np.ndarray:
    dense = rng.random((n_rows, n_terms)) * (rng.random((n_rows, n_terms)) < 0.9 / np.arange(1, n_terms + 1))
    return dense


def lists_of(dense: np.ndarray) -> inverted.Lists:
    rows, terms = np.nonzero(dense)
    return inverted.Lists(rows, terms, dense[rows, terms], *dense.shape)


@pytest.mark.parametrize("seed", range(8))
def test_best_equals_all_products(seed):
    rng = np.random.default_rng(seed)
    dense = cells(rng, 3000, 20)
    lists = lists_of(dense)
    for _ in range(10):
        terms = np.sort(rng.choice(20, rng.integers(1, 6), replace=False))
        weights, k = rng.random(len(terms)), int(rng.integers(1, 30))
        scores = dense[:, terms] @ weights
        wanted = np.sort(scores[scores > 0])[::-1][:k]
        rows, found = lists.best(terms, weights, k, -np.inf, 1e-9)
        assert np.allclose(np.sort(found)[::-1][: len(wanted)], wanted) and np.allclose(scores[rows], found)
        if len(wanted) == k:  # with the bar of an earlier batch, only what reaches it
            rows, found = lists.best(terms, weights, k, wanted[k // 2], 1e-9)
            assert set(np.flatnonzero(scores >= wanted[k // 2])) <= set(rows) and (found >= wanted[k // 2] - 1e-8).all()


def test_blocks_below_the_bar_are_not_read(monkeypatch):
    dense = np.full((64 * 200, 2), 0.01)
    dense[:64, 1] = 0.9
    lists, read, plain = lists_of(dense), [], inverted.spans
    monkeypatch.setattr(inverted, "spans", lambda a, n: read.append(int(n.sum())) or plain(a, n))
    rows, _ = lists.best(np.array([0, 1]), np.array([0.5, 0.5]), 10, -np.inf, 1e-9)
    assert set(rows) == set(range(64)) and sum(read[1:]) <= 2 * 64 * inverted.FIRST  # of 25,600 entries


def test_nearest_sparse(spark):
    rng = np.random.default_rng(3)
    dense, queries = cells(rng, 700, 15), cells(rng, 40, 15)
    data = [(i, [(f"t{j}", float(x)) for j, x in enumerate(row) if x]) for i, row in enumerate(dense)] + [(5000, []), (5001, None)]
    rows = spark.createDataFrame(data, "page_id long, cells array<struct<term:string,weight:double>>").repartition(3)
    asked = [(q, f"t{j}", float(x)) for q, row in enumerate(queries) for j, x in enumerate(row) if x] + [(99, "unseen", 1.0)]
    found = nearest.nearest_sparse(rows, "page_id", spark.createDataFrame(asked, "query_id long, term string, weight double"), 7).collect()
    scores = np.round(queries @ dense.T, 6)
    for q in range(40):
        own = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        order = np.lexsort((np.arange(700), -scores[q]))[:7]
        order = order[(queries[q] @ dense.T)[order] > 0]
        assert [r["page_id"] for r in own] == order.tolist()
        assert np.allclose([r["score"] for r in own], scores[q][order], atol=2e-6)
    assert not [r for r in found if r["query_id"] == 99]
