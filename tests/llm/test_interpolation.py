from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from textlake.llm import interpolation

SCHEMA = "doc_id long, text string"


def cases() -> list[tuple]:
    rng = random.Random(9)
    words, docs = [f"W{i}" for i in range(60)], []
    for i in range(300):
        text, w = [], rng.randrange(60)
        for _ in range(rng.randint(0, 80)):
            text.append(words[w])
            w = (w * 7 + 3) % 60 if rng.random() < 0.8 else rng.randrange(60)
        docs.append((i, " ".join(text)))
    return [*docs, (1000, None), (1001, ""), (1002, "unknown words only"), (1003, "w1 " * 4000)]


def model_scores(docs: list[tuple]) -> dict:
    """The same model in plain Python, with its own expectation-maximisation."""
    from collections import Counter

    tokens = {i: [None, *brute.WORD.findall(brute.lowered(t or "")), ""] for i, t in docs}
    bucket = lambda n: min(n.bit_length(), interpolation.BUCKETS - 1)

    def counted(keep):
        one, two = Counter(), Counter()
        for i, ws in tokens.items():
            if keep(brute.fold(i, 7)):
                one.update(ws)
                two.update(zip(ws, ws[1:], strict=False))
        return one, two

    def parts(one, two, a, b, total):
        return bucket(one[a]), (two[a, b] / one[a] if one[a] else 0.0), one[b] / total

    everything, everything2 = counted(lambda f: f != 2)
    distinct = len([w for w in everything if w is not None])
    total = sum(n for w, n in everything.items() if w is not None)
    one, two = counted(lambda f: f not in (2, 6))
    kept = sum(n for w, n in one.items() if w is not None)
    weights = np.full((interpolation.BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    events = [parts(one, two, a, b, kept) for i, ws in tokens.items() if brute.fold(i, 7) == 6 for a, b in zip(ws, ws[1:], strict=False)]
    for _ in range(interpolation.ROUNDS):
        sums = np.zeros_like(weights)
        for b, p2, p1 in events:
            share = weights[b] * np.array([p2, p1, 1 / (distinct + 1)])
            sums[b] += share / share.sum()
        new = weights.copy()
        some = sums.sum(axis=1) > 0
        new[some] = sums[some] / sums[some].sum(axis=1, keepdims=True)
        weights, old = new, weights
        if np.abs(weights - old).max() < 1e-4:
            break
    weights[:, 2] = np.maximum(weights[:, 2], 1e-6)
    weights /= weights.sum(axis=1, keepdims=True)
    found = {}
    for i, ws in tokens.items():
        score = 0.0
        for a, b in zip(ws, ws[1:], strict=False):
            k, p2, p1 = parts(everything, everything2, a, b, total)
            score += math.log10(weights[k] @ [p2, p1, 1 / (distinct + 1)])
        found[i] = score
    return found


def test_scores(spark):
    docs = cases()
    df = spark.createDataFrame(docs, SCHEMA).repartition(5).withColumn("score", F.lit("x"))
    rows = {r["doc_id"]: r for r in interpolation.scored(df).collect()}
    base, model = brute.base_scores(docs), model_scores(docs)
    assert set(rows) == set(base)
    for i, r in rows.items():
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == base[i][:3]
        assert r["held_out"] == (brute.fold(i, 7) == 2)
        assert r["base_score"] == pytest.approx(base[i][3], rel=1e-9)
        assert r["score"] == pytest.approx(model[i], rel=1e-4, abs=1e-3)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_repeated_rows_and_missing_ids(spark):
    docs = [(None, "a b"), (None, "a b"), (4, "c"), (4, "c")]
    rows = interpolation.scored(spark.createDataFrame(docs, SCHEMA)).collect()
    assert sorted((r["doc_id"] is None, r["n_tokens"], r["held_out"]) for r in rows) == [(False, 2, False)] * 2 + [(True, 3, False)] * 2


def test_empty_tables(spark):
    assert interpolation.scored(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(100) if brute.fold(i, 7) == 2)
    (row,) = interpolation.scored(spark.createDataFrame([(held, "nothing is known")], SCHEMA)).collect()
    assert (row["train_tokens"], row["n_known"], row["base_score"], row["score"]) == (0, 0, 0.0, 0.0)
