from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from textlake.llm import weighted_sampling

SCHEMA = "doc_id long, text string"


def edited(docs: list[tuple]) -> dict:
    """doc_id: (text, edited text, next text); ids are distinct, null last."""
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    found = {}
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        found[i] = (t, t[: len(t) - half] + n[:half], n)
    return found


def test_edited_texts_and_likeness(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(80)]
    docs = [(i * 3 - 50, " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))) for i in range(150)]
    docs += [(1000, None), (1001, ""), (None, "null id 𝒳𝒳𝒳𝒳 é"), (1002, "one"), (1003, docs[0][1]), (1004, docs[0][1])]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("key", F.lit("x")).repartition(3)
    rows = weighted_sampling.edited_fingerprints(df, samples=64).collect()
    expected = edited(docs)
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in docs)
    prints = {}
    off_edited, off_next = [], []
    for r in rows:
        text, changed, after = expected[r["doc_id"]]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert prints.setdefault(changed, r["edited_fingerprint"]) == r["edited_fingerprint"]
        off_edited.append(r["near_edited"] - brute.jaccard(text, changed))
        off_next.append(r["near_next"] - brute.jaccard(text, after))
    for off in (off_edited, off_next):
        assert abs(sum(off) / len(off)) < 0.02
        assert max(map(abs, off)) < 0.3


def test_repeated_rows_single_row_and_empty_table(spark):
    rows = weighted_sampling.edited_fingerprints(spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], SCHEMA)).collect()
    assert Counter(r["n_chars"] for r in rows) == {3: 2, 1: 1}
    (row,) = weighted_sampling.edited_fingerprints(spark.createDataFrame([(None, None)], SCHEMA)).collect()
    assert (row["fingerprint"], row["near_next"], row["n_chars"]) == ("", 1.0, 0)
    assert weighted_sampling.edited_fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("range_rows", [100_000, 10])
def test_order_of_many_ranges(spark, monkeypatch, range_rows):
    monkeypatch.setattr(weighted_sampling, "RANGE", range_rows)
    docs = [(i, f"text {i} ends here") for i in range(60)]
    expected = edited(docs)
    for r in weighted_sampling.edited_fingerprints(spark.createDataFrame(docs, SCHEMA)).collect():
        assert r["edited_sha256"] == hashlib.sha256(expected[r["doc_id"]][1].encode()).hexdigest()


def test_least_and_greatest_ids(spark):
    docs = [(-(1 << 63), "the least one of all"), (None, "no id at all here"), ((1 << 63) - 1, "the greatest one"), (0, "zero is between")]
    expected = edited(docs)
    rows = weighted_sampling.edited_fingerprints(spark.createDataFrame(docs, SCHEMA)).collect()
    assert len(rows) == 4
    for r in rows:
        assert r["edited_sha256"] == hashlib.sha256(expected[r["doc_id"]][1].encode()).hexdigest()
