from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import lowered
from textlake.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs: list[tuple], items: list[tuple], top: int) -> list[tuple]:
    """(item_id, rank, doc_id, score) by scoring every document."""
    bags = [(i, Counter(TERM.findall(lowered(t or "")))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(lowered(t or "")))
    found = []
    for item, words in asked.items():
        scores = []
        for doc, b in bags:
            m = 100 - 50 + (50 * sum(b.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * b[w]) // (1000 * b[w] + 20 * m)) for w in words & b.keys())
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top], 1)]
    return found


def cases(seed: int) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["É", "straße", "中文", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: rng.choice([" ", ", ", "_", "\n"]).join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(700)]
    docs += [(i + 700, docs[rng.randrange(40)][1].upper()) for i in range(300)]  # ties
    odd = [(None, docs[3][1]), (None, docs[3][1]), (5, docs[3][1]), (2000, None), (2001, ""), (2002, "... !"), (2003, "w1 " * 30000), (-(2**63), "w7 w8"), (2**63 - 1, "w7 w8")]
    items = [(i, text(rng.randint(1, 30))) for i in range(25)]
    items += [(3, "w300 w301"), (None, "w2 w5"), (None, "w9"), (50, None), (51, ""), (52, "unseen words"), (53, "?!")]
    return docs + odd, items


@pytest.fixture(scope="module")
def tables(spark):
    docs, items = cases(4)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("rank", F.lit(0)).repartition(5)
    return docs, items, df, spark.createDataFrame(items, "item_id long, text string").withColumn("number", F.lit(1)).withColumn("term", F.lit("t"))


@pytest.mark.parametrize("top", [1, 7, 50])
def test_equals_scoring_every_document(tables, top):
    docs, items, df, asked = tables
    rows = ranked_search.ranked(df, asked, top)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in rows.collect()), key=key) == sorted(plain(docs, items, top), key=key)


def test_blocks_of_items_and_many_segments(tables, monkeypatch):
    docs, items, df, asked = tables
    whole = sorted(map(tuple, ranked_search.ranked(df, asked, 9).collect()), key=str)
    monkeypatch.setattr(ranked_search, "TERMS", 150)
    monkeypatch.setattr(ranked_search, "SEGMENT", 300)
    assert ranked_search.item_terms(asked).select("block").distinct().count() > 2
    assert sorted(map(tuple, ranked_search.ranked(df, asked, 9).collect()), key=str) == whole


@pytest.mark.parametrize("most", [1, 10, 22, 43, 44, 150, 296, 297])
def test_blocks_hold_no_more_terms_than_allowed(tables, monkeypatch, most):
    docs, items, df, asked = tables
    monkeypatch.setattr(ranked_search, "TERMS", most)
    rows = ranked_search.item_terms(asked).groupBy("block").agg(F.count("*").alias("n"), F.countDistinct("number").alias("items")).collect()
    assert sum(r["n"] for r in rows) == 297
    assert all(r["n"] <= most or r["items"] == 1 for r in rows)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "w")], "item_id long, text string")
    assert ranked_search.ranked(docs, items).count() == 0
    assert ranked_search.ranked(spark.createDataFrame([(1, "w")], "doc_id long, text string"), items.limit(0)).count() == 0


def packed_segment(lists: list, rng, docs: int, weight: np.ndarray):
    term = np.repeat(np.arange(len(lists), dtype="int32"), [len(x) for x in lists])
    doc = np.concatenate(lists).astype("int32")
    row = {"ids": rng.permutation(docs), "known": np.ones(docs, bool), "sizes": rng.integers(5, 90, docs), "term": term, "doc": doc, "times": rng.integers(1, 40, len(doc)).astype("int32")}
    return ranked_search.Segment({n: ranked_search.packed(v) for n, v in row.items()}, weight, docs, int(row["sizes"].sum()))


def searched(segment, kinds: int) -> int:
    whole = np.zeros(len(segment.ids), "int64")
    np.add.at(whole, segment.doc, segment.part)
    best = ranked_search.Best(20)
    read = segment.search(np.arange(kinds), best)
    order = np.lexsort((segment.ids, -whole))[:20]
    assert best.scores.tolist() == whole[order].tolist() and best.ids.tolist() == segment.ids[order].tolist()
    return read


@pytest.mark.parametrize("seed", range(6))
def test_segment_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    lists = [np.sort(rng.choice(6000, max(1, int(5400 / (k + 1) ** 1.5)), replace=False)) for k in range(12)]
    searched(packed_segment(lists, rng, 6000, rng.integers(1, 9000, 12)), 12)


def test_stretches_below_the_bar_are_not_read():
    rng = np.random.default_rng(1)
    lists = [np.arange(20000), np.arange(9000), np.arange(100, 200)]  # the second makes all the difference
    segment = packed_segment(lists, rng, 20000, np.array([10, 5000, 9000]))
    assert searched(segment, 3) < 20000
