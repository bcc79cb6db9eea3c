from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import WORD
from textlake.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def wanted(sizes: dict) -> dict:
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        shares = sum(weight[s] for s in order if s not in full)
        found = {s: 2 * sizes[s] if s in full else rest * weight[s] / shares for s in order}
        new = {s for s in order if s not in full and found[s] > 2 * sizes[s]}
        if not new:
            return found
        full |= new


def cases(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    sources = ["b", "a", "é", "Z", "", None, "z𝒳", "one", "all-empty"]
    docs = []
    for i in range(900):
        s = "b" if rng.random() < 0.4 else rng.choice(sources[:7])
        docs.append((i, None if rng.random() < 0.05 else " ".join(["w"] * int(rng.expovariate(1 / 60))), s))
    docs += [(2000, "w " * 900, "one"), (2001, "", "all-empty"), (2002, None, "all-empty")]
    docs += [docs[0], docs[0], (None, "w w w", "b"), (None, None, None)]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_words_come_near_targets(spark, seed):
    docs = cases(seed)
    df = spark.createDataFrame(docs, SCHEMA).repartition(4).withColumn("size", F.lit("x"))
    rows = mixing.mixed_words(df).collect()
    size = lambda t: len(WORD.findall(t or ""))
    sizes: dict = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += size(t)
    targets, source = wanted(sizes), {}
    for i, _, s in docs:
        source.setdefault(i, s)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, size(t)) for i, t, _ in docs)
    taken: dict = defaultdict(int)
    largest: dict = defaultdict(int)
    for r in rows:
        if r["doc_id"] is None:
            s = "b" if r["size"] else None
        else:
            s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(targets[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 1.01 * largest[s] + 0.001 * target
    again = mixing.mixed_words(df.repartition(7)).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in rows)


def test_rates_solve_the_dual(spark):
    """Within a source the log odds of the rates are proportional to the sizes."""
    rows = mixing.mixed_words(spark.createDataFrame(cases(3), SCHEMA)).collect()
    by_source = defaultdict(list)
    for r in rows:
        if 0 < r["rate"] < 2 and r["size"]:
            by_source[r["source_size"]].append((r["size"], math.log(r["rate"] / (2 - r["rate"]))))
    assert by_source
    for pairs in by_source.values():
        tilts = [odds / size for size, odds in pairs]
        assert max(tilts) - min(tilts) < 1e-5 + 1e-5 * abs(tilts[0])


def test_stage_repeats_rows(spark):
    docs = cases(4)
    df = spark.createDataFrame(docs, SCHEMA).withColumn("lang", F.lit("en"))
    rows = mixing.mix(df)
    assert rows.columns == df.columns
    found = Counter(tuple(r) for r in rows.collect())
    copies = Counter()
    for r in mixing.mixed_words(df).collect():
        copies[r["doc_id"]] += r["copies"]
    by_id = Counter()
    for r, n in found.items():
        by_id[r[0]] += n
    assert by_id == +copies
    assert set(found) <= {(*d, "en") for d in docs}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed_words(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    (row,) = mixing.mixed_words(spark.createDataFrame([(1, None, None)], SCHEMA)).collect()
    assert (row["target"], row["taken"]) == (0.0, 0)
