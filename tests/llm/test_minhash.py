from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from textlake.llm import minhash
from textlake.llm.graph import components

SCHEMA = "doc_id long, text string"


def cases() -> list[tuple]:
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.randint(4, 200))]
        for _ in range(14):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy).upper() if rng.random() < 0.2 else "\t".join(copy))
    # a chain: each links with the next one, the ends don't
    chain = [f"c{i}" for i in range(120)]
    for step in range(12):
        docs.append(" ".join(chain[2 * step : 2 * step + 90]))
    docs += [None, "", "  \n", "one", "One", "one two three four", "one two three four five", "é É", "x " * 3000]
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    return list(zip(ids, docs, strict=True))


@pytest.mark.parametrize("block", [1024, 2])
def test_components(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = cases()
    df = spark.createDataFrame(docs, SCHEMA).repartition(4).withColumn("node", F.lit("x")).withColumn("band", F.lit(1))
    found = [tuple(r) for r in minhash.near_duplicates(df, 85).collect()]
    assert sorted(found) == sorted(brute.near(docs))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = brute.near([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(tuple(r) for r in minhash.near_duplicates(docs, 85).collect()) == sorted(expected)


def test_repeated_rows_and_missing_ids(spark):
    same = " ".join(map(str, range(30)))
    docs = [(3, same), (3, same), (None, same), (2, None), (2, None), (None, "a b c d e f"), (5, same + " 30")]
    found = sorted((tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()), key=str)
    assert found == sorted(
        [(3, 26, 3, True), (3, 26, 3, True), (None, 26, 3, False), (2, 0, 2, True), (2, 0, 2, True),
         (None, 2, None, True), (5, 27, 3, False)], key=str,
    )
    df = spark.createDataFrame([(*d, "en") for d in docs], SCHEMA + ", lang string")
    kept = sorted((tuple(r) for r in minhash.drop_near_duplicates(df).collect()), key=str)
    assert kept == sorted([(3, same, "en"), (2, None, "en"), (None, same, "en"), (None, "a b c d e f", "en")], key=str)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    one = np.sort(rng.integers(0, 1 << 63, 2000).astype("uint64"))
    two = np.sort(np.append(one[:1900], rng.integers(0, 1 << 63, 100).astype("uint64")))
    _, sketch = minhash.signatures(np.append(one, two), np.array([0, 2000, 4000]))
    bits = np.bitwise_count(sketch[0] ^ sketch[1])
    differing = int(bits[: minhash.BITS // 64].sum())
    assert bits[minhash.BITS // 64 :].sum() <= 200
    estimate = 1 + minhash.BITS / (4 * minhash.BINS) * np.log(1 - 2 * differing / minhash.BITS)
    assert abs(estimate - 1900 / 2100) < 0.1
    assert differing <= minhash.most_different(minhash.BINS, 85, np.sqrt)


def test_components_of_long_paths(spark):
    rng = random.Random(2)
    names = [f"n{i:03d}" for i in range(300)]
    rng.shuffle(names)
    links = [(names[i], names[i + 1]) for i in range(299) if i % 50 != 49] + [(names[0], names[0])]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    for i in range(0, 300, 50):
        assert {found[n] for n in names[i : i + 50]} == {min(names[i : i + 50])}


def test_no_task_gets_more_than_two_blocks(spark, monkeypatch):
    from pyspark.sql.group import GroupedData

    monkeypatch.setattr(minhash, "BLOCK", 16)
    sides = []
    cogroup = GroupedData.cogroup
    monkeypatch.setattr(GroupedData, "cogroup", lambda one, two: sides.extend([one._df, two._df]) or cogroup(one, two))
    # one bucket: 20 components of 10 classes and 100 classes of their own, all alike by their sketches;
    # sets are equal within ten of 30 classes each
    rows = []
    for i in range(300):
        root = i // 10 if i < 200 else i
        rows.append((0, 7, f"n{i:03d}".encode(), 50, [0] * 24, f"r{root:03d}".encode(), root != 0, i == 0))
    kind = "band tinyint, value bigint, node binary, n bigint, sketch array<bigint>, root binary, outside boolean, first boolean"
    blobs = [(r[2], np.arange(1000 * (i % 10), 1000 * (i % 10) + 50, dtype="uint64").tobytes()) for i, r in enumerate(rows)]
    sets = spark.createDataFrame(blobs, "node binary, shingles binary")

    def across(rows):
        return minhash._across(spark.createDataFrame(rows, kind), 85, lambda nodes: sets.join(nodes, "node", "left_semi"))

    names = {r[2]: (i % 10, r[5]) for i, r in enumerate(rows)}
    links = [(bytes(r["a"]), bytes(r["b"])) for r in across(rows).collect()]
    assert all(names[a][0] == names[b][0] and names[a][1] != names[b][1] for a, b in links)

    def joined(links):
        top = {n: n for n in [*names, *(r for _, r in names.values())]}

        def find(x):
            while top[x] != x:
                x = top[x]
            return x

        for a, b in [*links, *((n, r) for n, (_, r) in names.items())]:
            top[find(a)] = find(b)
        return {frozenset(n for n in names if find(n) == t) for t in map(find, names)}

    every = [(a, b) for a in list(names)[1:] for b in list(names)[1:] if names[a][0] == names[b][0]]
    assert joined(links) == joined(every)
    for side in sides:
        keys = [c for c in side.columns if c not in ("node", "root", "n", "sketch", "shingles")]
        assert side.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 40
    # blocks of one component are not compared with each other
    same = [(*r[:5], b"r", True, r[7]) for r in rows]
    sides.clear()
    assert across(same).count() == 0 and sides[0].count() == 0


def block(rows: list[tuple]) -> pa.Table:
    node, root, sets = zip(*rows, strict=True)
    _, sketch = minhash.signatures(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    return pa.table({
        "node": pa.array(node, pa.binary()), "root": pa.array(root, pa.binary()), "n": pa.array([len(s) for s in sets], pa.int64()),
        "sketch": pa.array(sketch.view("int64").tolist(), pa.list_(pa.int64())), "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
    })


def test_blocks_give_a_forest():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 1 << 63, 200).astype("uint64")
    # copies of one text, each with so many other shingles: linked only if few are changed in both
    rows = []
    for i in range(240):
        kept = rng.permutation(200)[: rng.choice([198, 185, 170])]
        other = rng.integers(0, 1 << 63, 200 - len(kept)).astype("uint64")
        rows.append((f"n{i:03d}".encode(), f"n{i - i % 3:03d}".encode(), np.sort(np.append(text[kept], other))))
    one, two = rows[:120], rows[60:]
    found = list(zip(*minhash.forest(block(one), block(two), 85), strict=True))
    sets, roots = {r[0]: r[2] for r in rows}, {r[0]: r[1] for r in rows}

    def linked(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both)

    assert all(linked(a, b) and roots[a] != roots[b] for a, b in found)

    def tops(links):
        top = dict(roots)
        for a, b in links:
            x, y = top[a], top[b]
            top = {n: y if t == x else t for n, t in top.items()}
        return {frozenset(n for n in top if top[n] == t) for t in top.values()}

    every = [(a[0], b[0]) for a in one for b in two if linked(a[0], b[0])]
    assert tops(found) == tops(every) and len(tops(every)) < 80
    # each link joins two components, so there are fewer than classes
    assert len(found) == len(set(roots.values())) - len(tops(found))
