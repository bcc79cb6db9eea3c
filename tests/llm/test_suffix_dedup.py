from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from textlake.llm import suffix_dedup
from textlake.llm.suffix_dedup import Block, common_prefixes, merge, suffix_array

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"\0\1", bytes(range(256)), b"the rain "])
@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 60, 700])
def test_suffix_array_and_common_prefixes(alphabet, size):
    rng = random.Random(size)
    text = bytes(rng.choice(alphabet) for _ in range(size))
    data = np.frombuffer(text, "uint8")
    order = suffix_array(data)
    expected = sorted(range(size), key=lambda i: text[i:])
    assert order.tolist() == expected

    def shared(a: int, b: int) -> int:
        n = 0
        while n < 50 and max(a, b) + n < size and text[a + n] == text[b + n]:
            n += 1
        return n

    expected = [0, *(shared(a, b) for a, b in zip(expected, expected[1:], strict=False))]
    assert common_prefixes(data, order).tolist() == expected


def test_blocks_are_merged_by_binary_search():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(40)]
    picks = [[rng.choice(strings) for _ in range(30)] for _ in range(4)]
    first: dict[bytes, int] = {}
    blocks = []
    for number, some in enumerate(picks):
        docs = np.array([rng.randrange(1000) for _ in some])
        for s, d in zip(some, docs.tolist(), strict=True):
            for p in range(11):
                first[s[p : p + 50]] = min(first.get(s[p : p + 50], 9999), d)
        blocks.append(Block(np.frombuffer(b"".join(some), "uint8"), np.full(len(some), 60), docs))
    merge(blocks)
    for b, some in zip(blocks, picks, strict=True):
        for k, s in enumerate(some):
            for p in range(11):
                assert b.least[b.place[60 * k + p]] == first[s[p : p + 50]]


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"\0\1", bytes(range(256))])
@pytest.mark.parametrize("share", [0.1, 0.6, 0.95])
def test_common_prefixes_of_some_suffixes(alphabet, share):
    rng = random.Random(3)
    text = bytes(rng.choice(alphabet) for _ in range(200)) * 4
    order = [i for i in sorted(range(len(text)), key=lambda i: text[i:]) if rng.random() < share]

    def shared(a: bytes, b: bytes) -> int:
        return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    expected = [0, *(min(50, shared(text[a:], text[b:])) for a, b in zip(order, order[1:], strict=False))]
    assert common_prefixes(np.frombuffer(text, "uint8"), np.array(order)).tolist() == expected


def test_distinct_strings_with_one_hash_in_common():
    one, two = np.array([5, 5, 5, 2, 5], "uint64"), np.array([1, 9, 1, 1, 9], "uint64")
    number, head, least = suffix_dedup.distinct(one, two, np.array([7, 3, 6, 4, 8]))
    assert [least[n] for n in number] == [6, 3, 6, 4, 3] and len(head) == 3
    assert [(one[head[n]], two[head[n]]) for n in number] == list(zip(one, two, strict=True))


def cases() -> list[tuple]:
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [say(rng.randint(10, 40)) for _ in range(12)]
    docs = [(i, " ".join([say(rng.randint(0, 40)), rng.choice(passages), say(rng.randint(0, 30)), rng.choice(passages)])) for i in range(120)]
    docs += [(200 + i, passages[0] + "é" * rng.randint(0, 60)) for i in range(10)]
    docs += [(300, None), (301, ""), (302, "x" * 49), (303, "x" * 50), (304, "x" * 51), (305, "x" * 400), (306, "ab" * 3000)]
    docs += [(307, docs[0][1]), (307, docs[0][1]), (None, docs[1][1]), (None, docs[1][1]), (309, "y" * 80), (309, "y" * 90)]
    docs += [(-5, passages[3] + say(20_000))]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("crowded", [2000, 3])
def test_blocks_of_a_sorter_hold_whole_names(monkeypatch, crowded):
    """Only the blocks of a name too large for one are merged; no window is in other blocks too."""
    merged, blocks = [], []

    class Recorded(Block):
        def __init__(self, *parts):
            super().__init__(*parts)
            blocks.append(self)

    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 500)
    monkeypatch.setattr(suffix_dedup, "Block", Recorded)
    monkeypatch.setattr(suffix_dedup, "merge", lambda some: (merged.append(some), merge(some)))
    docs = cases()
    tables = [pa.table({"doc_id": pa.array([d for d, _ in x], pa.int64()), "text": pa.array([t for _, t in x], pa.string())}) for x in (docs[:50], docs[50:90], docs[90:])]
    shards = [suffix_dedup.Shard(t) for t in tables]
    asked = [s.questions()[0] for s in shards]
    state, _ = suffix_dedup._answer(0, *(np.concatenate(x) for x in zip(*asked, strict=True)))
    states = np.split(state, np.cumsum([len(k) for k, _ in asked])[:-1])
    strings = [suffix_dedup.Strings(s, x, 2) for s, x in zip(shards, states, strict=True)]
    sent = [r for n, (s, x) in enumerate(zip(shards, strings, strict=True)) for r in suffix_dedup._send(s, x, n)]
    replies = []
    for sorter in (0, 1):
        blocks.clear()
        merged.clear()
        replies.append(suffix_dedup._sorted(pa.Table.from_pylist([r for r in sent if r["sorter"] == sorter], suffix_dedup.SENT)))
        together = [set().union(*(b.heads for b in some)) for some in merged]
        alone = [set(b.heads) for b in blocks if not any(b is x for some in merged for x in some)]
        assert len(alone) > 10 and (crowded == 3 or max(map(len, merged), default=0) > 2)
        assert len(set().union(*alone, *together)) == sum(map(len, [*alone, *together]))
    replies, found = pa.concat_tables(replies), []
    for number, (shard, x, table) in enumerate(zip(shards, strings, tables, strict=True)):
        gone = suffix_dedup._covered(shard, x, replies.filter(pa.array([n == number for n in replies.column("shard").to_pylist()])))
        for doc, a, b in zip(table.column("doc_id").to_pylist(), shard.offsets[:-1], shard.offsets[1:], strict=True):
            spans = np.flatnonzero(np.diff(np.append(0, gone[a:b].astype("int8"))) == 1)
            found.append((doc, b - a, gone[a:b].sum(), len(spans), hashlib.sha256(shard.data[a:b][~gone[a:b]].tobytes()).hexdigest()))
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(found, key=order) == sorted(brute.removed(docs), key=order)


@pytest.mark.parametrize("crowded", [2000, 3])
def test_removed_bytes(spark, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    docs = cases()
    df = spark.createDataFrame(docs, SCHEMA).repartition(5).withColumn("kept", F.lit(1)).withColumn("shard", F.lit("x"))
    found = [tuple(r) for r in suffix_dedup.repeated_digests(df).collect()]
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(found, key=order) == sorted(brute.removed(docs), key=order)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = brute.removed([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(tuple(r) for r in suffix_dedup.repeated_digests(docs).collect()) == sorted(expected)


def test_stage_keeps_columns_and_readable_text(spark):
    docs = [(1, "é" * 60, "en", "a", 60), (2, "z" + "é" * 60 + "end", "fr", None, 64), (3, None, None, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: tuple(r) for r in suffix_dedup.drop_repeated(df).collect()}
    assert found == {1: docs[0], 2: (2, "zend", "fr", None, 4), 3: docs[2]}


def test_empty_table(spark):
    assert suffix_dedup.repeated_digests(spark.createDataFrame([], SCHEMA)).count() == 0
