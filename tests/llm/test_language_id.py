from __future__ import annotations

import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import fold
from textlake.llm import language_id
from textlake.llm.arrays import text_bytes

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SYLLABLES = {"xx": ["ka", "ti", "mo", "lu"], "yy": ["sch", "er", "ung", "te"], "": ["é", "è", "ou", "re"]}


def all_sums(word: bytes, share: dict[bytes, float]) -> float:
    """The probability of a word by listing every segmentation."""
    if not word:
        return 1.0
    return sum(share[word[:n]] * all_sums(word[n:], share) for n in range(1, len(word) + 1) if word[:n] in share)


def all_counts(word: bytes, share: dict[bytes, float]) -> dict[bytes, float]:
    """Expected count of every piece by listing every segmentation."""
    found, total = {}, all_sums(word, share)

    def walk(rest: bytes, chance: float, used: tuple) -> None:
        if not rest:
            for p in used:
                found[p] = found.get(p, 0.0) + chance / total
        for n in range(1, len(rest) + 1):
            if rest[:n] in share:
                walk(rest[n:], chance * share[rest[:n]], (*used, rest[:n]))

    walk(word, 1.0, ())
    return found


def small_model(languages: int = 3):
    vocabulary = sorted({bytes([b]) for b in b" abc"} | {b" a", b"ab", b"bc", b" abc", b"cab", b"abca"})
    rng = np.random.default_rng(3)
    shares = rng.random((len(vocabulary), languages))
    return vocabulary, shares / shares.sum(axis=0)


def test_forward_and_backward_equal_all_segmentations():
    vocabulary, shares = small_model()
    rng = random.Random(5)
    words = [b" " * rng.randint(0, 1) + bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 11))) for _ in range(60)]
    data, offsets = np.frombuffer(b"".join(words), "uint8"), np.cumsum([0, *map(len, words)])
    walker = language_id.Walker(language_id.Trie(vocabulary))
    lattice = walker.lattice(data, offsets)
    sums = language_id.forward(lattice, shares, offsets)[offsets[1:] + np.arange(len(words))]
    for k in range(3):
        share = dict(zip(vocabulary, shares[:, k], strict=True))
        assert np.allclose(sums[:, k], [all_sums(w, share) for w in words], rtol=1e-12)
    language, times = np.arange(len(words)) % 3, np.arange(1.0, len(words) + 1)
    counts, wanted = language_id.expected(lattice, shares, language, times, offsets), np.zeros(shares.shape)
    for w, k, n in zip(words, language, times, strict=True):
        for piece, count in all_counts(w, dict(zip(vocabulary, shares[:, k], strict=True))).items():
            wanted[vocabulary.index(piece), k] += n * count
    assert np.allclose(counts, wanted)


def test_long_runs_are_cut_between_characters():
    text = "é" * 100 + " " + "a" * 70 + "ü" + "b" * 5
    data, offsets = text_bytes(language_id.pa.array([text]))
    starts, ends, opens = language_id.runs(data, offsets)
    words = [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)]
    assert b"".join(words).decode() == text.replace(" ", "") and max(map(len, words)) <= 32
    assert [w.decode() for w in words] and opens.sum() == 2  # every word is whole characters


def cases(count: int) -> list[tuple]:
    rng = random.Random(8)
    docs = []
    for i in range(count):
        lang = rng.choice(list(SYLLABLES))
        words = ("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(2, 40)))
        docs.append((i, " ".join(words).capitalize() + ".", lang))
    return docs


def test_defined_results(spark):
    docs = cases(300)
    odd = [(900, None, "xx"), (901, "", "xx"), (902, "12 — 34!", "yy"), (903, "Schung", None), (None, "kati", "zz"), (904, "ka ti" * 9000, "xx"), (904, "ka ti" * 9000, "xx"), (905, "Ⅻ", "xx"), (906, "中", "xx")]
    df = spark.createDataFrame([*docs, *odd], "doc_id long, text string, lang string").withColumn("Score", F.lit("x")).withColumn("_total", F.lit(1))
    vocabulary = language_id.read_pieces(PATH)
    rows = language_id.predicted(df, PATH).collect()
    assert len(rows) == len(docs) + len(odd)
    known = dict((i, lang) for i, _, lang in docs)
    assert all(r["held_out"] == (r["doc_id"] is not None and fold(r["doc_id"], 3) == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in known]
    assert all(r["lang_pred"] == known[r["doc_id"]] for r in held) and len(held) > 50
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert by[900] == by[901] == by[902] == by[905] == ("und", 0.0)
    assert by[903][0] == "yy" and by[904][0] == "xx" and by[906][0] in SYLLABLES and by[None][0] == "xx"
    models = language_id.train(df, vocabulary)
    full = language_id.detect(df, models, vocabulary)
    assert full.columns == ["doc_id", "text", "lang", "_total", "lang_pred", "score"]
    assert full.where("_total = 1").count() == len(rows)


def test_languages_in_passes(spark, monkeypatch):
    """More languages than are compared at once give the same results."""
    df = spark.createDataFrame(cases(200), "doc_id long, text string, lang string")
    one = language_id.predicted(df, PATH).collect()
    monkeypatch.setattr(language_id, "LANGUAGES", 1)
    two = {r["doc_id"]: r for r in language_id.predicted(df, PATH).collect()}
    for r in one:
        assert r["lang_pred"] == two[r["doc_id"]]["lang_pred"] and math.isclose(r["score"], two[r["doc_id"]]["score"], abs_tol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "some text", None)]])
def test_nothing_to_learn_from(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language_id.predicted(df, PATH).collect()] == [("und", 0.0)] * len(rows)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.predicted(docs, PATH).join(docs, "doc_id").where("held_out and lang is not null").select("lang", "lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
