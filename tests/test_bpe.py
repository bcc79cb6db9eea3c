"""Byte-pair training: chains of pairs against counting anew after each merge, and a public tokenizer."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest

from textlake.operators import bpe
from textlake.operators.bpe import letter, number

SPECIALS = ["<s>", "<pad>", "</s>", "<unk>", "<mask>"]


def apply(word: list[str], a: str, b: str, symbol: str) -> list[str]:
    found, k = [], 0
    while k < len(word):
        if k + 1 < len(word) and (word[k], word[k + 1]) == (a, b):
            found.append(symbol)
            k += 2
        else:
            found.append(word[k])
            k += 1
    return found


def one_by_one(words: dict[str, int], names: list[str], size: int, least: int) -> list[tuple[str, str]]:
    """Training that counts all pairs anew after each merge."""
    known, rows, merges = {s: i for i, s in enumerate(names)}, [(list(w), n) for w, n in words.items()], []
    while len(known) < size:
        counts = Counter()
        for word, n in rows:
            for pair in zip(word, word[1:]):
                counts[pair] += n
        if not counts or max(counts.values()) < least:
            break
        a, b = min(counts, key=lambda p: (-counts[p], known[p[0]], known[p[1]]))
        merges.append((a, b))
        known.setdefault(a + b, len(known))
        rows = [(apply(word, a, b, a + b), n) for word, n in rows]
    return merges


def by_chains(words: dict[str, int], names: list[str], size: int, least: int, k: int) -> list[tuple[str, str]]:
    """The rounds of training without Spark, looking at k pairs each."""
    names, merges = list(names), []
    known = {s: i for i, s in enumerate(names)}
    rows = {"".join(letter(known[c]) for c in w): n for w, n in words.items()}
    while len(names) < size:
        counts = Counter()
        for word, n in rows.items():
            for i in range(len(word) - 1):
                counts[word[i : i + 2]] += n
        top = sorted((-n, p) for p, n in counts.items() if n >= least)[:k]
        if not top:
            break
        chains = Counter()
        for word, n in rows.items():
            for chain in bpe.chains_of(word, {p for _, p in top}):
                chains[chain] += n
        last = (-top[-1][0], top[-1][1]) if len(top) == k else None
        found = bpe.certain_merges(list(chains.items()), last, known, names, size, least)
        assert found
        again = Counter()
        for word, n in rows.items():
            for a, b in found:
                word = apply(list(word), a, b, letter(known[names[number(a)] + names[number(b)]]))
            again["".join(word)] += n
        rows = again
        merges += [(names[number(a)], names[number(b)]) for a, b in found]
    return merges


@pytest.mark.parametrize("seed", range(40))
def test_chains_give_the_merges_of_counting_anew(seed):
    rng = random.Random(seed)
    names = list("abcd"[: rng.randint(1, 4)])
    words = {"".join(rng.choices(names, k=rng.randint(1, 12))): rng.randint(1, 9) for _ in range(rng.randint(1, 40))}
    size, least = len(names) + rng.randint(1, 60), rng.randint(1, 4)
    wanted = one_by_one(words, names, size, least)
    for k in (1, 2, 3, 7, 1000):
        assert by_chains(words, names, size, least, k) == wanted


def test_letters_are_characters_in_order():
    numbers = [0, 5, 0xD6FF, 0xD700, 0xD701, 200_000]
    assert [number(letter(i)) for i in numbers] == numbers
    assert all(letter(i).encode() for i in numbers) and sorted(map(letter, numbers)) == [letter(i) for i in numbers]


@pytest.mark.parametrize("bounds", [{}, {"MAX_CHAINS": 40, "FEW_CHAINS": 10}])
def test_training_equals_a_public_tokenizer(spark, monkeypatch, bounds):
    tokenizers = pytest.importorskip("tokenizers")
    for name, value in bounds.items():
        monkeypatch.setattr(bpe, name, value)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    size = 2800 if not bounds else 290
    public = tokenizers.ByteLevelBPETokenizer()
    texts = [r["text"] for r in docs.select("text").collect()]
    public.train_from_iterator(texts, vocab_size=size, min_frequency=2, special_tokens=SPECIALS, show_progress=False)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in json.loads(public.to_str())["model"]["merges"]]
    assert bpe.bpe_train(bpe.word_counts(docs), size) == merges


@pytest.mark.parametrize("seed", range(20))
def test_words_rewritten_by_chains(seed):
    rng = random.Random(seed)
    names = list("abcd")
    known, rows = {s: i for i, s in enumerate(names)}, Counter()
    for _ in range(40):
        rows["".join(letter(rng.randrange(4)) for _ in range(rng.randint(2, 12)))] += rng.randint(1, 9)
    counts = Counter()
    for word, n in rows.items():
        for i in range(len(word) - 1):
            counts[word[i : i + 2]] += n
    top = sorted((-n, p) for p, n in counts.items())[:5]
    pairs, chains = {p for _, p in top}, Counter()
    for word, n in rows.items():
        for chain in bpe.chains_of(word, pairs):
            chains[chain] += n
    merges = bpe.certain_merges(list(chains.items()), (-top[-1][0], top[-1][1]), known, names, 40, 1)
    joined = {(a, b): letter(known[names[number(a)] + names[number(b)]]) for a, b in merges}
    ranks, done = {pair: i for i, pair in enumerate(merges)}, {}
    for word in rows:
        wanted = list(word)
        for a, b in merges:
            wanted = apply(wanted, a, b, joined[a, b])
        assert bpe.by_chains(word, pairs, ranks, joined, done) == "".join(wanted)
    assert len(done) <= len(chains)


def test_tokens_are_not_shuffled(spark):
    texts = ["the cat and the other cat", "", None, "éè \n\n don't 12 the\x00cat", "the the the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    words = bpe.word_counts(docs)
    vocab, merges = bpe.tokenizer_tables(spark, bpe.bpe_train(words, 300, 1))
    found = bpe.bpe_encode(docs, vocab, merges, words)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan
    table = bpe.word_ids(words, vocab, merges)
    assert sorted(tuple(r) for r in found.collect()) == sorted(tuple(r) for r in bpe._joined(docs, table).collect())
    twice = docs.union(docs.where("doc_id in (0, 2)")).union(spark.createDataFrame([(None, "cat"), (None, "the")], docs.schema))
    found, wanted = bpe.bpe_encode(twice, vocab, merges, words), bpe._joined(twice, table)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_words_without_a_chain(spark):
    words = spark.createDataFrame([("abcab", 2), ("xyz", 1), ("xy", 5)], "spelled string, n bigint").repartition(3, "n")
    assert sorted(tuple(r) for r in bpe.chains(words, {"ab"}).collect()) == [("ab", 4)]
    assert bpe.chains(words, {"qq"}).count() == 0
