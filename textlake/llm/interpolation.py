"""Language-model scoring by deleted interpolation.

Word probabilities mix maximum-likelihood estimates of two, one and no words of context,
    P(w | v) = a_b * n(v w) / n(v) + b_b * n(w) / N + c_b / (V + 1),
with weights by bucket of the context's frequency n(v): how often the context was seen decides
how far it is trusted. The weights are learned by expectation-maximisation on counts that were
held out of the estimates: a fold of the training documents is deleted from the counts, and
the mixture is fitted to it. Then all training documents are counted.

A text's first context is a start that no word equals. A context that was never seen gives
its share to the shorter ones.

Defined results: a null or empty text is its end alone. Documents without id are trained on. An
empty training set gives every token the probability one over one. Repeated rows count
each time. Other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.arrays import mix, packed, pieces, spreads, text_bytes, unpacked, words
from textlake.llm.shards import answered, answers_of, ask, packed_shards, summed, totals
from textlake.plans.staging import stage

FOLDS, HELD_OUT = 7, 2  # documents whose crc32 leaves this remainder are never learned from
DELETED = 6  # remainder of the training fold that the weights are fitted to
BUCKETS = 24  # of context frequency, by powers of two; the first is "never"
ROUNDS = 25  # of expectation-maximisation, at most
LEAST = 1e-6  # weight of words of equal chance, in every bucket
END, START = spreads(2, 77)
_PAIR = spreads(2, 78) | np.uint64(1)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, token before it, text): words in order, and one end behind each text."""
    texts = len(offsets) - 1
    hashes, text, _ = words(data, offsets)
    counts = np.bincount(text, minlength=texts)
    ends = np.cumsum(counts)
    token = np.insert(hashes, ends, END)
    before = np.empty_like(token)
    before[1:] = token[:-1]
    last = ends + np.arange(texts)
    before[last - counts] = START
    return token, before, np.repeat(np.arange(texts), counts + 1)


def pair_keys(token: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(token * _PAIR[0] + mix(before * _PAIR[1]))


def remainders(ids: pa.Array) -> np.ndarray:
    """crc32 of each id as text, by folds; -1 without id."""
    return np.array([-1 if i is None else crc32(str(i).encode()) % FOLDS for i in ids.to_pylist()])


class Shard:
    """Distinct tokens and pairs of a shard's documents, and where they occur."""

    def __init__(self, docs: pa.Table) -> None:
        self.ids = docs.column("doc_id").combine_chunks()
        self.rest = remainders(self.ids)
        data, offsets = text_bytes(docs.column("text"))
        parts = []
        for first, last in pieces(offsets):
            token, before, text = tokens(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            parts.append((token, before, text + first))
        token, before, self.text = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.tokens, self.token = np.unique(token, return_inverse=True)
        self.pairs, one, self.pair = np.unique(pair_keys(token, before), return_index=True, return_inverse=True)
        # the context of each pair: the number of its first token, or -1 for the start
        before = before[one]
        place = np.minimum(np.searchsorted(self.tokens, before), len(self.tokens) - 1)
        self.context = np.where(self.tokens[place] == before, place, -1)
        fold = self.rest[self.text]
        self.trained, self.deleted = fold != HELD_OUT, fold == DELETED

    def questions(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Tokens and pairs with their counts, kept and deleted, in one number each."""
        found = []
        for keys, number in ((self.tokens, self.token), (self.pairs, self.pair)):
            kept = np.bincount(number[self.trained & ~self.deleted], minlength=len(keys))
            gone = np.bincount(number[self.deleted], minlength=len(keys))
            found.append((keys, kept.astype("uint64") << np.uint64(32) | gone.astype("uint64")))
        return found


KINDS = ["uint64", "uint64"]
LOW = np.uint64(0xFFFFFFFF)


def halves(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two counts in one number."""
    return (numbers >> np.uint64(32)).astype("int64"), (numbers & LOW).astype("int64")


def _answer(topic: int, keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Kept and deleted counts over all shards; how many keys are in training, and their counts."""
    kept, gone = halves(numbers)
    all_kept, places = totals(keys, kept)
    all_gone, _ = totals(keys, gone)
    distinct = np.unique(keys[all_kept + all_gone > 0]).size
    return all_kept.astype("uint64") << np.uint64(32) | all_gone.astype("uint64"), [distinct, kept.sum(), gone.sum()]


def bucket_of(seen: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency: 0 if it was never seen."""
    return np.minimum(np.frexp(seen.astype("float64"))[1], BUCKETS - 1)


def estimates(shard: Shard, one: np.ndarray, two: np.ndarray, ends: int, total: int) -> tuple[np.ndarray, ...]:
    """(bucket, bigram estimate, unigram estimate) of each pair and of its second token."""
    seen = np.where(shard.context >= 0, one[shard.context], ends)
    second = np.zeros(len(shard.pairs), "int64")
    second[shard.pair] = shard.token
    p2 = np.divide(two, seen, out=np.zeros(len(two)), where=seen > 0)
    return bucket_of(seen), p2, one[second] / max(total, 1)


def learned(shards: DataFrame, replies: DataFrame, distinct: int, kept: int) -> np.ndarray:
    """Mixture weights (bucket, order) by expectation-maximisation on the deleted fold."""

    def events(docs: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(docs)
        one, two = (halves(a)[0] for a in answers_of(answers, KINDS))
        times = np.bincount(shard.pair[shard.deleted], minlength=len(shard.pairs))
        ends = int(one[np.searchsorted(shard.tokens, END)])
        bucket, p2, p1 = estimates(shard, one, two, ends, kept)
        some = np.flatnonzero(times)
        columns = (times[some].astype("<u4"), bucket[some].astype("u1"), p2[some].astype("<f4"), p1[some].astype("<f4"))
        return pa.table({n: pa.array([packed(c)], pa.binary()) for n, c in zip("tbxy", columns, strict=True)})

    held = stage(answered(shards, replies, events, "t binary, b binary, x binary, y binary"), "held-out")
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    p0 = 1 / (distinct + 1)
    for _ in range(ROUNDS):
        now = weights

        def expect(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((BUCKETS, 3))
            for batch in batches:
                for row in range(batch.num_rows):
                    t, b, x, y = (unpacked(batch.column(n)[row].as_buffer(), k) for n, k in (("t", "<u4"), ("b", "u1"), ("x", "<f4"), ("y", "<f4")))
                    shares = now[b] * np.stack([x, y, np.full(len(x), p0)], axis=1)
                    shares *= (t / shares.sum(axis=1))[:, None]
                    for k in range(3):
                        sums[:, k] += np.bincount(b, shares[:, k], BUCKETS)
            yield pa.RecordBatch.from_pydict({"b": list(range(BUCKETS)), "s0": sums[:, 0], "s1": sums[:, 1], "s2": sums[:, 2]})

        parts = held.mapInArrow(expect, "b bigint, s0 double, s1 double, s2 double")
        rows = parts.groupBy("b").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(3)]).collect()  # BUCKETS rows
        new = weights.copy()
        for r in rows:
            sums = np.array([r["s0"], r["s1"], r["s2"]])
            if sums.sum() > 0:
                new[r["b"]] = sums / sums.sum()
        # no weight quite vanishes: any text has a probability, and no bucket comes to 0 / 0
        new[:, 2] = np.maximum(new[:, 2], LEAST)
        weights = np.round(new, 9)
        if np.abs(weights - now).max() < 1e-4:
            break
    return weights / weights.sum(axis=1, keepdims=True)


def scored(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per document."""
    shards = packed_shards(docs.select("doc_id", "text"))
    replies = ask(shards, lambda d: Shard(d).questions(), _answer, KINDS)
    distinct, kept, gone = summed(replies, 0, 3)
    total = kept + gone
    weights = learned(shards, replies, distinct, kept) if total else np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(docs)
        one, two = (sum(halves(a)) for a in answers_of(answers, KINDS))
        ends = int(one[np.searchsorted(shard.tokens, END)])
        bucket, p2, p1 = estimates(shard, one, two, ends, total)
        mixed = np.log10(weights[bucket, 0] * p2 + weights[bucket, 1] * p1 + weights[bucket, 2] / (distinct + 1))
        base = np.log10((one + 1) / (total + 1 * (distinct + 1)))
        n = len(shard.ids)
        count = lambda w=None: np.bincount(shard.text, w, n)
        return pa.table(
            {
                "doc_id": shard.ids.cast(pa.int64()),
                "held_out": pa.array(shard.rest == HELD_OUT),
                "n_tokens": count(),
                "n_known": count((one > 0)[shard.token]).astype("int64"),
                "train_tokens": np.full(n, total),
                "base_score": count(base[shard.token]),
                "score": count(mixed[shard.pair]),
            }
        )

    kinds = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return answered(shards, replies, score, kinds)
