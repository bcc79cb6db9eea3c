"""Toxicity by multiple-instance learning.

A text is a bag of sentences, and its score is their noisy-or, 1 - prod(1 - p): it is toxic
if any sentence is. -log(1 - p) of a sentence is the softplus of its words' weights and a
constant, less that of the constant alone: a sentence without weighted words adds nothing, and
sentences of a text with the same weighted words are one. So that length is no evidence, the
sentences that are less likely toxic than not count by the likeliest of them, in the fit as in
the score. Only texts carry labels; the weights are learned through the noisy-or and then tell
which sentences offend.

One more instance of a text is its background: a base rate, learned with the weights, which all
words without a weight of their own move a little. Their evidence is a shrunken log ratio of
counts in toxic and in other texts, by buckets of hashed words; a text's distinct buckets
are added up, and the sum moves the base rate's logit by SWAY at most, however long the text.

Words get a weight by the counts of all labelled texts: if they are found in toxic texts so much
more often than chance has it that, of all words chosen so, fewer than CHANCE are expected to be
there by chance. The more labels there are, the rarer a word may be. The weights are fitted on
what is left of all labelled texts, their sentences with such words; equal ones are counted.

Defined results: a text without a word, null and empty ones included, scores 0. A label that is neither
0 nor 1 is ignored; a document with several labels is toxic if one of them says so. Without
labelled rows of both kinds every score is 0. Repeated rows are scored row by row; a null doc_id is never
learned from and never held out. Columns named like the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.arrays import BYTES, LOWER, ODD_A, ODD_B, cut, mix, pieces, range_hashes, text_bytes
from textlake.llm.columns import carried
from textlake.llm.memory import freed
from textlake.plans.ranking import running_total
from textlake.plans.staging import stage

SAMPLE_BYTES = 32_000_000  # most bytes of weighted words, 4 each, that the model is fitted on
RANGE = 5_000  # texts put in order at once to choose them
CHANCE = 0.5  # share of the weighted words that may be there by chance
FINE, MOST = 16, 100  # evidence is told apart in so many parts of one, up to so much
EMPTY = -7.0  # logit of a sentence without weighted words
STEPS, RATE = 400, 0.1
BUCKETS = 1 << 18  # of hashed words, whose counts are the background's evidence
SHRINK = 1.0  # texts of the average kind that are added to a bucket's
SWAY = 1.5  # most that the background's words move the logit of the base rate
SPARSE = 0.3  # cost of a word's own -log(1 - p), in texts: words in the wake of others get none
REJECT = 0.7  # a text that scores as much is toxic
OFFENDING = 0.5  # a sentence that scores as much is reported; of the others one counts

_IS_WORD = (BYTES >= 128) | ((BYTES >= 48) & (BYTES <= 57)) | ((BYTES >= 65) & (BYTES <= 90)) | ((BYTES >= 97) & (BYTES <= 122))
_IS_END = np.isin(BYTES, [10, 13, 33, 46, 63])  # line ends and ! . ?


@dataclass
class Bag:
    """Sentences of some texts: where they lie, and the hashes of their words."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # text of each sentence
    sentence: np.ndarray  # sentence of each word
    word: np.ndarray  # hash of each word


def bag(data: np.ndarray, offsets: np.ndarray) -> Bag:
    starts, ends = cut(~_IS_END[data], offsets)
    first, last = cut(_IS_WORD[data], offsets)
    sentence = np.searchsorted(starts, first, "right") - 1
    return Bag(starts, ends, np.searchsorted(offsets, starts, "right") - 1, sentence, range_hashes(LOWER[data], first, last))


def found(words: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in sought that are among the sorted words, and which they are)."""
    if not len(words):
        return np.empty(0, "int64"), np.empty(0, "int64")
    at = np.minimum(np.searchsorted(words, sought), len(words) - 1)
    known = np.flatnonzero(words[at] == sought)
    return known, at[known]


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def counting(hazard: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which sentences count: all that offend, and of each text's others the likeliest.

    text is ascending; of equal ones the first counts.
    """
    counts = -np.expm1(-hazard) >= OFFENDING
    weak = np.flatnonzero(~counts)
    if len(weak):
        begins = np.flatnonzero(np.diff(text[weak], prepend=-1))
        most = np.repeat(np.maximum.reduceat(hazard[weak], begins), np.diff(np.append(begins, len(weak))))
        top = np.flatnonzero(hazard[weak] == most)
        counts[weak[top[np.diff(text[weak[top]], prepend=-1) > 0]]] = True
    return counts


@dataclass
class Model:
    words: np.ndarray  # hashes, in order
    weights: np.ndarray
    bias: float = EMPTY
    base: float = -50.0  # logit of the base rate
    background: np.ndarray | None = None  # evidence of each bucket of words

    def sentence_logits(self, b: Bag) -> np.ndarray:
        known, which = found(self.words, b.word)
        return self.bias + np.bincount(b.sentence[known], self.weights[which], len(b.starts))

    def hazards(self, b: Bag) -> tuple[np.ndarray, np.ndarray]:
        """(-log(1 - p) of each sentence, the sentences that count for their texts)."""
        known, which = found(self.words, b.word)
        z = self.bias + np.bincount(b.sentence[known], self.weights[which], len(b.starts))
        hazard, once = softplus(z) - softplus(self.bias), distinct(b.sentence[known], which, b.text)
        return hazard, once[counting(hazard[once], b.text[once])]

    def ground(self, b: Bag, texts: int) -> np.ndarray:
        """-log(1 - p) of each text's background."""
        text, bucket = buckets(b)
        if self.background is None or not len(text):
            return np.zeros(texts)
        moved = np.bincount(text, self.background[bucket], texts)
        some = np.bincount(text, minlength=texts) > 0
        return np.where(some, softplus(self.base + SWAY * moved / (1 + np.abs(moved))), 0.0)

    def scores(self, b: Bag, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """(score of each text, p of each sentence)."""
        hazard, once = self.hazards(b)
        total = np.bincount(b.text[once], hazard[once], texts) + self.ground(b, texts)
        return -np.expm1(-total), -np.expm1(-hazard)


NOTHING = Model(np.empty(0, "uint64"), np.empty(0), -50.0)


def buckets(b: Bag) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each text's distinct buckets of words."""
    bucket = (b.word >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype("int64")
    pair = np.unique(b.text[b.sentence].astype("int64") * BUCKETS + bucket)
    return pair // BUCKETS, pair % BUCKETS


def distinct(sentence: np.ndarray, word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Of each text's sentences with the same words, the first; those without words are left out.

    sentence and word list the words of the sentences in order, text has the sentences' texts.
    """
    if not len(sentence):
        return np.empty(0, "int64")
    begins = np.flatnonzero(np.diff(sentence, prepend=-1))
    content = np.add.reduceat(mix(word.astype("uint64") * ODD_A + ODD_B), begins)
    at = sentence[begins]
    _, first = np.unique(np.stack([text[at].astype("uint64"), content]), axis=1, return_index=True)
    return np.sort(at[first])


def counts(b: Bag, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, texts that have them, toxic ones among these)."""
    words, which = np.unique(b.word, return_inverse=True)
    pair = np.unique(b.text[b.sentence].astype("int64") * max(len(words), 1) + which)
    text, which = pair // max(len(words), 1), pair % max(len(words), 1)
    return words, np.bincount(which, minlength=len(words)), np.bincount(which, toxic[text], len(words)).astype("int64")


def least_evidence(own: list[tuple[int, int]], most: list[tuple[int, int]]) -> float | None:
    """Evidence from which words count; (bin, words) by evidence, and by the most that it could be.

    Evidence is -log of the chance that a word is in as many toxic texts (Chernoff's bound). Words
    that cannot reach it, being in too few texts, add nothing to what chance alone would choose.
    """
    seen, able = np.zeros(FINE * MOST + 2), np.zeros(FINE * MOST + 2)
    for total, bins in ((seen, own), (able, most)):
        for at, n in bins:
            total[at] += n
    seen, able = seen[::-1].cumsum()[::-1], able[::-1].cumsum()[::-1]
    by_chance = able * np.exp(-np.arange(len(able)) / FINE)
    enough = np.flatnonzero((seen > 0) & (by_chance <= CHANCE * seen))
    return enough[0] / FINE if len(enough) else None


def starting(has: np.ndarray, bad: np.ndarray, rate: float) -> np.ndarray:
    """Weights that words have by their counts alone."""
    hazard = np.maximum(-np.log1p(-(bad + rate) / (has + 1)) + np.log1p(-rate), 0)
    return np.log(np.expm1(hazard + softplus(EMPTY))) - EMPTY


def fit(b: Bag, labels: np.ndarray, rows: np.ndarray | None = None, start: np.ndarray | None = None, steps: int = STEPS) -> Model:
    """Weights of all words that make the noisy-or of the sentences agree with the texts' labels.

    rows: how often each text is there. start: weights to begin with, of the words in order.
    """
    texts = len(labels)
    if texts == 0 or not len(b.word) or not labels.any():
        return NOTHING
    words, which = np.unique(b.word, return_inverse=True)
    own = distinct(b.sentence, which, b.text)
    kept = np.isin(b.sentence, own)
    sentence, feature, text = np.searchsorted(own, b.sentence[kept]), which[kept], b.text[own]
    size, count = len(words), len(own)
    rows = np.ones(texts) if rows is None else rows
    toxic = labels == 1
    rate = np.clip(rows[toxic].sum() / rows.sum(), 1e-3, 0.5)
    w = np.append(np.zeros(size) if start is None else start, np.log(rate))  # the last one is the base rate's
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    # the rarer class counts more, by the root of the classes' ratio
    weight = rows * np.where(toxic, np.sqrt(rows[~toxic].sum() / max(rows[toxic].sum(), 1)), 1.0)
    for step in range(1, steps + 1):
        z = EMPTY + np.bincount(sentence, w[feature], count)
        # -log of "no sentence is toxic, nor the text without one"
        hazard = softplus(z) - softplus(EMPTY)
        counts = counting(hazard, text)
        total = softplus(w[-1]) + np.bincount(text, hazard * counts, texts)
        slope = np.where(toxic, -1.0 / np.expm1(np.clip(total, 1e-9, 500)), 1.0) * weight
        by_sentence = slope[text] * sigmoid(z) * counts
        g = np.append(np.bincount(feature, by_sentence[sentence], size) + SPARSE * sigmoid(EMPTY + w[:-1]), slope.sum() * sigmoid(w[-1]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        np.maximum(w[:-1], 0, out=w[:-1])  # no word makes up for an offending one
    return Model(words, w[:-1], base=float(w[-1]))


def _fold(folds: int):
    return F.crc32(F.col("doc_id").cast("string")) % folds


def _bags(batch: pa.RecordBatch) -> Iterator[tuple[Bag, int, int]]:
    """The batch's texts in pieces: (sentences, first row, last row + 1)."""
    data, offsets = text_bytes(batch.column("text"))
    for first, last in pieces(offsets):
        begin = offsets[first]
        yield bag(data[begin : offsets[last]], offsets[first : last + 1] - begin), first, last


def _counts(texts: DataFrame) -> DataFrame:
    """(word, has, bad): texts and toxic texts by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_numpy()
            for b, first, last in _bags(batch):
                words, has, bad = counts(b, labels[first:last])
                yield pa.RecordBatch.from_arrays([pa.array(words.view("int64")), pa.array(has), pa.array(bad)], names=["word", "has", "bad"])

    parts = texts.mapInArrow(freed(run), "word bigint, has bigint, bad bigint")
    return parts.groupBy("word").agg(F.sum("has").alias("has"), F.sum("bad").alias("bad"))


def ratios(has: np.ndarray, bad: np.ndarray, rate: float) -> np.ndarray:
    """Evidence of words, or buckets of them, by the toxic texts among those that have them."""
    return np.log((bad + SHRINK * rate) / (has - bad + SHRINK * (1 - rate))) - np.log(rate / (1 - rate))


def _telling(texts: DataFrame, n: int, toxic: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words that get a weight, in order; weights by their counts alone; the background's evidence)."""
    rate = toxic / n
    share = F.col("bad") / F.col("has")
    rest = F.when(share < 1, (1 - share) * F.ln((1 - share) / (1 - rate))).otherwise(0.0)
    evidence = F.when(share > rate, F.col("has") * (share * F.ln(share / rate) + rest)).otherwise(0.0)
    counted = stage(_counts(texts).withColumn("evidence", evidence), "word-counts")
    fine = lambda x: F.least(F.floor(x * FINE + 1e-6), F.lit(FINE * MOST + 1)).cast("int")
    own, most = fine(F.col("evidence")), fine(F.col("has") * float(np.log(1 / rate)))
    bins = [counted.groupBy(x.alias("bin")).count().collect() for x in (own, most)]  # MOST * FINE + 2 rows each at most
    enough = least_evidence(*bins)
    bar = FINE * MOST + 2 if enough is None else int(enough * FINE)
    rest = counted.where(own < bar).groupBy(F.shiftrightunsigned("word", 64 - BUCKETS.bit_length() + 1).alias("bucket"))
    rest = rest.agg(F.sum("has").alias("has"), F.sum("bad").alias("bad")).toArrow()  # BUCKETS rows at most
    bucket, has, bad = (rest.column(c).to_numpy() for c in ("bucket", "has", "bad"))
    background = np.zeros(BUCKETS)
    background[bucket] = ratios(has, bad, rate)
    chosen = counted.where(own >= bar).select("word", "has", "bad").toArrow()
    words, has, bad = (chosen.column(c).to_numpy() for c in ("word", "has", "bad"))
    order = np.argsort(words.view("uint64"))
    return words.view("uint64")[order], starting(has[order], bad[order], rate), background


def _sentences(texts: DataFrame, words: np.ndarray) -> DataFrame:
    """(label, said, rows): the weighted words of each text's sentences, by number, -1 behind each sentence."""
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            for b, first, last in _bags(batch):
                known, which = found(words, b.word)
                sentence = b.sentence[known]
                kept = np.isin(sentence, distinct(sentence, which, b.text))
                sentence, which = sentence[kept], which[kept]
                begins = np.flatnonzero(np.diff(sentence, prepend=-1))
                said = np.insert(which, np.append(begins[1:], len(which))[: len(begins)], -1).astype("<i4")
                size = np.bincount(b.text[sentence], minlength=last - first) + np.bincount(b.text[sentence[begins]], minlength=last - first)
                ends = np.append(0, np.cumsum(size))
                blobs = [said[ends[i] : ends[i + 1]].tobytes() for i in range(last - first)]
                yield pa.RecordBatch.from_arrays([batch.column("label").slice(first, last - first), pa.array(blobs, pa.binary())], names=["label", "said"])

    return texts.mapInArrow(freed(run), "label bigint, said binary").groupBy("label", "said").agg(F.count("*").alias("rows"))


def bounded(said: DataFrame) -> DataFrame:
    """Rows of SAMPLE_BYTES together at most, in the order of hashes; what doesn't fit is left out, not what follows."""
    size = F.length("said").cast("bigint")
    if (said.agg(F.sum(size)).first()[0] or 0) <= SAMPLE_BYTES:
        return said
    some = said.where(size <= SAMPLE_BYTES // 16).withColumn("_order", F.xxhash64("said"))
    return running_total(some, ["_order", "label", "said"], size, out="_upto", rows_per_range=RANGE).where(F.col("_upto") <= SAMPLE_BYTES).select(said.columns)


def train(docs: DataFrame, labels: DataFrame, held_out: int = 1, folds: int = 3) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    learned = F.col("doc_id").isNotNull() & (_fold(folds) != held_out)
    known = labels.where(F.col("toxic").isin(0, 1) & learned).groupBy("doc_id").agg(F.max("toxic").cast("bigint").alias("label"))
    # texts are shuffled alike at every size
    texts = docs.where(learned).select("doc_id", "text").join(known.hint("merge"), "doc_id")
    texts = stage(texts.select("label", "text"), "labelled")
    n, toxic = texts.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < toxic < n:
        return NOTHING
    words, start, background = _telling(texts, n, toxic)
    if not len(words):
        return Model(words, start, base=float(np.log(toxic / n)), background=background)
    said = bounded(stage(_sentences(texts, words), "sentences"))
    shared = texts.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("label").to_numpy(), b.column("rows").to_numpy(), text_bytes(b.column("said"))) for b in batches]
        if not parts:
            return
        all_ = np.concatenate([data.view("uint8") for *_, (data, _) in parts]).view("<i4")
        size = np.concatenate([np.diff(offsets) // 4 for *_, (_, offsets) in parts])
        text, end = np.repeat(np.arange(len(size)), size), all_ < 0
        sentence = (np.cumsum(end) - end)[~end]
        nowhere = np.empty(0, "int64")
        start, own = shared.value, np.unique(all_[~end])
        b = Bag(nowhere, nowhere, text[end], sentence, all_[~end])
        model = fit(b, np.concatenate([x for x, *_ in parts]), np.concatenate([x for _, x, _ in parts]).astype("float64"), start[own])
        weights = start.copy()  # words that no text of the sample has keep theirs
        if len(model.words):
            weights[model.words] = model.weights
        base = model.base if len(model.words) else float(np.log(toxic / n))
        yield pa.RecordBatch.from_pydict({"weights": [weights.astype("<f4").tobytes()], "base": [base]})

    one = said.repartition(1).sortWithinPartitions("said", "label")  # SAMPLE_BYTES at most
    blob, base = one.mapInArrow(freed(run), "weights binary, base double").first()
    weights = np.frombuffer(blob, "<f4").astype("float64")
    return Model(words[weights > 0], weights[weights > 0], base=base, background=background)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score, and offending: byte ranges and scores of its toxic sentences."""
    docs = docs.drop("score", "offending")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 16 bytes a weighted word, 8 a bucket
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in pieces(offsets):
                begin = offsets[first]
                b = bag(data[begin : offsets[last]], offsets[first : last + 1] - begin)
                scores, p = own.scores(b, last - first)
                spans: list[list[dict]] = [[] for _ in range(last - first)]
                for i in np.flatnonzero(p >= OFFENDING):
                    t = b.text[i]
                    zero = offsets[first + t] - begin
                    spans[t].append({"begin": b.starts[i] - zero, "end": b.ends[i] - zero, "score": p[i]})
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores), pa.array(spans, span)],
                    names=[*part.schema.names, "score", "offending"],
                )

    kind = "score double, offending array<struct<begin: bigint, end: bigint, score: double>>"
    return docs.mapInArrow(freed(run), f"{_ddl(docs)}, {kind}")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def toxic_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_offending), learned outside the held-out fold."""
    return score(docs.select("doc_id", "text"), train(docs, labels)).select(
        "doc_id",
        F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, with their columns, whatever their names."""
    clean = lambda rows: score(rows, train(rows, labels)).where(F.col("score") < REJECT)
    return carried(docs, ("doc_id", "text"), clean)
