"""Language identification by unigrams of pieces, summed over all segmentations.

A language is a distribution over the pieces of a fixed public vocabulary, and a word is some
sequence of pieces: its probability is the sum over all its segmentations, which the forward
algorithm adds up along the word. A text's probability is the product over its words, and
the language is the likeliest one, given how many training documents each has.

Words are runs of letters, lower-cased, behind a blank; runs of over WORD bytes go on as further
words without it. Only pieces of a blank and letters are used. All single bytes are pieces, so
every word has a segmentation. Piece probabilities are learned by expectation-maximisation:
expected counts of the pieces over all segmentations of a language's words, by the forward and
the backward algorithm. Counts of words are taken from training documents that a hash chooses, some
SAMPLE_BYTES of text for each language, all of a language that has less.

Defined results: a null text or one without a letter is `und` with score 0, as is every text where
no language was learned. The score is the probability of the language predicted, given the text.
Equal probabilities go to the language that sorts first. A null lang teaches nothing; an empty
string is a language. Repeated rows are predicted row by row and learned from row by row; a null
doc_id is never learned from and never held out. Columns named like the new ones are replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.llm.arrays import BYTES, cut, pieces, range_hashes, ranges, text_bytes
from textlake.llm.shards import ddl
from textlake.plans.lookup import lookup
from textlake.plans.ranking import running_total
from textlake.plans.staging import stage

SAMPLE_BYTES = 16_000_000  # text that each language is learned from, about
LANGUAGES = 32  # learned and compared at once; more take further passes
WORD = 32  # most bytes of a word
ROUNDS = 5  # of expectation-maximisation
ADDED = 0.05  # expected count that every piece has besides
SLOTS = 100_000  # bytes of distinct words worked on at once
UNKNOWN = "und"

_IS_LETTER = (BYTES >= 128) | ((BYTES >= 97) & (BYTES <= 122))
_PIECE = re.compile(rb" ?[a-z\x80-\xff]+")


def read_pieces(path: str) -> list[bytes]:
    """The pieces of a vocabulary file, one in base 64 and its rank a line, that words are made of."""
    with open(path, "rb") as file:
        found = {base64.b64decode(line.split()[0]) for line in file if line.strip()}
    single = {bytes([b]) for b in range(256) if _IS_LETTER[b]} | {b" "}
    return sorted(single | {p for p in found if _PIECE.fullmatch(p)})


class Trie:
    """All pieces that begin at a place are found by walking down from the root, byte by byte."""

    def __init__(self, vocabulary: list[bytes]) -> None:
        inner = {p[:i] for p in vocabulary for i in range(len(p))}
        number = {p: n for n, p in enumerate(sorted(inner, key=lambda p: (len(p), p)))}  # the root is 0
        self.inner = len(number)
        for p in vocabulary:
            number.setdefault(p, len(number))
        edges = [(number[p[:-1]], p[-1], n) for p, n in number.items() if p]
        self.edges = np.array(edges, "int32").reshape(-1, 3)
        self.piece = np.full(len(number), -1, "int32")
        for i, p in enumerate(vocabulary):
            self.piece[number[p]] = i

    def table(self) -> np.ndarray:
        """Child of each inner node by byte; 0 where there is none."""
        children = np.zeros((self.inner, 256), "int32")
        children[self.edges[:, 0], self.edges[:, 1]] = self.edges[:, 2]
        return children


class Walker:
    """A trie at work in a task."""

    def __init__(self, trie: Trie) -> None:
        self.children, self.piece, self.inner = trie.table(), trie.piece, trie.inner

    def lattice(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(piece size, bytes where pieces of that size begin, the pieces), by place in the word.

        In one entry all pieces begin at the same place of different words, entries ascend by place.
        """
        sizes = np.diff(offsets)
        place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
        left = (np.repeat(offsets[1:], sizes) - np.arange(len(data))).astype("int64")
        at = np.argsort(place.astype("uint8"), kind="stable")
        node, depth, found = np.zeros(len(at), "int32"), 0, []
        while len(at):
            node = self.children[node, data[at + depth]]
            depth += 1
            hit = np.flatnonzero(self.piece[node] >= 0)
            begins, which = at[hit], self.piece[node[hit]]
            edges = np.append(np.flatnonzero(np.diff(place[begins], prepend=-1)), len(begins))
            for first, last in zip(edges[:-1], edges[1:], strict=True):
                found.append((int(place[begins[first]]), depth, begins[first:last], which[first:last]))
            on = (node > 0) & (node < self.inner) & (left[at] > depth)
            at, node = at[on], node[on]
        found.sort(key=lambda f: f[:2])
        return [f[1:] for f in found]


def forward(lattice: list, shares: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of what lies before each place; a word has a place more than bytes.

    shares: probability of each piece in each language.
    """
    words = len(offsets) - 1
    sums = np.zeros((int(offsets[-1]) + words, shares.shape[1]))
    sums[offsets[:-1] + np.arange(words)] = 1
    shift = np.repeat(np.arange(words), np.diff(offsets))
    for size, begins, which in lattice:
        at = begins + shift[begins]
        sums[at + size] += sums[at] * shares[which]
    return sums


def expected(lattice: list, shares: np.ndarray, language: np.ndarray, times: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Expected count of each piece in each language, over words of one language each."""
    words = len(offsets) - 1
    first, last = offsets[:-1] + np.arange(words), offsets[1:] + np.arange(words)
    before, behind = np.zeros(int(offsets[-1]) + words), np.zeros(int(offsets[-1]) + words)
    before[first], behind[last] = 1, 1
    word = np.repeat(np.arange(words), np.diff(offsets))
    steps = [(size, begins + word[begins], shares[which, language[word[begins]]]) for size, begins, which in lattice]
    for size, at, share in steps:
        before[at + size] += before[at] * share
    for size, at, share in reversed(steps):
        behind[at] += share * behind[at + size]
    weight = times / before[last]
    cells, some = [np.empty(0, "int64")], [np.empty(0)]
    for (size, at, share), (_, begins, which) in zip(steps, lattice, strict=True):
        cells.append(which.astype("int64") * shares.shape[1] + language[word[begins]])
        some.append(before[at] * share * behind[at + size] * weight[word[begins]])
    return np.bincount(np.concatenate(cells), np.concatenate(some), shares.size).reshape(shares.shape)


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of lower-cased texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, whether a run of letters begins) of words; a long run is cut between characters."""
    starts, ends = cut(_IS_LETTER[data], offsets)
    opens = np.ones(len(starts), bool)
    while (long := ends - starts > WORD).any():
        at = starts[long] + WORD
        for _ in range(3):
            at -= (data[at] & 0xC0) == 0x80
        starts, ends = np.append(starts, at), np.append(np.where(long, 0, ends), ends[long])
        ends[np.flatnonzero(long)] = at
        opens = np.append(opens, np.zeros(len(at), bool))
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order], opens[order]


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of words, those that open a run behind a blank."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes + opens)])
    out = np.full(int(offsets[-1]), 32, "uint8")
    out[ranges(offsets[:-1] + opens, sizes)] = data[ranges(starts, sizes)]
    return out, offsets


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each distinct word is first, number of the distinct word that each is)."""
    hashes = range_hashes(data, starts, ends) ^ opens.astype("uint64")
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    return first, which


@dataclass
class Model:
    """Some languages: their names, log shares of training documents, and piece probabilities."""

    names: list[str]
    priors: np.ndarray
    shares: np.ndarray  # pieces x languages

    def word_logs(self, walker: Walker, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        logs = np.empty((len(offsets) - 1, len(self.names)))
        for first, last in pieces(offsets, max(1000, 4 * SLOTS // max(4, len(self.names)))):
            some, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            sums = forward(walker.lattice(some, at), self.shares, at)
            logs[first:last] = np.log(sums[at[1:] + np.arange(len(at) - 1)])
        return logs

    def text_logs(self, walker: Walker, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log probability of each text together with each language."""
        starts, ends, opens = runs(data, offsets)
        found = np.tile(self.priors, (len(offsets) - 1, 1))
        if len(starts):
            first, which = distinct(data, starts, ends, opens)
            logs = self.word_logs(walker, *spelled(data, starts[first], ends[first], opens[first]))
            text = np.searchsorted(offsets, starts, "right") - 1
            for k in range(len(self.names)):
                found[:, k] += np.bincount(text, logs[which, k], len(found))
        return found


def held_out(column: str = "doc_id") -> Column:
    """Rows that nothing is learned from: the crc32 of the id leaves 1, by three."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))


def counted_words(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) over rows (lang, text), written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("lang").dictionary_encode()
            data, offsets = lowered(batch.column("text"))
            for one, two in pieces(offsets):
                some = data[offsets[one] : offsets[two]]
                starts, ends, opens = runs(some, offsets[one : two + 1] - offsets[one])
                if not len(starts):
                    continue
                text = np.searchsorted(offsets[one : two + 1] - offsets[one], starts, "right") - 1
                first, which = distinct(some, starts, ends, opens)
                spelt, at = spelled(some, starts[first], ends[first], opens[first])
                language = names.indices.to_numpy(zero_copy_only=False)[one:two][text]
                cells, n = np.unique(language.astype("int64") * len(first) + which, return_counts=True)
                words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(at.astype("int64")), pa.py_buffer(spelt)])
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": names.dictionary.take(pa.array(cells // len(first))).cast(pa.string()),
                        "word": words.take(pa.array(cells % len(first))).cast(pa.binary()),
                        "n": n.astype("int64"),
                    }
                )

    counts = labelled.select("lang", "text").mapInArrow(run, "lang string, word binary, n bigint")
    return stage(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")


def fitted(counts: DataFrame, names: list[str], trie: Trie, size: int) -> np.ndarray:
    """Piece probabilities of some languages by expectation-maximisation."""
    spark = counts.sparkSession
    some = counts.where(F.col("lang").isin(names))
    shares = np.full((size, len(names)), 1 / size)
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast((trie, names, shares))

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            trie, names, shares = sent.value
            walker, sums = Walker(trie), np.zeros(shares.shape)
            for batch in batches:
                data, offsets = text_bytes(batch.column("word").cast(pa.large_binary()))
                language = pc.index_in(batch.column("lang"), pa.array(names)).to_numpy(zero_copy_only=False)
                times = batch.column("n").to_numpy().astype("float64")
                for one, two in pieces(offsets, SLOTS):
                    at = offsets[one : two + 1] - offsets[one]
                    lattice = walker.lattice(data[offsets[one] : offsets[two]], at)
                    sums += expected(lattice, shares, language[one:two], times[one:two], at)
            piece, language = np.nonzero(sums)
            yield pa.RecordBatch.from_pydict({"piece": piece, "language": language, "n": sums[piece, language]})

        parts = some.mapInArrow(expect, "piece bigint, language bigint, n double")
        # at most a row for each piece and language
        rows = parts.groupBy("piece", "language").agg(F.sum("n").alias("n")).toArrow()
        sums = np.full(shares.shape, ADDED)
        sums[rows["piece"].to_numpy(), rows["language"].to_numpy()] += rows["n"].to_numpy()
        shares = sums / sums.sum(axis=0)
    return shares


def train(labelled: DataFrame, vocabulary: list[bytes], sample_bytes: int = SAMPLE_BYTES) -> list[Model]:
    """Models of all languages of rows (doc_id, text, lang), LANGUAGES in each; held-out rows teach nothing."""
    known = labelled.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sizes = known.groupBy("lang").agg(F.count("*").alias("docs"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"))
    sizes = stage(running_total(stage(sizes, "languages"), ["lang"], out="place"), "languages")
    total = sizes.agg(F.count("*").alias("n"), F.sum("docs").alias("docs")).first()
    chance = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) + 0.5) / (1 << 20)
    sample = lookup(known, sizes.select("lang", "bytes"), ["lang"], how="inner").where(chance * F.col("bytes") < sample_bytes)
    counts = counted_words(sample)
    trie, models = Trie(vocabulary), []
    for low in range(0, total["n"], LANGUAGES):
        rows = sizes.where(F.col("place").between(low + 1, low + LANGUAGES)).orderBy("place").collect()
        names = [r["lang"] for r in rows]
        priors = np.log(np.array([r["docs"] for r in rows]) / total["docs"])
        models.append(Model(names, priors, fitted(counts, names, trie, len(vocabulary))))
    return models


def _letters(texts: pa.Array) -> pa.Array:
    """Whether each text has a letter."""
    return pc.fill_null(pc.match_substring_regex(texts.cast(pa.large_string()), r"\p{L}"), False)


def detect(docs: DataFrame, models: list[Model], vocabulary: list[bytes]) -> DataFrame:
    """Rows with lang_pred and score; one pass over the rows for each model."""
    docs = docs.drop("lang_pred", "score")
    if not models:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    total = "_total"
    while total in [c.lower() for c in docs.columns]:
        total = f"_{total}"
    kept, trie = docs.columns, Trie(vocabulary)
    rows = docs.withColumn("lang_pred", F.lit(None).cast("string")).withColumn("score", F.lit(-np.inf)).withColumn(total, F.lit(-np.inf))
    for i, model in enumerate(models):
        sent, last = docs.sparkSession.sparkContext.broadcast((trie, model)), i == len(models) - 1

        def run(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            trie, model = sent.value
            walker, names = Walker(trie), pa.array(model.names, pa.string())
            for batch in batches:
                data, offsets = lowered(batch.column("text"))
                for one, two in pieces(offsets):
                    some = batch.slice(one, two - one)
                    logs = model.text_logs(walker, data[offsets[one] : offsets[two]], offsets[one : two + 1] - offsets[one])
                    best = logs.argmax(axis=1)
                    score, before = logs[np.arange(len(logs)), best], some.column("score").to_numpy()
                    better = score > before
                    name = pc.if_else(pa.array(better), names.take(pa.array(best)), some.column("lang_pred"))
                    score = np.where(better, score, before)
                    sums = np.logaddexp(some.column(total).to_numpy(), np.logaddexp.reduce(logs, axis=1))
                    found = {c: some.column(c) for c in kept}
                    if last:  # log probabilities become shares
                        letters = _letters(some.column("text"))
                        share = pa.array(np.minimum(np.exp(score - sums), 1.0))
                        found |= {"lang_pred": pc.if_else(letters, name, UNKNOWN), "score": pc.if_else(letters, share, 0.0)}
                    else:
                        found |= {"lang_pred": name, "score": pa.array(score), total: pa.array(sums)}
                    yield pa.RecordBatch.from_arrays(list(found.values()), list(found))

        rows = rows.mapInArrow(run, f"{ddl(docs)}, lang_pred string, score double" + ("" if last else f", {total} double"))
    return rows


def predicted(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), a row per document; path: a vocabulary file."""
    vocabulary = read_pieces(path)
    models = train(docs, vocabulary)
    rows = detect(docs.select("doc_id", "text"), models, vocabulary)
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
