"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

Documents are read once for a block of items and become segments: for the terms sought, lists of
the documents that hold them and how often. Their counts over all segments give the weights. Then each
segment is searched for each item. The shortest lists are summed term by term into accumulators, a
sorted list of documents with scores, which from there on is one more list with bounds. The
long lists and the accumulators are run through side by side in document order; each list knows the
most that it adds to any document of each stretch of BLOCK documents, and stretches whose bounds
do not sum to the item's least kept score are skipped. A task keeps the best of each item over its
segments, so the bar is high after the first ones, and emits nothing else.

A term's part of a score is the weight times a saturating function of how often it occurs, in
whole numbers, with documents of more terms than average counting less. Skipping drops no document
that could be among the best: bounds are exact maxima, and equal scores are not skipped.

Defined results: a null or empty text has no term. It is found by nothing, and a document without
terms does not count. Items with the same id, null among them, are one item with the terms of all;
an item without terms has no rows. Repeated documents are ranked row by row; a null doc_id comes
behind others of its score. Other columns don't matter, and empty tables give no rows.

Terms are compared by 64-bit hashes. Tasks and the driver hold the sought terms of one block of
items: TERMS of all items, or those of a single item with more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlake.llm.arrays import BYTES, LOWER, cut, packed, pieces, range_hashes, ranges, text_bytes, unpacked
from textlake.plans.ranking import running_total
from textlake.plans.staging import stage, stacked

TERMS = 1_000_000  # sought at once, with repeats over items
SEGMENT = 1_000_000  # list entries, or documents, of a segment; one document may have more
BLOCK = 64  # documents that share a bound
STRIDE = 64  # blocks looked at before the bar is raised
SHORT = 0.25  # accumulators at most, in documents of the segment

_IS_TERM = (BYTES >= 128) | ((BYTES >= 48) & (BYTES <= 57)) | ((BYTES >= 65) & (BYTES <= 90)) | ((BYTES >= 97) & (BYTES <= 122))


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the term with A-Z lower-cased, text) of every run of digits, letters and what is not ASCII."""
    starts, ends = cut(_IS_TERM[data], offsets)
    return range_hashes(LOWER[data], starts, ends), np.searchsorted(offsets, starts, "right") - 1


def item_terms(items: DataFrame) -> DataFrame:
    """(number, item_id, term, block): distinct terms of every item that has any, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for one, two in pieces(offsets):
                hashes, text = terms(data[offsets[one] : offsets[two]], offsets[one : two + 1] - offsets[one])
                yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(text + one)), pa.array(hashes.view("int64"))], ["item_id", "term"])

    kind = dict(items.dtypes)["item_id"]
    found = items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term bigint").distinct()
    found = stage(found, "item-terms")
    sizes = running_total(stage(found.groupBy("item_id").agg(F.count("*").alias("n")), "items"), ["item_id"], out="number")
    sizes = stage(running_total(stage(sizes, "items"), ["item_id"], F.col("n"), out="upto"), "items")
    # a block's items begin in a span that leaves room for the last of them; large items are blocks of their own
    large, start = F.col("n") > TERMS // 2, F.col("upto") - F.col("n")
    longest = sizes.where(~large).agg(F.max("n").alias("n")).first()["n"] or 0
    block = F.when(large, -1 - F.col("number")).otherwise(F.floor(start / (TERMS - longest + 1)))
    placed = stage(sizes.select(F.col("item_id").alias("_id"), "number", block.alias("block")), "items")
    return stage(found.join(placed, F.col("item_id").eqNullSafe(F.col("_id"))).drop("_id"), "item-terms")


@dataclass
class Sought:
    """The terms of some items: sorted hashes, and for each item the places of its terms."""

    hashes: np.ndarray
    numbers: np.ndarray  # items
    at: np.ndarray  # where each item's terms begin, with the end
    which: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Sought:
        number, term = rows["number"].to_numpy(), rows["term"].to_numpy().view("uint64")
        hashes, which = np.unique(term, return_inverse=True)
        order = np.lexsort((which, number))
        numbers, first = np.unique(number[order], return_index=True)
        return cls(hashes, numbers, np.append(first, len(number)), which[order])


SEGMENT_KIND = "docs bigint, terms bigint, ids binary, known binary, sizes binary, term binary, doc binary, times binary"


def segments(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Lists of the documents that hold the sought terms, written.

    docs and terms count all documents with terms; the lists are sorted by term, then document.
    """
    sent = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, docs, entries, count, total = sent.value, [], 0, 0, 0, 0

        def put() -> pa.RecordBatch:
            ids, known, sizes, term, doc, times = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.argsort(term, kind="stable")
            blobs = (ids, known, sizes, term[order], doc[order], times[order])
            row = {"docs": [count], "terms": [total]} | {n: pa.array([packed(b)], pa.binary()) for n, b in zip(("ids", "known", "sizes", "term", "doc", "times"), blobs, strict=True)}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            names = batch.column("doc_id").cast(pa.int64())
            ids, known = names.fill_null(0).to_numpy(), names.is_valid().to_numpy(zero_copy_only=False)
            for one, two in pieces(offsets):
                found, text = terms(data[offsets[one] : offsets[two]], offsets[one : two + 1] - offsets[one])
                sizes = np.bincount(text, minlength=two - one)
                count, total = count + int((sizes > 0).sum()), total + len(found)
                at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                hit = np.flatnonzero(hashes[at] == found)
                cells, times = np.unique(at[hit] * (two - one) + text[hit], return_counts=True)
                term, doc = cells // (two - one), cells % (two - one)
                some, doc = np.unique(doc, return_inverse=True)  # documents without sought terms stay out
                held.append((ids[one + some], known[one + some], sizes[some], term.astype("int32"), (docs + doc).astype("int32"), times.astype("int32")))
                docs, entries = docs + len(some), entries + len(cells)
                if entries >= SEGMENT or docs >= SEGMENT:
                    yield put()
                    held, docs, entries, count, total = [], 0, 0, 0, 0
        if held:
            yield put()

    return stage(docs.select("doc_id", "text").mapInArrow(run, SEGMENT_KIND), "segments")


def document_counts(found: DataFrame, size: int) -> np.ndarray:
    """In how many documents each sought term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, "int64")
        for batch in batches:
            for blob in batch.column("term"):
                counts += np.bincount(unpacked(blob.as_buffer(), "int32"), minlength=size)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": some, "n": counts[some]})

    rows = found.select("term").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row for each sought term
    counts = np.zeros(size, "int64")
    counts[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return counts


def weights(counts: np.ndarray, docs: int) -> np.ndarray:
    different, which = np.unique(counts, return_inverse=True)
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(c) + 1))) for c in different], "int64")[which]


class Best:
    """The best documents of an item so far."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.scores, self.ids, self.known = np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0, bool)

    def bar(self) -> int:
        """Least score that can still be among the best."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores, ids, known = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.known, known)))
        order = np.lexsort((ids, ~known, -scores))[: self.top]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]


class Segment:
    """Lists with the parts of scores that they give, and their bounds by stretches of documents."""

    def __init__(self, row: dict, weight: np.ndarray, docs: int, total: int) -> None:
        get = lambda name, kind: unpacked(row[name], kind)
        self.ids, self.known, size = get("ids", "int64"), get("known", "bool"), get("sizes", "int64")
        term, self.doc, times = get("term", "int32"), get("doc", "int32"), get("times", "int32").astype("int64")
        m = 50 + (50 * size * docs) // max(total, 1)
        self.part = weight[term] * ((1_000_000_000 * times) // (1000 * times + 20 * m[self.doc]))
        self.at = np.searchsorted(term, np.arange(len(weight) + 1))
        block = self.doc // BLOCK
        edge = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
        self.first, self.last, self.block = edge, np.append(edge[1:], len(term)), block[edge]
        self.bound = np.maximum.reduceat(self.part, edge) if len(edge) else np.empty(0, "int64")
        self.blocks_at = np.searchsorted(edge, self.at)

    def search(self, which: np.ndarray, best: Best) -> int:
        """Bring an item's best up to date; how many list entries of long lists were read."""
        sizes = self.at[which + 1] - self.at[which]
        order = np.argsort(sizes, kind="stable")
        short = np.cumsum(sizes[order]) <= SHORT * len(self.ids)
        which, sizes = which[order], sizes[order]
        # term at a time: the short lists become one list of documents with sums
        some = ranges(self.at[which[short]], sizes[short])
        summed, place = np.unique(self.doc[some], return_inverse=True)
        sums = np.zeros(len(summed), "int64")
        np.add.at(sums, place, self.part[some])
        if len(sums) >= best.top:  # sums are at most the scores: the best ones are a bar already
            bar = max(best.bar(), int(np.partition(sums, len(sums) - best.top)[len(sums) - best.top]))
        else:
            bar = best.bar()
        # document at a time: the long lists and the sums side by side, by stretches
        blocks = -(-len(self.ids) // BLOCK)
        bounds = np.zeros(blocks, "int64")
        np.maximum.at(bounds, summed // BLOCK, sums)
        long = which[~short]
        cells = ranges(self.blocks_at[long], self.blocks_at[long + 1] - self.blocks_at[long])
        np.add.at(bounds, self.block[cells], self.bound[cells])
        cells = cells[np.argsort(self.block[cells], kind="stable")]
        cell_block, read = self.block[cells], 0
        for low in range(0, blocks, STRIDE):
            high = min(low + STRIDE, blocks)
            wanted = bounds[low:high] >= max(bar, 1)
            if not wanted.any():
                continue
            near = cells[np.searchsorted(cell_block, low) : np.searchsorted(cell_block, high)]
            near = near[wanted[self.block[near] - low]]
            entries = ranges(self.first[near], self.last[near] - self.first[near])
            scores = np.zeros((high - low) * BLOCK, "int64")
            np.add.at(scores, self.doc[entries] - low * BLOCK, self.part[entries])
            own = slice(*np.searchsorted(summed, [low * BLOCK, high * BLOCK]))
            scores[summed[own] - low * BLOCK] += sums[own]
            scores[~np.repeat(wanted, BLOCK)] = 0
            hit = np.flatnonzero(scores >= max(bar, 1))
            best.add(scores[hit], self.ids[low * BLOCK + hit], self.known[low * BLOCK + hit])
            bar, read = max(bar, best.bar()), read + len(entries)
        return read


def searched(found: DataFrame, sought: Sought, weight: np.ndarray, docs: int, total: int, top: int) -> DataFrame:
    """(number, doc_id, score): the best of each item in each task."""
    sent = found.sparkSession.sparkContext.broadcast((sought, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought, weight = sent.value
        best: dict[int, Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row, weight, docs, total)
                held = np.diff(segment.at) > 0
                for i, number in enumerate(sought.numbers):
                    which = sought.which[sought.at[i] : sought.at[i + 1]]
                    if held[which].any():
                        segment.search(which[held[which]], best.setdefault(int(number), Best(top)))
        for number, b in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(b.ids), number)), pa.array(b.ids, mask=~b.known), pa.array(b.scores)], ["number", "doc_id", "score"]
            )

    return found.mapInArrow(run, "number bigint, doc_id bigint, score bigint")


def ranked(docs: DataFrame, items: DataFrame, top: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the highest-scoring documents of each item."""
    asked = item_terms(items)
    parts = []
    for row in asked.select("block").distinct().orderBy("block").collect():  # blocks of TERMS terms
        sought = Sought.of(asked.where(F.col("block") == row["block"]).select("number", "term").toArrow())
        found = segments(docs, sought.hashes)
        sums = found.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first()
        weight = weights(document_counts(found, len(sought.hashes)), sums["docs"])
        parts.append(searched(found, sought, weight, sums["docs"], sums["terms"], top))
    kind = dict(items.dtypes)["item_id"]
    if not parts:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = stacked(parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = asked.select("number", "item_id").distinct()
    return best.join(names, "number").select("item_id", "rank", "doc_id", "score")
