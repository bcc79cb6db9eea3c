"""Byte-pair encoding: learning merges, encoding and decoding, on byte-level symbols."""

from __future__ import annotations

import heapq
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.functions.fixed import BPE_SPECIALS
from textlake.plans.lookup import lookup
from textlake.plans.staging import stage, stacked

# Fixed value: contractions, words, numbers, other marks (with one leading space), spaces.
PRE_TOKEN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MAX_PAIRS = 100_000  # most pairs that a round looks at
MAX_CHAINS = 200_000  # most chains of them that the driver holds …
MAX_SYMBOLS = 3_000_000  # … and their symbols together
FEW_CHAINS = 20_000  # if there are fewer, the next round looks at more pairs
AT_ONCE = 256  # texts whose distinct words are looked up at once
REMEMBERED = 128_000_000  # bytes of words and ids that a task remembers, about
ENTRY = 250  # bytes of an entry besides


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


_PLAIN = "".join(chr(b) for b in range(256))
_SHOWN = "".join(byte_symbols())


def to_symbols(text: Column) -> Column:
    """UTF-8 bytes of a text, one printable character per byte."""
    as_latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.translate(as_latin, _PLAIN, _SHOWN)


def from_symbols(symbols: Column) -> Column:
    # translate would delete a character instead of turning it into the zero byte
    as_latin = F.replace(F.translate(symbols, _SHOWN[1:], _PLAIN[1:]), F.lit(_SHOWN[0]), F.lit(_PLAIN[0]))
    return F.decode(F.encode(as_latin, "ISO-8859-1"), "UTF-8")


def pre_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRE_TOKEN), F.lit(0))


def word_counts(docs: DataFrame) -> DataFrame:
    """Written (word, n): distinct pre-tokens as byte symbols."""
    words = docs.select(F.explode(pre_tokens(F.col("text"))).alias("w"))
    counts = words.groupBy("w").agg(F.count("*").alias("n"))
    return stage(counts.select(to_symbols(F.col("w")).alias("word"), "n"), "bpe-words")


def letter(number: int) -> str:
    """The character that stands for a symbol while merges are learned."""
    code = number + 0x100
    return chr(code if code < 0xD800 else code + 0x800)  # surrogates are no characters


def top_pairs(words: DataFrame, k: int, min_frequency: int) -> list[tuple[int, str]]:
    """(count, pair) of the k most frequent neighbours over words (spelled, n), ties by symbol."""
    size = F.length("spelled") - 1
    pairs = F.transform(F.sequence(F.lit(1), size), lambda i: F.col("spelled").substr(i, F.lit(2)))
    rows = words.select("n", T.each(F.when(size > 0, pairs)).alias("pair"))
    counts = rows.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= min_frequency)
    return [(r["n"], r["pair"]) for r in counts.orderBy(F.desc("n"), "pair").limit(k).collect()]


def chains_of(word: str, pairs: set[str]) -> Iterator[str]:
    """The longest runs of symbols whose neighbours are all among the pairs."""
    begin = 0
    for i in range(1, len(word) + 1):
        if word[i - 1 : i + 1] not in pairs:
            if i - begin > 1:
                yield word[begin:i]
            begin = i


def chains(words: DataFrame, pairs: set[str]) -> DataFrame:
    """Written (chain, n): the chains of the pairs in all words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter[str] = Counter()
            for word, n in zip(batch["spelled"], batch["n"], strict=True):
                for chain in chains_of(word, pairs):
                    found[chain] += n
            if found:  # a frame without rows has no type that Arrow takes
                yield pd.DataFrame({"chain": list(found), "n": list(found.values())})

    rows = words.mapInPandas(run, "chain string, n bigint")
    return stage(rows.groupBy("chain").agg(F.sum("n").alias("n")), "bpe-chains")


class Chains:
    """Counts of neighbours in some chains, kept up to date while pairs are merged."""

    def __init__(self, rows: list[tuple[str, int]]) -> None:
        self.rows = [list(chain) for chain, _ in rows]
        self.times = [n for _, n in rows]
        self.counts: Counter[tuple[str, str]] = Counter()
        self.holders: dict[tuple[str, str], set[int]] = {}  # chains that have had a pair
        for i, (row, n) in enumerate(zip(self.rows, self.times, strict=True)):
            for pair in zip(row, row[1:], strict=False):
                self.counts[pair] += n
                self.holders.setdefault(pair, set()).add(i)
        self.heap = [(-n, a, b) for (a, b), n in self.counts.items()]
        heapq.heapify(self.heap)

    def best(self) -> tuple[int, str, str] | None:
        """(count, left, right) of the most frequent pair, ties by symbol."""
        while self.heap:
            n, a, b = self.heap[0]
            if self.counts[a, b] == -n:
                return -n, a, b
            heapq.heappop(self.heap)  # the pair's count has changed since, which is on the heap as well
        return None

    def merge(self, a: str, b: str, merged: str) -> None:
        """Put one symbol for the pair in all chains that have it."""
        changes: Counter[tuple[str, str]] = Counter()
        for i in self.holders.pop((a, b), ()):
            row, n, joined, k = self.rows[i], self.times[i], [], 0
            end = len(row) - 1
            while k <= end:
                if row[k] != a or k == end or row[k + 1] != b:
                    joined.append(row[k])
                    k += 1
                    continue
                changes[a, b] -= n
                if joined:
                    changes[joined[-1], a] -= n
                    changes[joined[-1], merged] += n
                    self.holders.setdefault((joined[-1], merged), set()).add(i)
                joined.append(merged)
                k += 2
                if k <= end:  # if a merge follows here, it takes this back
                    changes[b, row[k]] -= n
                    changes[merged, row[k]] += n
                    self.holders.setdefault((merged, row[k]), set()).add(i)
            self.rows[i] = joined
        for pair, n in changes.items():
            if n:
                self.counts[pair] += n
                if self.counts[pair]:
                    heapq.heappush(self.heap, (-self.counts[pair], *pair))


def certain_merges(rows: list[tuple[str, int]], last: tuple[int, str] | None, known: dict[str, int], names: list[str], size: int, min_frequency: int) -> list[tuple[str, str]]:
    """The next merges of training, as far as the chains tell them.

    rows: all chains of the pairs looked at; last: (count, pair) of the last of these, if there
    may be others. A pair outside of all chains comes behind the last one, and so does any that
    arises from it: it has one symbol of a pair outside in place of a merge's symbol, is no more
    frequent, and the new symbol sorts last. So training goes on in the chains alone until the
    most frequent pair in them comes behind the last one. A merge whose symbol exists already ends this, as
    the pairs of both origins add up. known and names, symbols by spelling and by number, grow.
    """
    chained, merges = Chains(rows), []
    while len(names) < size and (best := chained.best()):
        n, a, b = best
        if n < min_frequency or (last and (-n, a + b) > (-last[0], last[1])):
            break
        spelled = names[number(a)] + names[number(b)]
        merges.append((a, b))
        if spelled in known:
            break
        known[spelled] = len(names)
        names.append(spelled)
        chained.merge(a, b, letter(known[spelled]))
    return merges


def number(symbol: str) -> int:
    code = ord(symbol)
    return (code if code < 0xD800 else code - 0x800) - 0x100


def by_chains(word: str, pairs: set[str], ranks: dict[tuple[str, str], int], joined: dict[tuple[str, str], str], done: dict[str, str]) -> str:
    """The word after a round's merges, which never join symbols of two chains; done: chains after them."""
    found, begin = [], 0
    for i in range(1, len(word) + 1):
        if word[i - 1 : i + 1] not in pairs:
            chain = word[begin:i]
            if i - begin > 1:
                if (after := done.get(chain)) is None:
                    after = done[chain] = "".join(segment(chain, ranks, joined))
                chain = after
            found.append(chain)
            begin = i
    return "".join(found)


def rewritten(words: DataFrame, pairs: set[str], merges: list[tuple[str, str]], known: dict[str, int], names: list[str]) -> DataFrame:
    """Words (spelled, n) after some merges in the chains of the pairs, written."""
    ranks = {pair: i for i, pair in enumerate(merges)}
    joined = {(a, b): letter(known[names[number(a)] + names[number(b)]]) for a, b in merges}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: dict[str, str] = {}  # no more than the round's chains
        for batch in batches:
            spelled = [by_chains(w, pairs, ranks, joined, done) for w in batch["spelled"]]
            yield pd.DataFrame({"spelled": spelled, "n": batch["n"]})

    rows = words.mapInPandas(run, "spelled string, n bigint")
    return stage(rows.where(F.length("spelled") > 1), "bpe-spelled")


def bpe_train(words: DataFrame, vocab_size: int = 30_000, min_frequency: int = 2) -> list[tuple[str, str]]:
    """Merges in learned order, from a written (word, n) table.

    Words are spelled with a character for each symbol. A round takes the most frequent pairs and
    cuts the distinct words, in tasks, into chains of these; equal chains are added up. The
    driver trains on the chains as far as they determine the merges, often thousands, and the tasks
    merge these in the words. It takes as many pairs as give chains that the driver can hold;
    one pair needs none. The merges are those of counting anew after each.
    """
    names = [*BPE_SPECIALS, *sorted(byte_symbols())]
    known = {s: i for i, s in enumerate(names)}
    shown = "".join(sorted(byte_symbols()))
    letters = "".join(letter(known[c]) for c in shown)
    current = words.where(F.length("word") > 1).select(F.translate("word", shown, letters).alias("spelled"), "n")
    current, merges, k = stage(current, "bpe-spelled"), [], 32
    while len(names) < vocab_size:
        top = top_pairs(current, k, min_frequency)
        if not top:
            break
        last = top[-1] if len(top) == k else None
        rows, pairs = [(top[0][1], top[0][0])], {pair for _, pair in top}
        if len(top) > 1:
            table = chains(current, pairs)
            size = table.agg(F.count("*").alias("rows"), F.sum(F.length("chain")).alias("symbols")).first()
            if size["rows"] > MAX_CHAINS or size["symbols"] > MAX_SYMBOLS:
                k = max(1, len(top) // 4)
                continue
            rows = [(r["chain"], r["n"]) for r in table.collect()]
            if size["rows"] < FEW_CHAINS:
                k = min(4 * k, MAX_PAIRS)
        found = certain_merges(rows, last, known, names, vocab_size, min_frequency)
        merges += [(names[number(a)], names[number(b)]) for a, b in found]
        current = rewritten(current, pairs, found, known, names)
    return merges


def tokenizer_tables(spark, merges: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """vocab (token, id): specials, bytes, merged symbols; merges (rank, left, right)."""
    tokens = list(dict.fromkeys([*BPE_SPECIALS, *sorted(byte_symbols()), *(a + b for a, b in merges)]))
    vocab = spark.createDataFrame(list(zip(tokens, range(len(tokens)), strict=True)), "token string, id int")
    rows = [(i, a, b) for i, (a, b) in enumerate(merges)]
    return vocab, spark.createDataFrame(rows, "rank int, left string, right string")


def segment(word: str, ranks: dict[tuple[str, str], int], joined: dict[tuple[str, str], str] | None = None) -> list[str]:
    """Apply the learned merges to one word, lowest rank first; joined: the symbol of each merge."""
    parts = list(word)
    while len(parts) > 1:
        best = min(zip(parts, parts[1:], strict=False), key=lambda p: ranks.get(p, len(ranks)))
        if best not in ranks:
            break
        symbol = joined[best] if joined else best[0] + best[1]
        merged, i = [], 0
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                merged.append(symbol)
                i += 2
            else:
                merged.append(parts[i])
                i += 1
        parts = merged
    return parts


def word_ids(words: DataFrame, vocab: DataFrame, merges: DataFrame) -> DataFrame:
    """Written (word, n, ids): every distinct word is cut once, however often it occurs.

    vocab and merges are bounded by the vocabulary size and travel with the tasks.
    """
    ranks = {(r["left"], r["right"]): r["rank"] for r in merges.collect()}
    ids = {r["token"]: r["id"] for r in vocab.collect()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cut = [[ids[s] for s in segment(w, ranks)] for w in batch["word"]]
            yield pd.DataFrame({"word": batch["word"], "n": batch["n"], "ids": cut})

    return stage(words.mapInPandas(run, "word string, n bigint, ids array<int>"), "bpe-word-ids")


def encoded(batches: Iterator[pa.RecordBatch], ranks: dict[tuple[str, str], int], ids: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) of rows (doc_id, words); a distinct word is cut once a task, as long as it is remembered."""
    known, held, to_shown = {}, 0, str.maketrans(_PLAIN, _SHOWN)
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            rows = batch.slice(at, AT_ONCE)
            words = rows.column("words")
            counts = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            table = words.flatten().dictionary_encode()
            if held > REMEMBERED:
                known, held = {}, 0
            cut = []
            for word in table.dictionary.to_pylist():
                if (found := known.get(word)) is None:
                    parts = segment(word.encode().decode("latin-1").translate(to_shown), ranks)
                    found = known[word] = array("i", [ids[s] for s in parts])
                    held += ENTRY + len(word) + 4 * len(found)
                cut.append(found)
            sizes = np.array([len(x) for x in cut], "int64")
            starts, values = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(cut), "int32")
            place = table.indices.to_numpy(zero_copy_only=False)
            many = sizes[place]
            ends = np.concatenate([[0], np.cumsum(many)])
            values = values[np.arange(ends[-1]) + np.repeat(starts[place] - ends[:-1], many)]
            offsets = ends[np.concatenate([[0], np.cumsum(counts)])].astype("int32")
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))], names=["doc_id", "ids"])


def bpe_encode(docs: DataFrame, vocab: DataFrame, merges: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(doc_id, ids): token ids of every text.

    Texts are encoded in the task that reads them, so their tokens are not shuffled. Rows that share a
    doc_id become one row, in the order of places; only these are joined with a written word table.
    vocab and merges are bounded by the vocabulary size and travel with the tasks.
    """
    shared = stage(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_id")), "bpe-repeated")
    ranks = {(r["left"], r["right"]): r["rank"] for r in merges.collect()}
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    same, kind = F.col("doc_id").eqNullSafe(F.col("_id")), dict(docs.dtypes)["doc_id"]
    repeated = not shared.isEmpty()
    alone = docs.join(shared, same, "left_anti") if repeated else docs
    own = alone.select("doc_id", pre_tokens(F.col("text")).alias("words"))
    found = own.mapInArrow(lambda batches: encoded(batches, ranks, ids), f"doc_id {kind}, ids array<int>")
    if not repeated:
        return found
    docs = docs.join(shared, same, "left_semi")
    return stacked([found, _joined(docs, word_ids(words if words is not None else word_counts(docs), vocab, merges))])


def _joined(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, ids) by a join of the texts' words with a written table (word, n, ids)."""
    rows = docs.select("doc_id", F.posexplode_outer(pre_tokens(F.col("text"))).alias("pos", "w"))
    rows = rows.select("doc_id", "pos", to_symbols(F.col("w")).alias("word"))
    found = lookup(rows, table, ["word"], weight="n")
    part = F.when(F.col("pos").isNotNull(), F.struct("pos", "ids"))
    ordered = F.sort_array(F.collect_list(part)).getField("ids")
    return found.groupBy("doc_id").agg(F.flatten(ordered).alias("ids"))


def bpe_decode(seqs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc_id, text): ids back to text, special tokens dropped; each row is spelled in place."""
    ordered = F.sort_array(F.collect_list(F.struct("id", "token"))).getField("token")
    # as many tokens as the vocabulary has, which is a training parameter
    spelled = seqs.withColumn("_tokens", vocab.agg(ordered).scalar())
    kept = F.filter("ids", lambda i: i >= len(BPE_SPECIALS))
    text = F.array_join(F.transform(kept, lambda i: F.get(F.col("_tokens"), i)), "")
    return spelled.select("doc_id", from_symbols(text).alias("text"))
