"""Byte-pair encoding and decoding as streaming transducers.

Merges are applied in rank order, the leftmost first. Whether a token ends at some place can
depend on what follows only through a chain of merges of falling rank, each beginning inside
the right part of the one before. The longest such chain, in bytes, is the merge list's
sufficient lookahead: tokens that end so far before the end of what was read are stable, are
emitted, and encoding goes on behind them. The state is a window of that size. Decoding feeds
the tokens' bytes to a byte-to-text state machine, so that characters may straddle tokens.

Text is first split into pieces by the vocabulary's fixed pattern; pieces never merge with one
another, and a stretch that starts with a blank behind a character that is no white space is split
alone. Short stretches are remembered with their ids, up to a bound in bytes, until the task ends.

Defined results: a null or empty text has no ids and decodes to the empty text. Strings of
special tokens become their ids, as the library does it. Repeated rows are encoded row by row.
Columns named like the new ones are replaced.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.arrays import ranges
from textlake.llm.memory import freed

# Fixed value: how byte-level vocabularies split text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
STRETCH = 64  # characters of a stretch that is remembered
REMEMBERED = 128_000_000  # bytes of stretches and ids that a task remembers, about
ENTRY = 200  # bytes of an entry besides
MARKS = set(",.;:!?")
CHUNK = 1_000_000  # characters of a text that are cut into stretches at once, and up to the next cut
BOUNDARY = re.compile(r"(?<=\S) ")
AT_ONCE = 8192  # ids decoded at once
NO_MERGE, _RESULT = 1 << 62, (1 << 32) - 1


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeList:
    """Tokens as byte strings, and for each pair of ids its rank and result."""

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        self.tokens = tokens
        self.bytes_of = {i: t for t, i in tokens.items()}
        self.single = [tokens.get(bytes([b])) for b in range(256)]
        self.pairs = {}
        for rank, (a, b) in enumerate(merges):
            self.pairs.setdefault((tokens[a], tokens[b]), (rank, tokens[a + b]))
        # rank and result in one number, which sorts by rank
        self.order = {pair: rank << 32 | made for pair, (rank, made) in self.pairs.items()}
        self.lookahead = self.sufficient_lookahead()
        self.window = 4 * self.lookahead

    def sufficient_lookahead(self) -> int:
        """Bytes behind a place that can decide whether a token ends there.

        reach of a merge (x, y): y, and what decides whether y is there to be merged, which
        are the earlier merges that begin with a token on the right edge of y.
        """
        parts = {made: pair for pair, (_, made) in reversed(self.pairs.items())}
        best: dict[int, int] = {}  # by left token: the farthest reach of the merges so far
        longest = 1
        for (x, y), _ in sorted(self.pairs.items(), key=lambda kv: kv[1][0]):
            edge, beyond = y, 0
            while edge is not None:
                beyond = max(beyond, best.get(edge, 0))
                edge = parts[edge][1] if edge in parts else None
            reach = len(self.bytes_of[y]) + beyond
            best[x] = max(best.get(x, 0), reach)
            longest = max(longest, reach)
        return longest

    def singles(self, part: bytes) -> list[int]:
        return [x for x in map(self.single.__getitem__, part) if x is not None]

    def merged(self, ids: list[int]) -> list[int]:
        """All merges, in rank order, the leftmost first."""
        if len(ids) < 48:
            get, none = self.order.get, NO_MERGE
            ranks = [get(p, none) for p in zip(ids, ids[1:], strict=False)]
            while ranks:
                least = min(ranks)
                if least == none:
                    break
                at = ranks.index(least)
                ids[at : at + 2] = [least & _RESULT]
                del ranks[at]
                if at:
                    ranks[at - 1] = get((ids[at - 1], ids[at]), none)
                if at < len(ranks):
                    ranks[at] = get((ids[at], ids[at + 1]), none)
            return ids
        return self._merged_long(ids)

    def _merged_long(self, ids: list[int]) -> list[int]:
        ids, n = list(ids), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if found := self.pairs.get((ids[i], ids[i + 1])):
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if found := self.pairs.get((made, ids[after[i]])):
                    heapq.heappush(queue, (found[0], i, made, ids[after[i]], found[1]))
            if (p := before[i]) >= 0 and (found := self.pairs.get((ids[p], made))):
                heapq.heappush(queue, (found[0], p, ids[p], made, found[1]))
        return [x for x in ids if x >= 0]

    def stream(self, piece: bytes, window: int | None = None) -> Iterator[list[int]]:
        """Ids of a piece as they become stable; no more than a window is held."""
        window = max(window or self.window, 2 * self.lookahead)
        start, size = 0, window
        while start < len(piece):
            part = piece[start : start + size]
            ids = self.merged(self.singles(part))
            if start + size >= len(piece):
                yield ids
                return
            at, stable = 0, []
            for i in ids:
                at += len(self.bytes_of[i])
                if at > len(part) - self.lookahead:
                    break
                stable.append(i)
            if not stable:  # a token as long as the window: look at more
                size *= 2
                continue
            yield stable
            start, size = start + sum(len(self.bytes_of[i]) for i in stable), window


class Transducer:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, rules: str) -> None:
        import regex

        data = json.loads(rules)
        byte_of = byte_characters()
        raw = lambda t: bytes(byte_of[c] for c in t)
        model = data["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        tokens = {raw(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.merges = MergeList(tokens, [(raw(a), raw(b)) for a, b in pairs])
        self.bytes_of = self.merges.bytes_of | {i: t.encode() for t, i in self.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self.pattern = regex.compile(PATTERN)
        self.table = np.frombuffer(b"".join(self.bytes_of[i] for i in sorted(self.bytes_of)), "uint8")
        sizes = np.zeros(max(self.bytes_of) + 1, "int64")
        sizes[sorted(self.bytes_of)] = [len(self.bytes_of[i]) for i in sorted(self.bytes_of)]
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.forget()

    def forget(self) -> None:
        """Drop the remembered stretches."""
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _learned(self, text: str) -> bytes:
        """Ids of a short stretch, which are remembered."""
        word = text[1:] if text[0] == " " else text
        if word.isalpha():
            ids = self._piece(text)
        elif word[-1:] in MARKS and word[:-1].isalpha():
            mark = word[-1]
            ids = (self.known.get(text[:-1]) or self._learned(text[:-1])) + (self.known.get(mark) or self._learned(mark))
        else:
            pieces = self.pattern.findall(text)
            ids = b"".join([self.known.get(p) or self._learned(p) for p in pieces]) if len(pieces) > 1 else self._piece(text)
        self.held += ENTRY + 2 * len(text) + len(ids)
        if self.held > REMEMBERED:
            self.forget()
        self.known[text] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece no longer than a window."""
        return array("I", self.merges.merged(self.merges.singles(piece.encode("utf-8", "replace")))).tobytes()

    def _streamed(self, piece: str) -> Iterator[bytes]:
        for ids in self.merges.stream(piece.encode("utf-8", "replace")):
            yield array("I", ids).tobytes()

    def _stretch(self, text: str) -> Iterator[bytes]:
        """Ids of a stretch that is not remembered."""
        if len(text) <= STRETCH:
            yield self._learned(text)
            return
        for found in self.pattern.finditer(text):
            if len(piece := found[0]) <= STRETCH:
                yield self.known.get(piece) or self._learned(piece)
            else:
                yield from self._streamed(piece)

    def blobs(self, text: str) -> Iterator[bytes]:
        """Ids of a text, stretch by stretch, as little-endian unsigned 32-bit integers."""
        if self.split_special and any(name in text for name in self.special):
            for part in self.split_special(text):
                if part in self.special:
                    yield array("I", [self.special[part]]).tobytes()
                else:
                    yield from self._plain(part)
        else:
            yield from self._plain(text)

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, stretch by stretch."""
        for blob in self.blobs(text):
            yield np.frombuffer(blob, "<u4").tolist()

    def _plain(self, text: str) -> Iterator[bytes]:
        """A blank behind what is no white space always begins a piece: the text is cut there."""
        start = 0
        while start < len(text):
            edge = BOUNDARY.search(text, start + CHUNK) if len(text) - start > CHUNK else None
            end = edge.start() if edge else len(text)
            yield from self._chunk(text[start:end] if end - start < len(text) else text)
            start = end

    def _chunk(self, text: str) -> Iterator[bytes]:
        known, waiting, blank = self.known, [], ""
        parts = text.split(" ")
        last = len(parts) - 1
        for number, part in enumerate(parts):
            held = blank + part
            blank = " "
            if number < last and (not part or part[-1].isspace()):
                waiting.append(held)
                continue
            if waiting:
                waiting.append(held)
                held, waiting = "".join(waiting), []
            if held:
                ids = known.get(held)
                if ids is None:
                    yield from self._stretch(held)
                    known = self.known  # it may have been dropped
                else:
                    yield ids

    def decode(self, ids: list[int] | np.ndarray) -> Iterator[str]:
        """The text of ids; bytes that are no text become U+FFFD."""
        machine, ids = codecs.getincrementaldecoder("utf-8")("replace"), np.asarray(ids, "int64")
        for i in range(0, len(ids), AT_ONCE):
            some = ids[i : i + AT_ONCE]
            yield machine.decode(self.table[ranges(self.starts[some], self.sizes[some])].tobytes())
        yield machine.decode(b"", True)


@lru_cache(maxsize=2)
def _transducer(rules: str) -> Transducer:
    return Transducer(rules)


def transducer(rules: str) -> Transducer:
    """One transducer for each worker process and vocabulary."""
    return _transducer(rules)


ROWS = 256  # encoded or decoded at once


def encoded(batches: Iterator[pa.RecordBatch], rules: str) -> Iterator[pa.RecordBatch]:
    """Batches with ids; what was remembered is dropped at the end of the task, whose worker goes on."""
    own = transducer(rules)
    try:
        for batch in batches:
            for row in range(0, batch.num_rows, ROWS):
                part = batch.slice(row, ROWS)
                blobs = [b"".join(own.blobs(text.as_py() or "")) for text in part.column("text")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(blobs, pa.binary())], names=[*part.schema.names, "ids"])
    finally:
        own.forget()


def decoded(batches: Iterator[pa.RecordBatch], rules: str) -> Iterator[pa.RecordBatch]:
    """Batches with the text of ids."""
    own = transducer(rules)
    for batch in batches:
        for row in range(0, batch.num_rows, ROWS):
            part = batch.slice(row, ROWS)
            texts = ["".join(own.decode(np.frombuffer(x.as_py(), "<u4"))) for x in part.column("ids")]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])


def _shared(df: DataFrame, rules_path: str):
    with open(rules_path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, rules_path: str) -> DataFrame:
    """docs with ids, the token ids of text, as little-endian unsigned 32-bit integers."""
    docs = docs.drop("ids")
    shared = _shared(docs, rules_path)
    return docs.mapInArrow(freed(lambda batches: encoded(batches, shared.value)), f"{_ddl(docs)}, ids binary")


def decode(tokens: DataFrame, rules_path: str) -> DataFrame:
    """tokens with decoded, the text of ids."""
    tokens = tokens.drop("decoded")
    shared = _shared(tokens, rules_path)
    return tokens.mapInArrow(freed(lambda batches: decoded(batches, shared.value)), f"{_ddl(tokens)}, decoded string")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def digested(docs: DataFrame, rules_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, encoded and decoded again."""
    docs = docs.select("doc_id", "text")
    shared = _shared(docs, rules_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = (batch.drop_columns(["text"]) for batch in encoded(batches, shared.value))
        return decoded(tokens, shared.value)  # in the same worker, a few rows at a time

    done = docs.mapInArrow(freed(run), f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary, decoded string")
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
