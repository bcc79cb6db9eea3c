"""Token-id files in Simple-8b: 64-bit words that hold as many small ids as fit.

The top four bits of a word select how many ids of how many bits the other sixty hold. An id
of more than sixty bits is escaped: its selector is followed by a word with the id itself.
Ids are packed in blocks that start at a word of their own; a file keeps the word at which
each block starts, and the first id of each document, so that blocks are decoded alone and
a whole file by a few array operations for each selector.

File: magic, words, then a footer of block starts (words), document ids, document sizes and
a null flag each, and at the end the three counts. All numbers are little-endian 64-bit.

Defined results: a null or empty text is the end id alone. A null doc_id comes last; rows
with the same doc_id are ordered by text. An empty table gives no rows. Other columns don't
matter.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm import files
from textlake.llm.arrays import IS_SPACE, LOWER, PIECE, cut, pieces, ranges, text_bytes
from textlake.llm.bpe_stream import byte_characters
from textlake.plans.ranking import running_total
from textlake.plans.staging import new_path, stage

END = 1  # id after each document
BLOCK = 1024  # ids of a block
MAGIC = b"TLS8B\x01\0\0"
CACHED_BYTES = 48_000_000  # of words whose ids a worker remembers, and at most NEW_WORDS more
WORD_BYTES = 190  # that a remembered word takes besides its letters and ids
NEW_WORDS = 10_000  # words that are looked up at once
READ_IDS = 1_000_000  # ids that are decoded at once, or those of one document
SPACE, LETTER, DIGIT, SIGN, ODD = range(5)  # kinds of bytes
LATIN = 0xC3  # the first byte of À … ÿ, which no rule changes but the one that lowers letters
# Special tokens begin with <, and ' may begin the end of a word; both are odd
KINDS = np.full(256, ODD, "uint8")
KINDS[33:127] = SIGN
KINDS[[ord("'"), ord("<")]] = ODD
KINDS[IS_SPACE] = SPACE
KINDS[ord("0") : ord("9") + 1] = DIGIT
KINDS[ord("A") : ord("Z") + 1] = KINDS[ord("a") : ord("z") + 1] = LETTER
SHOWN = {b: c for c, b in byte_characters().items()}  # the model's character for each byte
# Ids and bits of each selector, most ids first; selector 0 is the escape
SELECTORS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_LONGEST = SELECTORS[0][0]


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, words before each block) of ids (uint64)."""
    if not len(ids):
        return np.empty(0, "uint64"), np.empty(0, "int64")
    blocks = -(-len(ids) // BLOCK)
    width = BLOCK + _LONGEST  # zeros behind a block fill its last word
    grid = np.zeros((blocks, width), "uint64")
    flat = np.zeros(blocks * BLOCK, "uint64")
    flat[: len(ids)] = ids
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    # bits of each id: exact through two halves, which floats hold
    high, low = (grid >> np.uint64(32)).astype("float64"), (grid & np.uint64(0xFFFFFFFF)).astype("float64")
    bits = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype("uint8")
    choice = np.zeros((blocks, BLOCK), "uint8")  # 0: escape
    step = np.ones((blocks, BLOCK), "int64")
    widest = {1: bits}
    size = 1
    while size * 2 <= _LONGEST:
        w = widest[size]
        widest[size * 2] = np.maximum(w[:, :-size], w[:, size:])
        size *= 2
    for number in range(len(SELECTORS) - 1, -1, -1):
        count, most = SELECTORS[number]
        half = 1 << (count.bit_length() - 1)
        w = widest[half]
        top = np.maximum(w[:, :BLOCK], w[:, count - half : count - half + BLOCK])
        fits = top <= most
        choice[fits] = number + 1
        step[fits] = count
    # all blocks step from word to word together
    filled = np.full(blocks, BLOCK)
    filled[-1] = len(ids) - (blocks - 1) * BLOCK
    place, alive, made = np.zeros(blocks, "int64"), np.arange(blocks), []
    while len(alive):
        at = place[alive]
        made.append((alive, at))
        place[alive] = at + step[alive, at]
        alive = alive[place[alive] < filled[alive]]
    block, at = (np.concatenate(x) for x in zip(*made, strict=True))
    order = np.argsort(block * width + at)
    block, at = block[order], at[order]
    kind = choice[block, at]
    words = np.zeros(len(block), "uint64")
    for number, (count, most) in enumerate(SELECTORS, 1):
        own = np.flatnonzero(kind == number)
        word = np.full(len(own), number << 60, "uint64")
        for i in range(count):
            word |= grid[block[own], at[own] + i] << np.uint64(i * most)
        words[own] = word
    escaped = kind == 0
    if escaped.any():
        # the id itself follows its selector
        room = np.cumsum(1 + escaped) - (1 + escaped)
        longer = np.zeros(len(words) + int(escaped.sum()), "uint64")
        longer[room] = words
        longer[room[escaped] + 1] = grid[block[escaped], at[escaped]]
        words, place_of = longer, room
    else:
        place_of = np.arange(len(words))
    return words, place_of[np.searchsorted(block, np.arange(blocks))]


def decode_blocks(words: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """The ids of whole blocks; starts are the words before each, count the number of ids."""
    kinds = (words >> np.uint64(60)).astype("int64")
    raw = _raw_words(np.flatnonzero(kinds == 0))
    head = np.ones(len(words), bool)
    head[raw] = False
    heads = np.flatnonzero(head)
    kinds = kinds[heads]
    counts = np.array([1, *(n for n, _ in SELECTORS)])[kinds]
    ends = np.cumsum(counts)
    # the last word of a block holds no more than the block has left
    block = np.searchsorted(starts, heads, "right") - 1
    before = np.append(0, ends)[np.searchsorted(heads, starts)]
    size = np.full(len(starts), BLOCK)
    size[-1:] = count - (len(starts) - 1) * BLOCK
    offset = block * BLOCK + (ends - counts) - before[block]
    limit = block * BLOCK + size[block]
    ids = np.zeros(count, "uint64")
    for number, (n, most) in enumerate(SELECTORS, 1):
        own = np.flatnonzero(kinds == number)
        word, mask = words[heads[own]], np.uint64((1 << most) - 1)
        for i in range(n):
            place = offset[own] + i
            fits = place < limit[own]
            ids[place[fits]] = (word[fits] >> np.uint64(i * most)) & mask
    own = np.flatnonzero(kinds == 0)
    ids[offset[own]] = words[heads[own] + 1]
    return ids


def _raw_words(escapes: np.ndarray) -> np.ndarray:
    """Places of the ids behind escapes; such an id may itself look like an escape."""
    raw: list[int] = []
    for place in escapes.tolist():
        if not raw or place != raw[-1]:
            raw.append(place + 1)
    return np.asarray(raw, "int64")


class Encoder:
    """Ids of texts by the tokenizers library, a piece at a time and each piece once.

    The file's rules never look across white space, so a text's ids are those of its words. They cut a word of
    ASCII and letters of Latin-1 into runs of letters, single digits and runs of signs, all in lower case, which
    are pieces here: the vocabulary's model alone gives their ids. A word with anything else is one piece for all rules.
    """

    def __init__(self, rules: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(rules)
        self.library.no_truncation()
        self.library.no_padding()
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0  # bytes of it, about
        self.ids = np.empty(1 << 16, "uint32")
        self.used = 0
        self.places = np.empty((1 << 16, 2), "int64")  # start and number of the ids of each piece

    def keep(self, words: list[str], ids: list[int], sizes: list[int]) -> np.ndarray:
        """Remember pieces that are not known yet, with their ids one after the other; returns their numbers."""
        first, total = len(self.known), len(ids)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while first + len(words) > len(self.places):
            self.places = np.concatenate([self.places, np.empty_like(self.places)])
        self.ids[self.used : self.used + total] = ids
        self.places[first : first + len(words), 0] = self.used + np.cumsum(np.append(0, sizes))[:-1]
        self.places[first : first + len(words), 1] = sizes
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        self.used += total
        self.held += WORD_BYTES * len(words) + 4 * total + 4 * sum(map(len, words))
        return np.arange(first, first + len(words))

    def by_model(self, words: list[str]) -> tuple[list[int], list[int]]:
        """(ids, ids of each piece) by the vocabulary's model, which reads a character for each byte."""
        ids, sizes, tokenize = [], [], self.library.model.tokenize
        for word in words:
            some = [token.id for token in tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(SHOWN))]
            ids += some
            sizes.append(len(some))
        return ids, sizes

    def by_rules(self, words: list[str]) -> tuple[list[int], np.ndarray]:
        """(ids, ids of each word) of words joined by blanks; offsets tell whose each id is."""
        found = self.library.encode(" ".join(words), add_special_tokens=False)
        begins = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
        at = np.array(found.offsets, "int64").reshape(-1, 2)[:, 0]
        return found.ids, np.bincount(np.searchsorted(begins, at, "right") - 1, minlength=len(words))

    def placed(self, words: list[str], odd: np.ndarray) -> np.ndarray:
        """Start and number of the ids of each piece; odd ones are for all rules."""
        at = np.fromiter(map(self.known.get, words, repeat(-1)), "int64", len(words))
        for mask, ids in ((~odd, self.by_model), (odd, self.by_rules)):
            new = np.flatnonzero(mask & (at < 0))
            if len(new):
                some = [words[i] for i in new.tolist()]
                at[new] = self.keep(some, *ids(some))
        return self.places[at]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids with the end id behind each text, ids of each text)."""
        data, offsets = text_bytes(texts)
        found, sizes = [np.empty(0, "uint32")], np.zeros(len(texts), "int64")
        for start, end in chunks(data):
            ids, counts = self._encode(data[start:end], np.clip(offsets, start, end) - start)
            found.append(ids)
            sizes += counts
        return np.insert(np.concatenate(found), np.cumsum(sizes), END), sizes + 1

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each text) of a chunk."""
        cells, odd, upto = split(data, offsets)
        words = cells.dictionary_encode()
        which = words.indices.to_numpy()
        is_odd = np.zeros(len(words.dictionary), bool)
        is_odd[which] = odd
        own, sizes = [np.empty(0, "uint32")], [np.empty(0, "int64")]
        for i in range(0, len(is_odd), NEW_WORDS):
            if self.held > CACHED_BYTES:
                self.clear()
            some = words.dictionary.slice(i, NEW_WORDS).to_numpy(zero_copy_only=False).tolist()
            place = self.placed(some, is_odd[i : i + NEW_WORDS])
            own.append(self.ids[ranges(place[:, 0], place[:, 1])])
            sizes.append(place[:, 1])
        ids, size = np.concatenate(own), np.concatenate(sizes)
        counts = size[which]
        ends = np.append(0, np.cumsum(counts))[upto]
        return ids[ranges((np.cumsum(size) - size)[which], counts)], np.diff(ends, prepend=0)


def chunks(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of some PIECE bytes, cut at white space."""
    start = 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        while end < len(data):
            blank = IS_SPACE[data[end : end + PIECE]]
            end += int(blank.argmax()) if blank.any() else len(blank)
            if blank.any():
                break
        yield start, end
        start = end


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(pieces, which are words for all rules, pieces up to the end of each text) of texts."""
    kind = KINDS[data]
    lead = np.flatnonzero(data[:-1] == LATIN)
    after = data[lead + 1]
    lead = lead[(after != 0x97) & (after != 0xB7)]  # multiplication and division signs
    kind[lead] = kind[lead + 1] = LETTER
    starts, ends = cut(kind != SPACE, offsets)
    if len(starts):
        odd = np.maximum.reduceat(kind, starts) == ODD
        kind[ranges(starts[odd], (ends - starts)[odd])] = ODD
    begins = kind == DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    begins[starts] = True
    solid = kind != SPACE
    first = np.flatnonzero(begins & solid)
    lowered = np.where(kind == ODD, data, LOWER[data])
    upper = lead[(kind[lead] == LETTER) & (data[lead + 1] < 0x9F)] + 1
    lowered[upper] += 0x20
    lowered = lowered[solid]
    at = np.append(np.flatnonzero(begins[solid]), len(lowered))
    cells = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(at), pa.py_buffer(lowered)])
    return cells, kind[first] == ODD, np.searchsorted(first, offsets[1:])


_ENCODERS: dict[int, Encoder] = {}


def encoder(rules: str) -> Encoder:
    """One encoder for each worker process and rule file."""
    key = zlib.crc32(rules.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(rules)
    return _ENCODERS[key]


def write_tokens(docs: DataFrame, rules_path: str) -> DataFrame:
    """Write ids in ascending doc_id order; returns the written list of files.

    (path, part, ids, docs): parts are ascending ranges of doc_id, each one file.
    """
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")
    with open(rules_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange(parts, *order[:1]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first = encoder(shared.value), next(batches, None)
        if first is None:
            return
        left, starts, doc_ids, sizes, nulls, words_out, total = np.empty(0, "uint64"), [], [], [], [], 0, 0
        with files.new_file(folder, ".s8b") as (path, stream):
            stream.write(MAGIC)

            def put(ids: np.ndarray) -> None:
                nonlocal words_out
                words, begins = encode_blocks(ids)
                stream.write(words.astype("<u8").tobytes())
                starts.append(begins + words_out)
                words_out += len(words)

            while first is not None:
                _, offsets = text_bytes(first.column("text"))
                for row, upto in pieces(offsets):
                    ids, counts = own.encode(first.column("text").slice(row, upto - row))
                    sizes.append(counts)
                    total += len(ids)
                    left = np.append(left, ids.astype("uint64"))
                    whole = len(left) // BLOCK * BLOCK
                    put(left[:whole])
                    left = left[whole:]
                column = first.column("doc_id")
                doc_ids.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                nulls.append(np.asarray(column.is_null()).astype("<i8"))
                first = next(batches, None)
            put(left)
            footer = [np.concatenate(x).astype("<i8") for x in (starts, doc_ids, sizes, nulls)]
            for part in footer:
                stream.write(part.tobytes())
            stream.write(np.array([len(footer[0]), len(footer[1]), words_out], "<i8").tobytes())
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"path": [path], "part": [part], "ids": [total], "docs": [len(footer[1])]})

    return stage(rows.mapInArrow(run, "path string, part bigint, ids bigint, docs bigint"), "token-files")


def read_file(path: str, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, document ids, document sizes, which document ids are null) of a file's documents in order.

    A part has documents of `most` ids together (READ_IDS) or a single one, and reads the blocks that hold them.
    """
    most = READ_IDS if most is None else most
    with files.open_input(path) as file:
        if file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is no token file")
        blocks, docs, count = np.frombuffer(file.read_at(24, file.size() - 24), "<i8").tolist()
        rest = np.frombuffer(file.read_at(8 * (blocks + 3 * docs), 8 + 8 * count), "<i8")
        starts, doc_ids, sizes, nulls = np.split(rest, [blocks, blocks + docs, blocks + 2 * docs])
        begins, offsets = np.append(starts, count), np.append(0, np.cumsum(sizes))
        for row, upto in pieces(offsets, most):
            zero, end = offsets[row], offsets[upto]
            first, last = zero // BLOCK, -(-end // BLOCK)
            words = np.frombuffer(file.read_at(8 * int(begins[last] - begins[first]), 8 + 8 * int(begins[first])), "<u8")
            ids = decode_blocks(words, starts[first:last] - begins[first], int(min(last * BLOCK, offsets[-1]) - first * BLOCK))
            yield ids[zero - first * BLOCK : end - first * BLOCK], doc_ids[row:upto], sizes[row:upto], nulls[row:upto].astype(bool)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, n_tokens, ids) of the documents of files, from their paths and starts."""
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            for ids, doc_ids, sizes, nulls in read_file(path):
                ends = np.append(0, np.cumsum(sizes))
                lists = pa.ListArray.from_arrays(ends.astype("int32"), ids.view("int64"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=nulls), pa.array(start + ends[:-1]), pa.array(sizes), lists], names=["doc_id", "start", "n_tokens", "ids"]
                )
                start += ends[-1]


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, n_tokens, ids_crc32) of read documents."""
    for batch in batches:
        column = batch.column("ids")
        values, at = column.values.to_numpy().astype("<u4"), column.offsets.to_numpy()
        sums = [zlib.crc32(values[at[i] : at[i + 1]].tobytes()) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=[*batch.schema.names[:3], "ids_crc32"])


def _placed(listed: DataFrame) -> DataFrame:
    """(path, start) of every file, dealt over the tasks."""
    placed = running_total(listed, ["part"], F.col("ids"), out="_upto").select("path", (F.col("_upto") - F.col("ids")).alias("start"))
    return placed.repartition(max(1, listed.sparkSession.sparkContext.defaultParallelism), "path")


def read_tokens(listed: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files."""
    return _placed(listed).mapInArrow(_documents, "doc_id bigint, start bigint, n_tokens bigint, ids array<bigint>")


def checked_tokens(listed: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files: read and summed in one worker."""
    return _placed(listed).mapInArrow(lambda batches: _checked(_documents(batches)), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def written_tokens(docs: DataFrame, rules_path: str) -> DataFrame:
    return checked_tokens(write_tokens(docs, rules_path))
