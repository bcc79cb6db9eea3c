"""Exact repeated passages by suffix arrays.

A byte is removed if a string of 50 bytes that covers it also starts in a document with a
smaller doc_id. Strings of 50 bytes (windows) that repeat are found in three steps.

1. Every window is named by the least hash among its 16-byte strings; equal windows have equal
   names, and neighbouring windows mostly share one. Shards ask which names occur in more
   than one document; all other windows are unique and need no sorting.
2. Runs of windows with one shared name are sent, as their bytes, to the sorter of that name.
   A name with very many runs is split: its windows are dealt out one by one, each by a hash of
   its own bytes. Equal strings of a shard are sent once, with their smallest doc_id.
3. A sorter takes its strings in blocks that fit a processor's cache, by name. Each block gets a
   suffix array by Larsson-Sadakane refinement, and common prefixes by Kasai's method; windows
   whose suffixes share 50 bytes are equal. Names too large for a block get several, which are
   merged by binary search of each block's distinct windows among the others'; other blocks have
   no window in common. Every shard learns where a smaller doc_id has its windows.

Defined results: a null or empty text has nothing to remove, nor has one of less than 50
bytes. Matches don't cross documents. Rows with the same doc_id don't remove each other's
bytes; a null doc_id counts as larger than any other. Columns named like the new ones are
replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.arrays import (
    ODD_A, ODD_B, ODD_C, cut, mix, packed, pieces, range_hashes, ranges, row_ids, text_bytes, unpacked,
)
from textlake.llm.columns import carried
from textlake.llm.memory import freed_group
from textlake.llm.shards import answered, answers_of, ask, ddl, packed_shards, ranges_of, totals
from textlake.plans.staging import stage

WINDOW = 50  # bytes of a repeated string
GRAM = 16  # bytes that name a window
CROWDED = 2000  # a name with more runs of windows is split by window
BLOCK = 200_000  # bytes sorted at once
PART = 50_000  # places named or hashed at once, so that their arrays stay in a processor's cache
NEVER = np.iinfo("int64").max


def words_at(data: np.ndarray, n: int) -> np.ndarray:
    """The 8 bytes from each of n places as a number; data goes 8 bytes farther at least."""
    return np.ndarray((n,), dtype="<u8", buffer=data, strides=(1,)).copy()


def window_names(data: np.ndarray) -> np.ndarray:
    """The name of the window at each place of data (uint8); empty if there is no window."""
    n = len(data) - WINDOW + 1
    names = np.empty(max(n, 0), "uint64")
    for at in range(0, n, PART):
        names[at : at + PART] = _names(data[at : at + PART + WINDOW - 1])
    return names


def _names(data: np.ndarray) -> np.ndarray:
    eight = words_at(np.append(data, np.zeros(8, "uint8")), len(data) - 7)
    least = eight[:-8] * ODD_A
    least ^= least >> np.uint64(32)
    least *= ODD_B
    least += eight[8:] * ODD_C
    least ^= least >> np.uint64(29)
    least *= ODD_A
    least ^= least >> np.uint64(32)
    size, wanted = 1, WINDOW - GRAM + 1
    while size < wanted:
        step = min(size, wanted - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return least


# ---------------------------------------------------------------- suffix arrays


def suffix_array(data: np.ndarray) -> np.ndarray:
    """The suffixes in order.

    Larsson and Sadakane: after h bytes are sorted, each unsorted group is refined by the
    groups of the suffixes h bytes on, which doubles h. Groups are numbered by their last place;
    sorted suffixes are left alone. A suffix that ends is smaller than one that goes on.
    """
    n = len(data)
    padded = np.append(data.astype("uint8"), np.zeros(8, "uint8"))
    # the first seven bytes, and how many there are, as one number
    first = words_at(padded, n).byteswap() & np.uint64(0xFFFFFFFFFFFFFF00)
    first |= np.minimum(np.arange(n, 0, -1), 7).astype("uint64")
    order = np.argsort(first)
    ordered = first[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    group = np.empty(n + 1, "int64")
    group[n] = -1  # behind the end
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n) - 1
    group[order] = np.repeat(ends, ends - starts + 1)
    unsorted = np.flatnonzero(np.repeat(ends > starts, ends - starts + 1))  # places, not suffixes
    h = 7
    while len(unsorted):
        suffix = order[unsorted]
        own = group[suffix]
        behind = group[np.minimum(suffix + h, n)]
        inside = np.argsort(own * (n + 1) + behind + 1)
        suffix, own, behind = suffix[inside], own[inside], behind[inside]
        order[unsorted] = suffix
        last = np.append((own[1:] != own[:-1]) | (behind[1:] != behind[:-1]), True)
        ends = np.flatnonzero(last)
        sizes = np.diff(ends, prepend=-1)
        group[suffix] = np.repeat(unsorted[ends], sizes)
        unsorted = unsorted[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int = WINDOW, lanes: int = 8) -> np.ndarray:
    """Common prefix, up to `most` bytes, of each suffix in order with the one before it.

    Kasai: the suffix one byte on shares at least one byte less with its predecessor, if what
    follows both is in order too, which may leave suffixes out. The suffixes are gone through as
    in the text, in lanes side by side, each of `lanes` suffixes, carrying what is known.
    """
    n = len(data)
    eight = words_at(np.append(data, np.zeros(most + 16, "uint8")), n + most + 8)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    listed = np.zeros(n + 1, bool)
    listed[order] = True
    place = np.flatnonzero(listed)
    other = before[place]
    carries = listed[place + 1] & listed[other + 1]
    room = np.where(other < 0, 0, np.minimum(n - np.maximum(place, other), most))  # bytes up to the end
    found = np.zeros(len(place), "int64")
    known = np.zeros(-(-len(place) // lanes), "int64")
    for step in range(lanes):
        at, to, end = place[step::lanes], other[step::lanes], room[step::lanes]
        known = known[: len(at)]
        going = np.flatnonzero(known < end)
        while len(going):
            have = known[going]
            differ = eight[at[going] + have] ^ eight[to[going] + have]
            # equal bytes from the lowest on: eight if nothing differs
            equal = (np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3).astype("int64")
            have += equal
            known[going] = have
            going = going[(equal == 8) & (have < end[going])]
        known = np.minimum(known, end)
        found[step::lanes] = known
        known = np.maximum(known - 1, 0) * carries[step::lanes]
    shared = np.zeros(n, "int64")
    shared[place] = found
    return shared[order]


class Block:
    """Strings sorted together: their windows by class, each with its smallest document."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> None:
        """data: the strings one after the other; sizes: their bytes; docs: their documents."""
        ends = np.cumsum(sizes)
        self.begins, self.windows = ends - sizes, sizes - WINDOW + 1
        window = np.zeros(len(data), bool)
        window[ranges(self.begins, self.windows)] = True
        order = suffix_array(data)
        order = order[window[order]]  # only suffixes that start a window count
        new = common_prefixes(data, order) < WINDOW
        new[:1] = True
        self.place = np.full(len(data), -1)  # class of the window at each place
        self.place[order] = np.cumsum(new) - 1
        owner = np.repeat(docs, sizes)
        starts = np.flatnonzero(new)
        self.least = np.minimum.reduceat(owner[order], starts) if len(order) else np.empty(0, "int64")
        self.heads = windows_at(data, order[starts])


def windows_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The windows at some places as fixed-size byte strings, which sort like their bytes."""
    grid = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places] if len(places) else np.empty((0, WINDOW), "uint8")
    return np.ascontiguousarray(grid).view(f"S{WINDOW}").reshape(-1)


def merge(blocks: list[Block]) -> None:
    """Give every class of every block the smallest document over all blocks, by binary search."""
    known = [(b.heads, b.least) for b in blocks]
    while len(known) > 1:  # two and two: a window moves log2(blocks) times
        known = [_joined(*known[i : i + 2]) for i in range(0, len(known), 2)]
    keys, least = known[0]
    for b in blocks:
        b.least = least[np.searchsorted(keys, b.heads)]


def _joined(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The windows of two blocks in order, each once, with its smaller document."""
    if two is None:
        return one
    keys, least = one[0], one[1].copy()
    at = np.searchsorted(keys, two[0])
    same = at < len(keys)
    same[same] = keys[at[same]] == two[0][same]
    least[at[same]] = np.minimum(least[at[same]], two[1][same])
    return np.insert(keys, at[~same], two[0][~same]), np.insert(least, at[~same], two[1][~same])


# ---------------------------------------------------------------- shards


class Shard:
    """The windows of a shard's documents, by name."""

    def __init__(self, docs: pa.Table, text: str = "text") -> None:
        self.data, self.offsets = text_bytes(docs.column(text))
        self.ids = row_ids(docs.column("doc_id"))
        names, starts, sizes, rows = [], [], [], []
        for first, last in pieces(self.offsets):
            begin, end = self.offsets[first], self.offsets[last]
            name = window_names(self.data[begin:end])
            if not len(name):
                continue
            place = self.offsets[first : last + 1] - begin
            # places where a window fits into its document
            lengths = np.maximum(np.diff(place) - WINDOW + 1, 0)
            inside = np.zeros(len(name), bool)
            inside[ranges(place[:-1], lengths)] = True
            new = np.append(True, name[1:] != name[:-1])
            new[place[:-1][lengths > 0]] = True
            run = np.flatnonzero(new & inside)
            row = np.searchsorted(place, run, "right") - 1
            stop = np.minimum(np.append(run[1:], len(name)), place[row] + lengths[row])
            names.append(mix(name[run]))  # least hashes are small: spread them over all key ranges
            starts.append(run + begin)
            sizes.append(stop - run)
            rows.append(row + first)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        self.name, self.start = join(names, "uint64"), join(starts, "int64")
        self.windows, self.row = join(sizes, "int64"), join(rows, "int64")
        self.names, self.number = np.unique(self.name, return_inverse=True)

    def questions(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each name with its runs, and whether they are of several documents."""
        runs = np.bincount(self.number, minlength=len(self.names))
        low, high = np.full(len(self.names), NEVER), np.full(len(self.names), -NEVER)
        own = self.ids[self.row]
        np.minimum.at(low, self.number, own)
        np.maximum.at(high, self.number, own)
        return [(self.names, runs.astype("uint64") << np.uint64(1) | (low != high).astype("uint64"))]


KINDS = ["uint8"]  # 0: in one document, 1: in several, 2: in several and crowded


def _answer(topic: int, keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, list[int]]:
    runs, places = totals(keys, numbers >> np.uint64(1))
    several, _ = totals(keys, numbers & np.uint64(1))
    shared = (places > 1) | (several > 0)
    return shared.astype("uint8") + (shared & (runs > CROWDED)).astype("uint8"), []


class Strings:
    """The strings that a shard sends, distinct, by sorter; and where they occur."""

    def __init__(self, shard: Shard, state: np.ndarray, sorters: int) -> None:
        kind = state[shard.number] if len(shard.number) else np.empty(0, "uint8")
        plain, split = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
        single = ranges(shard.start[split], shard.windows[split])
        start = np.append(shard.start[plain], single)
        windows = np.append(shard.windows[plain], np.ones(len(single), "int64"))
        row = np.append(shard.row[plain], np.repeat(shard.row[split], shard.windows[split]))
        one, two = self.hashes(shard.data, start, start + windows + WINDOW - 1)
        route = np.append(shard.name[plain], one[len(plain) :])
        # one of the equal strings is sent, with the smallest document
        number, head, least = distinct(one, two, shard.ids[row])
        route = mix(route[head])
        sorter = (route % np.uint64(sorters)).astype("int64")
        by_sorter = np.argsort(sorter, kind="stable")
        rank = np.empty(len(head), "int64")
        rank[by_sorter] = np.arange(len(head))
        self.number, self.start, self.windows = rank[number], start, windows
        head = head[by_sorter]
        self.sorter, self.head, self.size = sorter[by_sorter], start[head], windows[head]
        self.route = (route >> np.uint64(48)).astype("uint16")[by_sorter]
        self.least = least[by_sorter]

    @staticmethod
    def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each string, from bounded pieces of the data."""
        one, two = np.empty(len(starts), "uint64"), np.empty(len(starts), "uint64")
        order = np.argsort(starts)
        ordered, at = starts[order], 0
        while at < len(order):
            begin = ordered[at]
            upto = int(np.searchsorted(ordered, begin + PART, "right"))
            some = order[at:upto]
            stop = ends[some].max()
            part = data[begin:stop]
            one[some] = range_hashes(part, starts[some] - begin, ends[some] - begin)
            two[some] = range_hashes(part, starts[some] - begin, ends[some] - begin, OTHER_CODES)
            at = upto
        return one, two


OTHER_CODES = mix(np.arange(1, 257, dtype="uint64") * ODD_C)


def distinct(one: np.ndarray, two: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings by their two hashes: the number of each, and of each number a string and the smallest document."""
    order = np.argsort(one)
    new = np.append(True, one[order][1:] != one[order][:-1])[: len(order)]
    other = np.append(True, two[order][1:] != two[order][:-1])[: len(order)]
    if (other & ~new).any():  # the first hash alone doesn't tell some strings apart
        order = np.lexsort((two, one))
        new = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]))
    number = np.empty(len(order), "int64")
    number[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return number, order[first], np.minimum.reduceat(docs[order], first) if len(order) else docs


def _send(shard: Shard, strings: Strings, name: int) -> Iterator[dict]:
    some = np.unique(strings.sorter)
    edges = np.searchsorted(strings.sorter, np.append(some, NEVER))
    for sorter, first, last in zip(some, edges[:-1], edges[1:], strict=True):
        own = slice(first, last)
        data = shard.data[ranges(strings.head[own], strings.size[own] + WINDOW - 1)]
        yield {
            "sorter": int(sorter), "shard": name, "data": packed(data),
            "sizes": packed((strings.size[own] + WINDOW - 1).astype("int64")), "docs": packed(strings.least[own]),
            "routes": packed(strings.route[own]),
        }


def blocks_of(routes: np.ndarray, sizes: np.ndarray) -> Iterator[list[slice]]:
    """Strings in order of their routes, cut into blocks of whole routes; several for a route that is too large for one."""
    total = np.append(0, np.cumsum(sizes))
    edges = np.append(np.flatnonzero(np.append(True, routes[1:] != routes[:-1])), len(routes))
    bytes_to = total[edges]
    at = 0
    while at < len(edges) - 1:
        fits = int(np.searchsorted(bytes_to, bytes_to[at] + BLOCK, "right")) - 1
        upto = max(fits, at + 1)
        cuts = [edges[at]]
        while cuts[-1] < edges[upto]:
            stop = int(np.searchsorted(total, total[cuts[-1]] + BLOCK, "right")) - 1
            cuts.append(min(max(stop, cuts[-1] + 1), edges[upto]))
        yield [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        at = upto


def _sorted(rows: pa.Table) -> pa.Table:
    """For each shard of a sorter: (string, first window, windows, smallest document) where it is not the shard's own."""
    shards = rows.column("shard").to_pylist()
    parts = lambda c, kind: [unpacked(x.as_buffer(), kind) for x in rows.column(c)]
    sizes, docs = parts("sizes", "int64"), parts("docs", "int64")
    upto = np.cumsum([0, *map(len, sizes)])
    data, sizes, docs = np.concatenate(parts("data", "uint8")), np.concatenate(sizes), np.concatenate(docs)
    routes = np.concatenate(parts("routes", "uint16"))
    begins = np.cumsum(sizes) - sizes
    # equal strings of several shards are sorted once, with their smallest document
    number, head, lowest = distinct(*Strings.hashes(data, begins, begins + sizes), docs)
    # equal windows have equal routes
    by_route = np.argsort(routes[head], kind="stable")
    rank = np.empty(len(head), "int64")
    rank[by_route] = np.arange(len(head))
    number, head, lowest = rank[number], head[by_route], lowest[by_route]
    # runs of windows of one string with the same smallest document
    runs, base = [], 0
    for some in blocks_of(routes[head], sizes[head]):
        blocks = [Block(data[ranges(begins[head[x]], sizes[head[x]])], sizes[head[x]], lowest[x]) for x in some]
        if len(blocks) > 1:
            merge(blocks)
        for b in blocks:
            string = np.repeat(np.arange(len(b.begins)), b.windows)
            place = ranges(b.begins, b.windows)
            least = b.least[b.place[place]]
            first = np.flatnonzero(np.append(True, (string[1:] != string[:-1]) | (least[1:] != least[:-1])))
            runs.append((string[first] + base, (place - b.begins[string])[first], np.diff(np.append(first, len(string))), least[first]))
            base += len(b.begins)
    string, offset, length, least = (np.concatenate(x) for x in zip(*runs, strict=True))
    times = np.bincount(string, minlength=len(head))
    starts = np.cumsum(times) - times
    which = ranges(starts[number], times[number])
    owner = np.repeat(np.arange(len(number)), times[number])
    smaller = least[which] < docs[owner]
    which, owner = which[smaller], owner[smaller]
    edges = np.searchsorted(owner, upto)
    found = []
    for k, shard in enumerate(shards):
        some = slice(edges[k], edges[k + 1])
        if some.stop > some.start:
            w = which[some]
            numbers = (owner[some] - upto[k], offset[w], length[w], least[w])
            found.append((shard, rows.column("sorter")[0].as_py(), *(packed(x.astype("int64")) for x in numbers)))
    names = ["shard", "part", "string", "offset", "length", "least"]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
    columns = list(zip(*found, strict=True)) if found else [[]] * 6
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


REPLY = "shard bigint, part bigint, string binary, offset binary, length binary, least binary"


def _covered(shard: Shard, strings: Strings, replies: pa.Table) -> np.ndarray:
    """Which bytes of the shard are removed."""
    least = np.full(len(shard.data), NEVER)  # smallest document of the window at each place
    # a string's own smallest document first, then what the sorters know
    where = ranges(strings.start, strings.windows)
    least[where] = np.repeat(strings.least[strings.number], strings.windows)
    occurrences = np.argsort(strings.number, kind="stable")
    counts = np.bincount(strings.number, minlength=len(strings.head))
    begins = np.cumsum(counts) - counts
    by_sorter = np.append(0, np.cumsum(np.bincount(strings.sorter, minlength=1)))
    for row in replies.to_pylist():
        string, offset, length, doc = (unpacked(row[c], "int64") for c in ("string", "offset", "length", "least"))
        string = string + by_sorter[row["part"]]
        times = counts[string]
        which = occurrences[ranges(begins[string], times)]
        start = strings.start[which] + np.repeat(offset, times)
        size = np.repeat(length, times)
        least[ranges(start, size)] = np.repeat(np.repeat(doc, times), size)
    owner = np.repeat(shard.ids, np.diff(shard.offsets))
    starts = np.flatnonzero(least < owner)
    edge = np.zeros(len(shard.data) + 1, "int8")  # no more than WINDOW windows cover a byte
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return np.cumsum(edge[:-1], dtype="int8") > 0


def repeated(docs: DataFrame, readable: bool = False) -> DataFrame:
    """docs with spans (begin, end of removed bytes), kept (what remains) as bytes.

    readable: kept is text, without the characters that are cut at the edge of a removed passage.
    """
    docs = docs.drop("spans", "kept")
    shards = packed_shards(docs)
    sorters = 2 * ranges_of(docs)
    replies = ask(shards, lambda d: Shard(d).questions(), _answer, KINDS)

    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(table)
        rows = []
        if len(shard.names):
            strings = Strings(shard, answers_of(answers, KINDS)[0], sorters)
            rows = list(_send(shard, strings, answers.column("shard")[0].as_py()))
        return pa.Table.from_pylist(rows, SENT)

    sent = answered(shards, replies, send, "sorter bigint, shard bigint, data binary, sizes binary, docs binary, routes binary")
    sorted_ = stage(sent.groupBy("sorter").applyInArrow(freed_group(_sorted), REPLY), "sorted")
    # both kinds of answers reach the shard together
    names = replies.selectExpr("shard", "cast(part as bigint) part", "topic", "answer").where("shard is not null")
    both = names.unionByName(sorted_, allowMissingColumns=True)
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(table)
        known = answers.filter(answers.column("topic").is_valid())
        gone = np.zeros(len(shard.data), bool)
        if len(shard.names):
            strings = Strings(shard, answers_of(known, KINDS)[0], sorters)
            gone = _covered(shard, strings, answers.filter(answers.column("topic").is_null()))
        begins, ends = cut(gone, shard.offsets)
        row = np.searchsorted(shard.offsets, begins, "right") - 1
        zero = shard.offsets[row]
        pairs = pa.StructArray.from_arrays([pa.array(begins - zero), pa.array(ends - zero)], names=["begin", "end"])
        lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(np.bincount(row, minlength=len(shard.ids)))).astype("int32"), pairs)
        kept = [shard.data[a:b][~gone[a:b]].tobytes() for a, b in zip(shard.offsets[:-1], shard.offsets[1:], strict=True)]
        if readable:  # here, because another function would take another worker for each task
            kept = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())
        else:
            kept = pa.array(kept, pa.binary())
        return table.append_column("spans", lists.cast(span)).append_column("kept", kept)

    kind = "string" if readable else "binary"
    return answered(shards, both, remove, f"{ddl(docs)}, spans array<struct<begin: bigint, end: bigint>>, kept {kind}")


SENT = pa.schema([("sorter", pa.int64()), ("shard", pa.int64()), *((c, pa.binary()) for c in ("data", "sizes", "docs", "routes"))])


def repeated_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row per document."""
    found = repeated(docs.select("doc_id", "text"))
    left, size = F.octet_length("kept"), F.coalesce(F.octet_length("text"), F.lit(0))
    return found.select(
        "doc_id", size.cast("bigint").alias("n_bytes"), (size - left).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def drop_repeated(docs: DataFrame) -> DataFrame:
    """docs without repeated passages; n_chars, if there, is that of the text that remains.

    Characters that are cut at the edge of a removed passage go with it; a null text stays null.
    Other columns are kept, whatever their names.
    """
    return carried(docs, ("doc_id", "text", "n_chars"), _without_repeated)


def _without_repeated(docs: DataFrame) -> DataFrame:
    found = repeated(docs, readable=True)
    text = F.when(F.size("spans") > 0, F.col("kept")).otherwise(F.col("text"))
    found = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        chars = F.when(F.size("spans") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return found
