"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation.

Documents with the same set of word shingles form one class. Classes that agree in a whole
band of MinHash samples are candidates; an odd sketch, the parities of the hashed samples
in a bitmap, estimates their similarity from the population count of an exclusive or and
drops pairs that are far off. What is left is confirmed on the full sets.

Candidates are settled in three rounds, so that not all pairs of a bucket are formed. First every
class is compared with the likest of its buckets' first classes, which joins the many copies of
a text; then with those of the other first classes that it isn't joined with yet. Last, in
buckets that still hold several components, the classes outside the first one's component
are compared with the rest, block by block on both sides: a task confirms on the full sets of its
two blocks, joins components as it goes and returns only links that join some. No pair that could
join two components is left out.

Defined results: null, empty or blank texts have no shingles and are linked with nothing; a
text with fewer words than a shingle is one shingle. Rows with equal sets, repeated rows
included, are linked; ties go to the smallest doc_id. A null doc_id counts as larger than
any other. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.arrays import ODD_A, mix, pieces, ranges, spreads, text_bytes, words
from textlake.llm.columns import carried
from textlake.llm.graph import components
from textlake.llm.memory import freed, freed_cogroup
from textlake.plans.staging import stage

WORDS = 5  # words of a shingle
SIMILARITY = 80  # percent of the union that two linked sets share
BANDS, ROWS = 24, 5  # a pair at 0.8 is missed with probability 0.00007, at 0.85 with 0.0000008
BINS, BITS = 256, 512  # samples that an odd sketch folds, and its bits
ALL_BITS = 1024  # of the odd sketch of the whole set, which is sharp for all but long texts
BLOCK = 512  # classes of a bucket that are compared with as many others of it at once
BLOCK_BYTES = 16_000_000  # of their shingle sets; a larger set is a block of its own, about

_SAMPLES = BANDS * ROWS
_FACTORS = spreads(_SAMPLES, 101) | np.uint64(1)
_SHIFTS = spreads(_SAMPLES, 202)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, sorted and distinct within a text; offsets by text)."""
    texts = len(offsets) - 1
    hashes, text, _ = words(data, offsets)
    count = np.bincount(text, minlength=texts)
    first = np.cumsum(count) - count
    made = np.where(count >= size, count - size + 1, 0)
    at = ranges(first, made)
    whole = np.zeros(len(at), "uint64")
    factors = spreads(size, 33) | np.uint64(1)
    for i in range(size):
        whole += mix(hashes[at + i] * factors[i])
    owner = np.repeat(np.arange(texts), made)
    few = np.flatnonzero((count > 0) & (count < size))
    short = np.zeros(len(few), "uint64")
    for i in range(size - 1):
        has = count[few] > i
        short[has] += mix(hashes[first[few[has]] + i] * factors[i])
    short = mix(short + count[few].astype("uint64"))
    whole, owner = np.append(mix(whole), short), np.append(owner, few)
    order = np.lexsort((whole, owner))
    whole, owner = whole[order], owner[order]
    new = np.ones(len(whole), bool)
    new[1:] = (whole[1:] != whole[:-1]) | (owner[1:] != owner[:-1])
    return whole[new], np.cumsum(np.append(0, np.bincount(owner[new], minlength=texts)))


def signatures(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band values, odd sketches as 64-bit words) of non-empty sets."""
    texts = len(offsets) - 1
    bands = np.zeros((texts, BANDS), "uint64")
    for k in range(_SAMPLES):
        least = np.minimum.reduceat(sets * _FACTORS[k] + _SHIFTS[k], offsets[:-1]) if texts else np.empty(0, "uint64")
        bands[:, k // ROWS] = mix(bands[:, k // ROWS] ^ mix(least + _SHIFTS[k]))
    # for the sketch, one MinHash sample from each of many ranges of hashes: sets are sorted, so
    # a range's least hash is its first
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    which = sets >> np.uint64(64 - BINS.bit_length() + 1)
    new = np.ones(len(sets), bool)
    new[1:] = (which[1:] != which[:-1]) | (owner[1:] != owner[:-1])
    bit = (mix(sets ^ ODD_A) >> np.uint64(20)).astype("int64")
    parts = []
    for some, size in ((new, BITS), (slice(None), ALL_BITS)):
        odd = np.bincount(owner[some] * size + bit[some] % size, minlength=texts * size) & 1
        parts.append(np.packbits(odd.astype("uint8").reshape(texts, size), axis=1, bitorder="little").view("<u8").reshape(texts, size // 64))
    return bands, np.concatenate(parts, axis=1)


def most_different(samples, similarity: int, root):
    """Bits in which the sketches of a linked pair differ at most, but for a chance below 1e-6.

    Each of the samples differs with probability 1 - J and then changes at most two bits.
    """
    p = 1 - similarity / 100
    return 2 * (samples * p + 5 * root(samples * p * (1 - p)) + 1)


def most_apart(total, similarity: int):
    """Shingles that are in one of two linked sets only, at most, by their sizes' total.

    Each flips one bit of the whole sets' sketches, so that no linked pair differs in more.
    """
    return total * (100 - similarity) / (100 + similarity)


_SETS = "doc_id bigint, n_shingles bigint, node binary, bands array<bigint>, sketch array<bigint>"


def _node(sets: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each set."""
    filled = np.flatnonzero(np.diff(offsets))
    names: list[bytes | None] = [None] * (len(offsets) - 1)
    if len(filled):
        one = np.add.reduceat(mix(sets), offsets[filled])
        two = np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), offsets[filled])
        both = np.stack([one, two], axis=1).astype(">u8")
        for i, name in zip(filled, both, strict=True):
            names[i] = name.tobytes()
    return names


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, bands, sketch); node names the set and is null if it is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in pieces(offsets):
                begin = offsets[first]
                sets, at = shingle_sets(data[begin : offsets[last]], offsets[first : last + 1] - begin)
                sizes = np.diff(at)
                filled = np.flatnonzero(sizes)
                bands, sketch = signatures(sets, np.append(at[filled], at[-1]))
                spots = np.zeros(last - first, "int64")
                spots[filled] = 1
                lists = lambda x, n=spots: pa.ListArray.from_arrays(
                    np.append(0, np.cumsum(n * x.shape[1])).astype("int32"), x.astype("int64", copy=False).view("int64").reshape(-1)
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(sizes), pa.array(_node(sets, at), pa.binary()), lists(bands.view("int64")), lists(sketch.view("int64"))],
                    names=["doc_id", "n_shingles", "node", "bands", "sketch"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(freed(run), _SETS)


def _alike(one: str, two: str, similarity: int):
    """Whether two classes (n, sketch) may be as similar by sizes and sketches, and how far they are."""
    n, m = F.col(f"{one}.n"), F.col(f"{two}.n")
    bits = F.zip_with(f"{one}.sketch", f"{two}.sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    total = lambda part: F.aggregate(part, F.lit(0), lambda s, x: s + x)
    sampled, whole = total(F.slice(bits, 1, BITS // 64)), total(F.slice(bits, BITS // 64 + 1, ALL_BITS // 64))
    near = (sampled <= most_different(F.least(n + m, F.lit(BINS)), similarity, F.sqrt)) & (whole <= most_apart(n + m, similarity))
    return (100 * F.least(n, m) >= similarity * F.greatest(n, m)) & near, sampled + whole


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted (doc_id, node), from the whole texts; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in pieces(offsets):
                begin = offsets[first]
                sets, at = shingle_sets(data[begin : offsets[last]], offsets[first : last + 1] - begin)
                blobs = [sets[at[i] : at[i + 1]].tobytes() for i in range(last - first)]
                yield pa.RecordBatch.from_pydict({"node": pa.array(_node(sets, at), pa.binary()), "shingles": pa.array(blobs, pa.binary())})

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    asked = wanted.select(F.col("doc_id").alias("_asked"))
    texts = texts.join(asked.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_asked")), "left_semi")
    found = texts.select("text").mapInArrow(freed(run), "node binary, shingles binary")
    # an id may repeat with other texts: keep the sets asked for, each once
    found = found.join(wanted.select("node"), "node", "left_semi")
    return stage(found.groupBy("node").agg(F.first("shingles").alias("shingles")), "shingle-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets share enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "uint64"), np.frombuffer(y.as_buffer(), "uint64")
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(freed(run), "a binary, b binary")


def _across(members: DataFrame, similarity: int, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Confirmed links (a, b) of a bucket's classes that join all components its pairs can join.

    members: (band, value, node, n, sketch, root, outside, first); fetch gives the (node,
    shingles) of a table of nodes. Classes outside the first one's component are dealt out in
    blocks, by number and by bytes, and so is all of the bucket; each block meets each, in a task
    of two blocks, which compares the full sets of what sketches leave. A pair of blocks gives a
    forest: fewer links than it has classes. Two blocks that lie in the same component alone do
    not meet.
    """
    # the first class has met all others
    rest = members.where("not first")
    blocks = lambda rows, shingles: F.ceil(F.greatest(F.count(rows) / BLOCK, F.sum(shingles) * 8 / BLOCK_BYTES))
    outer = F.when(F.col("outside"), F.col("n"))
    sizes = rest.groupBy("band", "value").agg(blocks("n", "n").alias("all"), blocks(outer, outer).alias("out"))
    dealt = rest.join(stage(sizes.where("out > 0"), "bucket-sizes"), ["band", "value"])
    block = lambda count, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(count)).cast("int")
    dealt = stage(dealt.withColumn("left", F.when(F.col("outside"), block("out", 1))).withColumn("right", block("all", 2)), "dealt")
    span = [F.min("root").alias("low"), F.max("root").alias("high")]
    lefts = dealt.where("outside").groupBy("band", "value", "left").agg(*span)
    rights = dealt.groupBy("band", "value", "right").agg(*span).withColumnsRenamed({"low": "_low", "high": "_high"})
    met = lefts.join(rights, ["band", "value"]).where("low <> high or _low <> _high or low <> _low")
    met = stage(met.select("band", "value", "left", "right"), "block-pairs")
    left = dealt.where("outside").drop("right").join(met, ["band", "value", "left"])
    right = dealt.drop("left").join(met, ["band", "value", "right"])
    sets = fetch(left.select("node").union(right.select("node")).distinct())

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        a, b = forest(one, two, similarity) if one.num_rows and two.num_rows else ([], [])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    keys = ["band", "value", "left", "right"]
    columns = [*keys, "node", "root", "n", "sketch", "shingles"]
    # renamed, because both sides come from one table
    left, right = (side.join(sets, "node").select(columns).toDF(*columns) for side in (left, right))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(freed_cogroup(run), "a binary, b binary")


def forest(one: pa.Table, two: pa.Table, similarity: int) -> tuple[list[bytes], list[bytes]]:
    """Links between the classes of two blocks, each of which joins two components.

    Sketches and sizes are compared at once for all of the second block, full sets for those
    they leave, and only where the components differ by then.
    """
    node, root, n, sketch, blobs = [], [], [], [], []
    for t in (one, two):
        node.append(t.column("node").to_pylist())
        root += t.column("root").to_pylist()
        n.append(t.column("n").to_numpy())
        sketch.append(np.asarray(t.column("sketch").combine_chunks().flatten()).view("uint64").reshape(t.num_rows, -1))
        blobs += [np.frombuffer(x.as_buffer(), "uint64") for x in t.column("shingles")]
    _, root = np.unique(np.array(root, object), return_inverse=True)
    root_a, root_b = np.split(root, [len(n[0])])
    shingles, numbers = np.unique(np.concatenate(blobs), return_inverse=True)
    starts = np.cumsum(np.append(0, np.concatenate(n)))
    start_b = starts[len(n[0]) : -1]
    inside = np.zeros(len(shingles), "int32")
    found_a, found_b = [], []
    for i, size in enumerate(n[0]):
        other = np.flatnonzero((root_b != root_a[i]) & (100 * np.minimum(size, n[1]) >= similarity * np.maximum(size, n[1])))
        bits, total = np.bitwise_count(sketch[1][other] ^ sketch[0][i]), n[1][other] + size
        near = bits[:, : BITS // 64].sum(axis=1, dtype="int64") <= most_different(np.minimum(total, BINS), similarity, np.sqrt)
        near &= bits[:, BITS // 64 :].sum(axis=1, dtype="int64") <= most_apart(total, similarity)
        other = other[near]
        if not len(other):
            continue
        own = numbers[starts[i] : starts[i + 1]]
        inside[own] = 1
        shared = np.add.reduceat(inside[numbers[ranges(start_b[other], n[1][other])]], np.cumsum(n[1][other]) - n[1][other])
        inside[own] = 0
        linked = other[100 * shared >= similarity * (n[1][other] + size - shared)]
        joined, first = np.unique(root_b[linked], return_index=True)
        for j in linked[first]:
            found_a.append(min(node[0][i], node[1][j]))
            found_b.append(max(node[0][i], node[1][j]))
        if len(joined):
            target = root_a[i]
            root_a[np.isin(root_a, joined)] = target
            root_b[np.isin(root_b, joined)] = target
    return found_a, found_b


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per document.

    component_id is the smallest doc_id reachable over links, kept marks that document.
    """
    rows = stage(described(docs), "shingled")
    filled = rows.where("node is not null")
    classes = stage(filled.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "classes")
    heads = filled.join(classes.withColumnRenamed("doc_id", "_first"), "node")
    heads = heads.where(F.col("doc_id").eqNullSafe(F.col("_first"))).dropDuplicates(["node"])
    entries = heads.select("node", F.posexplode("bands").alias("band", "value"))
    entries = stage(entries.select("node", F.col("band").cast("tinyint").alias("band"), "value"), "bands")
    buckets = entries.groupBy("band", "value").agg(F.count("*").alias("size"), F.min("node").alias("head"))
    members = stage(entries.join(buckets.where("size > 1").drop("size"), ["band", "value"]), "buckets")
    # sketches of those that share a bucket; pairs of a class and a first class
    shared = members.select("node").distinct()
    looks = stage(filled.select("node", F.col("n_shingles").alias("n"), "sketch").join(shared, "node").dropDuplicates(["node"]), "sketches")
    side = lambda name: looks.select(F.col("node").alias(name), F.struct("n", "sketch").alias(f"_{name}"))
    alike, far = _alike("_head", "_node", similarity)
    tried = members.where("node <> head").select("node", "head").distinct()
    tried = tried.join(side("node"), "node").join(side("head"), "head").where(alike)
    tried = stage(tried.select(F.col("head").alias("a"), F.col("node").alias("b"), far.alias("far")), "candidates")
    named = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
    sets = full_sets(docs, classes.join(named, "node"))
    # first the likest of the first classes, then the others that would join two components
    best = tried.groupBy("b").agg(F.min(F.struct("far", "a")).alias("m")).select("m.a", "b")
    links = stage(confirmed(best, sets, similarity), "links")
    roots = components(links)
    rest = apart(tried.select("a", "b").exceptAll(best), roots)
    links = stage(links.union(confirmed(rest, sets, similarity)), "links")
    roots = components(links)
    # last the pairs without a first class, in buckets that still hold several components
    own = roots.select("node", F.col("root").alias("_own"))
    top = roots.select(F.col("node").alias("head"), F.col("root").alias("_top"))
    now = members.join(own, "node", "left").join(top, "head", "left").select(
        "band", "value", "node", F.coalesce("_own", "node").alias("root"),
        (F.coalesce("_own", "node") != F.coalesce("_top", "head")).alias("outside"), (F.col("node") == F.col("head")).alias("first"),
    )
    now = stage(now, "buckets")
    open_ = now.groupBy("band", "value").agg(F.max("outside").alias("open")).where("open").drop("open")
    now = stage(now.join(open_, ["band", "value"]).join(looks, "node"), "buckets")

    def fetch(nodes: DataFrame) -> DataFrame:
        new = classes.join(nodes.join(sets.select("node"), "node", "left_anti"), "node")
        return sets.union(full_sets(docs, new))

    roots = components(links.union(_across(now, similarity, fetch)))
    # smallest document of each component, by class
    owned = classes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least = owned.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = owned.select("node", "root").join(least, "root").select("node", "component_id")
    empty = rows.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    found = filled.join(named, "node").select("doc_id", "n_shingles", "component_id")
    result = found.unionByName(empty)
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component yet."""
    one = roots.select(F.col("node").alias("a"), F.col("root").alias("_one"))
    two = roots.select(F.col("node").alias("b"), F.col("root").alias("_two"))
    both = pairs.join(one, "a", "left").join(two, "b", "left")
    return both.where(F.coalesce("_one", "a") != F.coalesce("_two", "b")).select("a", "b")


def drop_near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One document of each group stays, that with the smallest doc_id; its columns are kept.

    Rows that repeat both doc_id and text are one document. A row without doc_id stays. Other
    columns are kept, whatever their names.
    """
    return carried(docs, ("doc_id", "text"), lambda rows: _first_ones(rows, similarity))


def _first_ones(docs: DataFrame, similarity: int) -> DataFrame:
    kept = near_duplicates(docs, similarity).where("kept and doc_id is not null")
    kept = kept.select(F.col("doc_id").alias("_kept")).distinct()
    known = docs.where("doc_id is not null").join(kept, F.col("doc_id") == F.col("_kept"), "left_semi")
    known = known.withColumn("_text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_text_hash"])
    return known.drop("_text_hash").unionByName(docs.where("doc_id is null"))
