"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text is a bag of words, weighted by how often they occur. For each sample and each word,
two gamma variables r and c of shape two and a uniform b are drawn from hashes of the word. With
t = floor(ln(weight) / r + b), the word's draw is ln c - r * (t - b) - r, and the sample is the
word with the least draw together with its t. Two texts agree in a sample with the
probability of their generalised Jaccard similarity, sum(min) / sum(max) of the weights.

A sample is kept as one number: the draw in the high bits, ordered, and a hash of word and t
in the low ones, so that the best sample is a plain minimum, pre-aggregated in the task.

Defined results: a null text is empty. An empty text, or one of white space alone, has an
empty fingerprint, which agrees fully with another empty one and not at all with any other.
Equal texts have equal fingerprints. Rows with the same doc_id are told apart by their text;
a null doc_id comes last in descending order. The next document of a single row is itself. An
empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.plans.ranking import running_total
from textlake.plans.staging import stage

SAMPLES = 24
RANGE = 100_000  # documents put in order at once
_LOW = (1 << 31) - 1


def _uniform(hashed: Column, shift: int) -> Column:
    """A number between 0 and 1, never either, from 31 of the hash's bits."""
    return (F.shiftrightunsigned(hashed, shift).bitwiseAND(_LOW) + F.lit(0.5)) / F.lit(float(1 << 31))


def draw(word_hash: Column, log_weight: Column, sample: int) -> Column:
    """The sample's value for one word as a number whose minimum picks the word."""
    one, two = F.xxhash64(word_hash, F.lit(2 * sample)), F.xxhash64(word_hash, F.lit(2 * sample + 1))
    r = -F.ln(_uniform(one, 0) * _uniform(one, 32))
    log_c = F.ln(-F.ln(_uniform(two, 0) * _uniform(two, 32)))
    b = _uniform(F.xxhash64(one, two), 7)
    t = F.floor(log_weight / r + b)
    value = log_c - r * (t - b) - r
    # draws lie well within +-500: 33 bits hold them, in order, to 2^-22
    high = F.shiftleft(F.floor((F.greatest(F.least(value, F.lit(500.0)), F.lit(-500.0)) + 512) * (1 << 22)).cast("bigint"), 30)
    return high.bitwiseOR(F.xxhash64(word_hash, t).bitwiseAND((1 << 30) - 1))


def fingerprints(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """(keys, samples) of each text that has words.

    Words are counted and sampled where the text lies: texts that are partitioned by a key
    are not shuffled again.
    """
    words = texts.select(*keys, F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")
    counted = words.groupBy(*keys, F.xxhash64("word").alias("h")).agg(F.count("*").alias("n"))
    hashed = counted.select(*keys, "h", F.ln(F.col("n").cast("double")).alias("w"))
    best = [F.min(draw(F.col("h"), F.col("w"), k)).alias(f"s{k}") for k in range(samples)]
    # the draw has done its work: agreement needs the word and t alone
    picked = F.array(*[F.col(f"s{k}").bitwiseAND((1 << 30) - 1).cast("int") for k in range(samples)])
    return hashed.groupBy(*keys).agg(*best).select(*keys, picked.alias("samples"))


def likeness(one: Column, two: Column) -> Column:
    """Share of samples that agree; empty agrees with empty."""
    same = F.aggregate(F.zip_with(one, two, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(one.isNull() & two.isNull(), 1.0).when(one.isNull() | two.isNull(), 0.0).otherwise(same / F.size(one))


def as_text(samples: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(x), 8, "0")), ""), F.lit(""))


def next_keys(narrow: DataFrame) -> DataFrame:
    """(key, next): the key of the next document in descending order, the first behind the last."""
    ranked = running_total(
        # every id has a complement; that of the least id equals a null's place, whose key is the greater one
        narrow.select("key", F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1)).alias("_down")),
        ["_down", "key"], out="rank", rows_per_range=RANGE,
    )
    ranked = stage(ranked.select("key", "rank"), "ranks")
    before = F.when(F.col("rank") == 1, F.lit(ranked.count())).otherwise(F.col("rank") - 1)
    return ranked.join(ranked.select(F.col("key").alias("next"), before.alias("rank")), "rank").select("key", "next")


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last half replaced by the beginning of the next document's text,
    in descending order of doc_id. Rows that repeat doc_id and text are one document there.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex(F.xxhash64(text)))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), key.alias("key"))
    narrow = keyed.groupBy("key", "doc_id", F.char_length("text").cast("bigint").alias("n_chars")).agg(F.count("*").alias("rows"))
    narrow = stage(narrow, "narrow")
    texts = keyed.select("key", "text")
    if not narrow.where("rows > 1").isEmpty():
        texts = texts.dropDuplicates(["key"])
    follows = stage(next_keys(narrow).join(narrow.select("key", F.floor(F.col("n_chars") / 2).cast("int").alias("half")), "key"), "next")
    # the next document sends only the characters that are asked for
    heads = texts.join(follows.select(F.col("key").alias("to"), F.col("next").alias("key"), "half"), "key")
    heads = heads.select(F.col("to").alias("key"), F.substring(F.col("text"), F.lit(1), F.col("half")).alias("head"), "half")
    left = (F.char_length("text") - F.col("half")).cast("int")
    both = texts.join(heads, "key").select("key", "text", F.concat(F.substring(F.col("text"), F.lit(1), left), F.col("head")).alias("edited"))
    versions = F.explode(F.array(F.struct(F.lit(0).alias("edit"), "text"), F.struct(F.lit(1).alias("edit"), F.col("edited").alias("text"))))
    found = fingerprints(both.select("key", versions.alias("v")).select("key", "v.edit", "v.text"), ["key", "edit"], samples)
    shas = both.select("key", F.sha2("edited", 256).alias("edited_sha256"))
    found = stage(shas.join(found, "key", "left"), "fingerprints")
    own = found.groupBy("key").agg(
        F.first("edited_sha256").alias("edited_sha256"),
        F.max(F.when(F.col("edit") == 0, F.col("samples"))).alias("own"),
        F.max(F.when(F.col("edit") == 1, F.col("samples"))).alias("changed"),
    )
    own = stage(own, "fingerprints")
    other = own.select(F.col("key").alias("next"), F.col("own").alias("other"))
    full = narrow.join(own, "key").join(follows.select("key", "next"), "key").join(other, "next")
    return full.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
        F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))).alias("_one"),
    ).drop("_one")
