"""Character and word vocabularies, id sequences, padding and masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.functions.fixed import END_ID, FIRST_WORD_ID, PAD_ID, START_ID
from textlake.plans.lookup import lookup
from textlake.plans.ranking import running_total
from textlake.plans.staging import stage


def char_frequency(docs: DataFrame, lower: bool = False) -> DataFrame:
    text = F.lower("text") if lower else F.col("text")
    chars = docs.select(F.explode(T.characters(text)).alias("ch"))
    return chars.groupBy("ch").agg(F.count("*").alias("n"))


def char_vocab(docs: DataFrame) -> DataFrame:
    """(ch, id): distinct characters in code-point order, ids from 0."""
    chars = stage(char_frequency(docs).select("ch"), "chars")
    return running_total(chars, ["ch"], out="n").select("ch", (F.col("n") - 1).cast("int").alias("id"))


def char_encode(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add `ids`, the character ids of the text; -1 for characters outside the vocabulary.

    The ids sit in one array indexed by code point, so every character is one array
    access inside its own row. The array cannot exceed the size of Unicode.
    """
    points = vocab.select(F.ascii("ch").alias("cp"), "id")
    last = points.agg(F.max("cp")).first()[0] or 0
    every = docs.sparkSession.range(last + 1).withColumnRenamed("id", "cp")
    dense = (
        every.join(F.broadcast(points), "cp", "left")
        .select(F.struct("cp", F.coalesce("id", F.lit(-1)).alias("id")).alias("e"))
        .agg(F.sort_array(F.collect_list("e")).getField("id").alias("ids"))
    )
    with_table = docs.withColumn("_by_point", dense.scalar()).withColumn("_chars", T.characters(F.col("text")))
    ids = F.transform("_chars", lambda c: F.coalesce(F.get(F.col("_by_point"), F.ascii(c)), F.lit(-1)))
    return with_table.withColumn("ids", ids).drop("_by_point", "_chars")


def char_decode(encoded: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add `decoded`, the text spelled by `ids`."""
    chars = vocab.agg(F.sort_array(F.collect_list(F.struct("id", "ch"))).getField("ch").alias("chars"))
    with_table = encoded.withColumn("_by_id", chars.scalar())
    spelled = F.array_join(F.transform("ids", lambda i: F.get(F.col("_by_id"), i)), "")
    return with_table.withColumn("decoded", spelled).drop("_by_id")


def word_vocab_first_seen(docs: DataFrame) -> DataFrame:
    """Written table (token, id, n): whitespace tokens numbered by first appearance.

    Ids 0-2 are reserved for padding, start and end; words begin at 3. n is the number of
    documents. The place among a document's distinct tokens orders them like their first
    positions do, and leaves one row per token and document.
    """
    distinct = F.array_distinct(T.raw_ws_tokens(F.col("text")))
    tokens = docs.select("doc_id", F.posexplode(distinct).alias("pos", "token"))
    firsts = tokens.groupBy("token").agg(
        F.min("doc_id").alias("first_doc"), F.min_by("pos", "doc_id").alias("pos"), F.count("*").alias("n")
    )
    firsts = stage(firsts.withColumnRenamed("first_doc", "doc_id"), "firsts")
    ranked = running_total(firsts, ["doc_id", "pos"], out="rank")
    ids = (F.col("rank") + F.lit(FIRST_WORD_ID - 1)).cast("int")
    return stage(ranked.select("token", ids.alias("id"), "n"), "vocab")


def encode_tokens(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc_id, ids, n_unknown): ids of a tokens array, 0 for words outside the vocabulary."""
    long = tokens.select("doc_id", F.posexplode_outer("tokens").alias("pos", "token"))
    found = lookup(long, vocab.select("token", "id", "n"), ["token"], weight="n")
    found = found.withColumn("unknown", F.col("id").isNull() & F.col("token").isNotNull())
    found = found.withColumn("id", F.coalesce("id", F.lit(PAD_ID)))
    cell = F.when(F.col("pos").isNotNull(), F.struct("pos", "id"))
    return found.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(cell)).getField("id").alias("ids"),
        F.count_if("unknown").alias("n_unknown"),
    )


def encode_sequences(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Start id, word ids, end id; unknown words get the padding id."""
    tokens = docs.select("doc_id", T.raw_ws_tokens(F.col("text")).alias("tokens"))
    framed = F.concat(F.array(F.lit(START_ID)), F.col("ids"), F.array(F.lit(END_ID)))
    return encode_tokens(tokens, vocab).withColumn("ids", framed)


def pad_sequences(seqs: DataFrame) -> DataFrame:
    """Right-pad `ids` with 0 to the longest sequence of the table."""
    longest = seqs.agg(F.max(F.size("ids"))).scalar()
    padding = F.array_repeat(F.lit(PAD_ID), F.col("_longest") - F.size("ids"))
    padded = seqs.withColumn("_longest", longest).withColumn("ids", F.concat("ids", padding))
    return padded.drop("_longest")


def padding_mask(ids: Column) -> Column:
    """1 where the id is a real token, 0 on padding."""
    return F.transform(ids, lambda i: F.when(i == PAD_ID, 0).otherwise(1))


def decode_sequences(seqs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc_id, decoded): ids back to words; reserved ids dropped, unknown ids shown as ?."""
    kept = F.filter("ids", lambda i: i >= FIRST_WORD_ID)
    long = seqs.select("doc_id", F.posexplode_outer(kept).alias("pos", "id"))
    found = lookup(long, vocab.select("id", "token", "n"), ["id"], weight="n")
    word = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("token", F.lit("?")).alias("w")))
    words = F.sort_array(F.collect_list(word)).getField("w")
    return found.groupBy("doc_id").agg(F.array_join(words, " ").alias("decoded"))
