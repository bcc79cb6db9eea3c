"""Training samples from token-id sequences: windows, blocks, splits, batches, chat texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.functions import fixed
from textlake.functions import text as T
from textlake.operators.bpe import bpe_encode
from textlake.operators.chunks import window_count
from textlake.operators.vocab import encode_tokens
from textlake.plans.lookup import lookup
from textlake.plans.ranking import grand_total, running_total
from textlake.plans.staging import stage


def token_windows(seqs: DataFrame, size: int = 256, step: int = 128, pad_id: int = fixed.END_ID) -> DataFrame:
    """(doc_id, window_no, input_ids, attention_mask, labels): overlapping windows per document.

    The last window is padded; the mask is 0 on padding and the labels repeat the ids.
    """
    n = F.size("ids")
    rows = seqs.where(n > 0).select(
        "doc_id", "ids", F.explode(F.sequence(F.lit(0), window_count(n, size, step) - 1)).alias("window_no")
    )
    part = F.slice("ids", F.col("window_no") * step + 1, size)
    rows = rows.select("doc_id", "window_no", part.alias("part"))
    short = F.lit(size) - F.size("part")
    ids = F.concat("part", F.array_repeat(F.lit(pad_id), short))
    mask = F.concat(F.array_repeat(F.lit(1), F.size("part")), F.array_repeat(F.lit(0), short))
    return rows.select(
        "doc_id", "window_no", ids.alias("input_ids"), mask.alias("attention_mask"), ids.alias("labels")
    )


def with_offsets(seqs: DataFrame) -> DataFrame:
    """Add `start`: the position of a document's first id when all documents are put end to end.

    `seqs` should be a written table with one row per doc_id. Only ids and sizes of documents are
    ranked; the sequences meet their positions in a lookup.
    """
    sizes = stage(seqs.select("doc_id", F.size("ids").alias("_n")), "sizes")
    upto = running_total(sizes, ["doc_id"], F.col("_n"), out="_upto")
    starts = stage(upto.select("doc_id", (F.col("_upto") - F.col("_n")).alias("start")), "starts")
    return lookup(seqs, starts, ["doc_id"], how="inner")


def _blocks(placed: DataFrame, size: int) -> DataFrame:
    """(block_id, ids): the stream cut every `size` ids, the last block possibly short.

    Documents are cut into one piece per block first, so the shuffle moves arrays, and a
    block never gathers more than `size` pieces.
    """
    first = F.floor(F.col("start") / size)
    last = F.floor((F.col("start") + F.size("ids") - 1) / size)
    pieces = placed.where(F.size("ids") > 0).select(
        "start", "ids", F.explode(F.sequence(first, last)).alias("block_id")
    )
    begin = F.greatest(F.col("block_id") * size - F.col("start"), F.lit(0))
    end = F.least((F.col("block_id") + 1) * size - F.col("start"), F.size("ids"))
    pieces = pieces.select(
        "block_id",
        (F.col("start") + begin).alias("at"),
        F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("piece"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("at", "piece"))).getField("piece")
    return pieces.groupBy("block_id").agg(F.flatten(ordered).alias("ids"))


def token_blocks(seqs: DataFrame, size: int = 512, strict_compat: bool = False) -> DataFrame:
    """(block_id, input_ids, attention_mask, labels): full blocks of the whole stream.

    A short remainder is dropped. With strict_compat the last full block is dropped too
    when it ends exactly at the end of the stream.
    """
    full = _blocks(with_offsets(seqs), size).where(F.size("ids") == size)
    if strict_compat:
        total = grand_total(seqs, F.size("ids"))
        full = full.where(F.col("block_id") * size < total - size)
    return full.select(
        "block_id",
        F.col("ids").alias("input_ids"),
        F.array_repeat(F.lit(1), size).alias("attention_mask"),
        F.col("ids").alias("labels"),
    )


def contiguous_split(seqs: DataFrame, share: float = 0.9) -> DataFrame:
    """(doc_id, train_ids, val_ids): the first 90 % of the stream is for training."""
    cut = int(share * grand_total(seqs, F.size("ids")))
    n_train = F.least(F.greatest(F.lit(cut) - F.col("start"), F.lit(0)), F.size("ids")).cast("int")
    return with_offsets(seqs).select(
        "doc_id",
        F.slice("ids", F.lit(1), n_train).alias("train_ids"),
        F.slice("ids", n_train + 1, F.size("ids")).alias("val_ids"),
    )


def next_token_samples(
    seqs: DataFrame, context: int = 128, batch: int = 32, n_batches: int | None = None, seed: int = 42, part: str | None = None, share: float = 0.9
) -> DataFrame:
    """(batch_no, row_no, start, inputs, targets): contexts at hashed start positions.

    Targets are the inputs one position later. part takes samples from the training or the validation
    side ("train", "val") of `contiguous_split` alone: no context or target crosses the cut. By
    default there are as many batches as that stretch of the stream could fill once.
    """
    total = grand_total(seqs, F.size("ids"))
    cut = int(share * total)
    low, high = {None: (0, total), "train": (0, cut), "val": (cut, total)}[part]
    if high - low <= context:
        raise ValueError(f"the stream has {high - low} ids, a sample needs {context + 1}")
    n_batches = n_batches or max(1, (high - low) // (context * batch))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    start = F.lit(low) + F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") % F.lit(high - low - context)
    starts = seqs.sparkSession.range(n_batches * batch).withColumn("start", start)
    first = F.floor(F.col("start") / context)
    wanted = starts.select("id", "start", F.explode(F.array(first, first + 1)).alias("block_id"))
    joined = wanted.join(_blocks(with_offsets(seqs), context), "block_id")
    ordered = F.sort_array(F.collect_list(F.struct("block_id", "ids")))
    rows = joined.groupBy("id", "start").agg(F.flatten(ordered.getField("ids")).alias("ids"))
    skip = (F.col("start") % context).cast("int")
    return rows.select(
        F.floor(F.col("id") / batch).alias("batch_no"),
        (F.col("id") % batch).alias("row_no"),
        "start",
        F.slice("ids", skip + 1, context).alias("inputs"),
        F.slice("ids", skip + 2, context).alias("targets"),
    )


def shuffled_batches(rows: DataFrame, key: str, size: int = 16, epochs: int = 1, seed: int = 42) -> DataFrame:
    """(epoch, batch_no, place, key): a new order per epoch, cut into batches; the last may be short."""
    keys = rows.select(key, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    digest = F.md5(F.concat_ws(":", F.col("epoch").cast("string"), F.lit(str(seed)), F.col(key).cast("string")))
    ranked = running_total(keys.withColumn("_order", digest), ["_order", key], group=["epoch"], out="n")
    return ranked.select(
        "epoch",
        F.floor((F.col("n") - 1) / size).alias("batch_no"),
        ((F.col("n") - 1) % size).alias("place"),
        key,
    )


def sft_format(conversations: DataFrame) -> DataFrame:
    """(conv_id, text): the first user message and the first answer in the chat format."""
    first = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    pairs = conversations.groupBy("conv_id").agg(first("user").alias("problem"), first("assistant").alias("answer"))
    pairs = pairs.where(F.col("problem").isNotNull() & F.col("answer").isNotNull())
    text = T.filled(fixed.CHAT_FORMAT, problem=F.col("problem"), answer=F.col("answer"))
    return pairs.select("conv_id", text.alias("text"))


def sft_tokenize(texts: DataFrame, vocab: DataFrame, max_length: int = 512) -> DataFrame:
    """(conv_id, input_ids, attention_mask): whitespace tokens cut to max_length, then encoded."""
    tokens = F.slice(T.raw_ws_tokens(F.col("text")), 1, max_length)
    coded = encode_tokens(texts.select(F.col("conv_id").alias("doc_id"), tokens.alias("tokens")), vocab)
    return coded.select(
        F.col("doc_id").alias("conv_id"),
        F.col("ids").alias("input_ids"),
        F.array_repeat(F.lit(1), F.size("ids")).alias("attention_mask"),
    )


def staged_sequences(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Written (doc_id, ids) of whole documents, without start and end ids."""
    tokens = docs.select("doc_id", T.raw_ws_tokens(F.col("text")).alias("tokens"))
    return stage(encode_tokens(tokens, vocab).select("doc_id", "ids"), "sequences")


def byte_pair_sequences(docs: DataFrame, vocab: DataFrame, merges: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """Written (doc_id, ids) of whole documents in byte pairs, each with the newline that parts it from the next.

    A null text is empty; its newline stays.
    """
    lines = docs.select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).alias("text"))
    return stage(bpe_encode(lines, vocab, merges, words), "byte-pairs")


def sft_encode(texts: DataFrame, vocab: DataFrame, merges: DataFrame, max_length: int = 512) -> DataFrame:
    """(conv_id, input_ids, attention_mask): byte pairs of a chat text, cut to max_length."""
    coded = bpe_encode(texts.select(F.col("conv_id").alias("doc_id"), "text"), vocab, merges)
    ids = F.slice("ids", 1, max_length)
    return coded.select(F.col("doc_id").alias("conv_id"), ids.alias("input_ids"), F.array_repeat(F.lit(1), F.size(ids)).alias("attention_mask"))
