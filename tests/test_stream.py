"""The token stream in byte pairs, and samples on either side of the cut."""

from __future__ import annotations

import pytest

from textlake.operators import bpe, sequences
from textlake.plans.staging import stage

TEXTS = ["the cat sat", None, "", "Größe  über\n", "the cat", "😀 the end. " * 40]


@pytest.fixture(scope="module")
def pairs(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    vocab, merges = bpe.tokenizer_tables(spark, bpe.bpe_train(bpe.word_counts(docs), 290))
    return sequences.byte_pair_sequences(docs, vocab, merges), vocab


def test_newlines_part_documents(spark, pairs):
    seqs, vocab = pairs
    back = {r["doc_id"]: r["text"] for r in bpe.bpe_decode(seqs, vocab).collect()}
    assert back == {i: (t or "") + "\n" for i, t in enumerate(TEXTS)}
    blocks = sequences.token_blocks(seqs, 16).orderBy("block_id").collect()
    stream = [i for r in seqs.orderBy("doc_id").collect() for i in r["ids"]]
    assert [list(b["input_ids"]) for b in blocks] == [stream[i : i + 16] for i in range(0, len(stream) - 15, 16)]


def test_samples_keep_to_their_side(spark):
    stream = list(range(1000, 1400))
    seqs = stage(spark.createDataFrame([(0, stream[:150]), (1, []), (2, stream[150:])], "doc_id long, ids array<int>"), "test")
    for part, low, high in (("train", 1000, 1360), ("val", 1360, 1400)):
        found = sequences.next_token_samples(seqs, context=16, batch=8, n_batches=20, part=part).collect()
        assert len(found) == 160
        seen = {i for r in found for c in ("inputs", "targets") for i in r[c]}
        assert min(seen) >= low and max(seen) < high and len(seen) > 0.9 * (high - low)
        assert all(list(r["targets"])[:-1] == list(r["inputs"])[1:] and len(r["targets"]) == 16 for r in found)
    with pytest.raises(ValueError, match="needs 129"):
        sequences.next_token_samples(seqs, part="val")


def test_chat_ids_are_cut(spark, pairs):
    _, vocab = pairs
    texts = spark.createDataFrame([(1, "the cat " * 50), (2, "é")], "conv_id long, text string")
    _, merges = bpe.tokenizer_tables(spark, [])
    found = {r["conv_id"]: r for r in sequences.sft_encode(texts, vocab, merges, 20).collect()}
    assert len(found[1]["input_ids"]) == 20 and found[1]["attention_mask"] == [1] * 20 and len(found[2]["input_ids"]) == 2
