"""Training samples, next-word statistics and byte-pair encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.catalog.features import words_of
from textlake.catalog.registry import RAW, WORDS, filled_sql, query
from textlake.catalog.vocab import joined
from textlake.functions import text as T
from textlake.functions.fixed import CHAT_FORMAT
from textlake.operators import bpe as B
from textlake.operators import nextword as W
from textlake.operators import sequences as S
from textlake.operators import vocab as V
from textlake.plans.staging import stage, stacked

SEQS = f"""{RAW},
vocab AS (SELECT token, row_number() OVER (ORDER BY seen) + 2 AS id FROM (
  SELECT token, min({{'d': doc_id, 'p': pos}}) AS seen FROM raw_words GROUP BY token)),
seqs AS (SELECT doc_id, list(id ORDER BY pos) AS ids, count(*) AS n FROM raw_words JOIN vocab USING (token) GROUP BY doc_id),
placed AS (SELECT doc_id, ids, n, sum(n) OVER (ORDER BY doc_id) - n AS start FROM seqs),
stream AS (SELECT unnest(ids) AS id, start + unnest(range(n)) AS place_no FROM placed),
size AS (SELECT sum(n)::BIGINT AS n FROM seqs)"""


def _sequences(t):
    return S.staged_sequences(t.documents, V.word_vocab_first_seen(t.documents))


@query(
    "token_windows",
    f"""
    WITH {SEQS}, w AS (SELECT doc_id, ids, n, unnest(range(1 + greatest(ceil((n - 256) / 128.0), 0)::BIGINT)) AS window_no FROM seqs),
    p AS (SELECT doc_id, window_no, ids[window_no * 128 + 1 : window_no * 128 + 256] AS part FROM w)
    SELECT doc_id, window_no::INT AS window_no, array_to_string(list_resize(part, 256, 2), ' ') AS input_ids, len(part) AS n_real FROM p
    """,
)
def _(t):
    windows = S.token_windows(_sequences(t))
    real = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return windows.select("doc_id", "window_no", joined("input_ids").alias("input_ids"), real.alias("n_real"))


@query(
    "token_blocks",
    f"""
    WITH {SEQS} SELECT (place_no // 512)::BIGINT AS block_id, string_agg(id::VARCHAR, ' ' ORDER BY place_no) AS input_ids
    FROM stream GROUP BY 1 HAVING count(*) = 512
    """,
)
def _(t):
    return S.token_blocks(_sequences(t)).select("block_id", joined("input_ids").alias("input_ids"))


@query(
    "contiguous_split",
    f"""
    WITH {SEQS}, cut AS (SELECT floor(n * 0.9::DOUBLE) AS c FROM size)
    SELECT doc_id, count(id) FILTER (place_no < c) AS n_train, count(id) FILTER (place_no >= c) AS n_val,
           coalesce(string_agg(id::VARCHAR, ' ' ORDER BY place_no) FILTER (place_no >= c), '') AS val_ids
    FROM (SELECT doc_id, unnest(ids) AS id, start + unnest(range(n)) AS place_no FROM placed), cut GROUP BY doc_id
    UNION ALL SELECT doc_id, 0, 0, '' FROM documents ANTI JOIN seqs USING (doc_id)
    """,
)
def _(t):
    split = S.contiguous_split(_sequences(t))
    return split.select(
        "doc_id",
        F.size("train_ids").cast("bigint").alias("n_train"),
        F.size("val_ids").cast("bigint").alias("n_val"),
        joined("val_ids").alias("val_ids"),
    )


@query(
    "next_token_samples",
    f"""
    WITH {SEQS}, cut AS (SELECT floor(n * 0.9::DOUBLE)::BIGINT AS c, n FROM size),
    parts AS (SELECT 'train' AS part, 0 AS low, c AS size FROM cut UNION ALL SELECT 'val', c, n - c FROM cut),
    s AS (SELECT part, id AS k, low + ('0x' || substr(md5('42:' || id), 1, 12))::BIGINT % (size - 128) AS start
      FROM (SELECT *, unnest(range(greatest(1, size // (128 * 32)) * 32)) AS id FROM parts)),
    pos AS (SELECT part, k, start, start + unnest(range(129)) AS place_no, unnest(range(129)) AS j FROM s)
    SELECT part, (k // 32)::BIGINT AS batch_no, (k % 32)::BIGINT AS row_no, pos.start,
      string_agg(id::VARCHAR, ' ' ORDER BY j) FILTER (j < 128) AS inputs, string_agg(id::VARCHAR, ' ' ORDER BY j) FILTER (j > 0) AS targets
    FROM pos JOIN stream USING (place_no) GROUP BY part, k, pos.start
    """,
)
def _(t):
    seqs = _sequences(t)
    found = stacked([S.next_token_samples(seqs, part=p).withColumn("part", F.lit(p)) for p in ("train", "val")])
    return found.withColumns({c: joined(c) for c in ("inputs", "targets")})


@query(
    "shuffled_batches",
    """
    WITH keys AS (SELECT doc_id, unnest([0, 1]) AS epoch FROM documents),
    r AS (SELECT doc_id, epoch, row_number() OVER (PARTITION BY epoch ORDER BY md5(epoch || ':42:' || doc_id), doc_id) - 1 AS n FROM keys)
    SELECT epoch, n // 16 AS batch_no, n % 16 AS place, doc_id FROM r
    """,
)
def _(t):
    return S.shuffled_batches(t.documents, "doc_id", size=16, epochs=2)


CHAT = f"""pairs AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS problem, arg_min(text, turn) FILTER (role = 'assistant') AS answer
  FROM conversations GROUP BY conv_id),
chat AS (SELECT conv_id, {filled_sql(CHAT_FORMAT, problem="problem", answer="answer")} AS text
  FROM pairs WHERE problem IS NOT NULL AND answer IS NOT NULL)"""


@query("sft_format", f"WITH {CHAT} SELECT conv_id, text FROM chat")
def _(t):
    return S.sft_format(t.conversations)


@query(
    "sft_tokenize",
    f"""
    WITH {CHAT}, toks AS (SELECT conv_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS t FROM chat),
    w AS (SELECT conv_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM toks),
    vocab AS (SELECT token, row_number() OVER (ORDER BY seen) + 2 AS id FROM (
      SELECT token, min({{'d': conv_id, 'p': pos}}) AS seen FROM w GROUP BY token))
    SELECT conv_id, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS input_ids, count(*) AS n_ids
    FROM w JOIN vocab USING (token) WHERE pos < 512 GROUP BY conv_id
    """,
)
def _(t):
    texts = S.sft_format(t.conversations)
    vocab = V.word_vocab_first_seen(texts.withColumnRenamed("conv_id", "doc_id"))
    coded = S.sft_tokenize(texts, vocab)
    return coded.select("conv_id", joined("input_ids").alias("input_ids"), F.size("attention_mask").cast("bigint").alias("n_ids"))


PAIRS = f"""{WORDS},
big AS (SELECT t[i] AS prev, t[i + 1] AS next, doc_id FROM (SELECT doc_id, t, unnest(range(1, len(t))) AS i FROM toks)),
pairs AS (SELECT prev, next, count(*) AS n FROM big GROUP BY prev, next),
pt AS (SELECT *, sum(n) OVER (PARTITION BY prev) AS prev_n FROM pairs)"""


@query("ngram_counts", f"WITH {PAIRS} SELECT prev, next, n FROM pairs")
def _(t):
    return W.ngram_counts(words_of(t))


@query(
    "next_token_top_k",
    f"""
    WITH {PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY prev ORDER BY n DESC, next) AS rank, exp(ln(n / prev_n::DOUBLE) / 0.8) AS w FROM pt)
    SELECT prev, next, rank, round(w / sum(w) OVER (PARTITION BY prev), 6) AS prob FROM (SELECT * FROM r WHERE rank <= 5)
    """,
)
def _(t):
    found = W.next_token_top_k(W.pair_table(words_of(t)), 5, 0.8)
    return found.withColumn("prob", F.round("prob", 6))


@query(
    "next_token_top_p",
    f"""
    WITH {PAIRS}, c AS (SELECT *, sum(n) OVER (PARTITION BY prev ORDER BY n DESC, next ROWS UNBOUNDED PRECEDING) - n AS before FROM pt)
    SELECT prev, next, round(n / prev_n::DOUBLE, 6) AS prob FROM c WHERE before < 0.95::DOUBLE * prev_n
    """,
)
def _(t):
    found = W.next_token_top_p(W.pair_table(words_of(t)), 0.95)
    return found.withColumn("prob", F.round("prob", 6))


LOSSES = f"""{PAIRS}, v AS (SELECT count(DISTINCT term) AS v FROM words),
losses AS (SELECT doc_id, -ln((n + 1) / (prev_n + v)::DOUBLE) AS loss FROM big JOIN pt USING (prev, next), v)"""


@query(
    "perplexity",
    f"""
    WITH {LOSSES} SELECT doc_id, round(avg(loss), 6) AS mean_loss,
      round(CASE WHEN avg(loss) < 20 THEN exp(avg(loss)) ELSE 'inf'::DOUBLE END, 4) AS perplexity FROM losses GROUP BY doc_id
    """,
)
def _(t):
    tokens = words_of(t)
    found = W.perplexity(W.pair_losses(tokens, W.pair_table(tokens)))
    return found.withColumns({"mean_loss": F.round("mean_loss", 6), "perplexity": F.round("perplexity", 4)})


@query(
    "corpus_perplexity",
    f"WITH {LOSSES} SELECT round(avg(loss), 6) AS mean_loss, round(exp(avg(loss)), 4) AS perplexity FROM losses",
)
def _(t):
    tokens = words_of(t)
    found = W.corpus_perplexity(W.pair_losses(tokens, W.pair_table(tokens)))
    return found.withColumns({"mean_loss": F.round("mean_loss", 6), "perplexity": F.round("perplexity", 4)})


@query(
    "masked_mean",
    f"""
    WITH {RAW}, vocab AS (SELECT token, count(*) AS n FROM raw_words GROUP BY token),
    tot AS (SELECT sum(n) + count(*) + 1 AS t FROM vocab),
    loss AS (SELECT doc_id, -ln((coalesce(n, 0) + 1) / t::DOUBLE) AS loss, (n IS NOT NULL)::INT AS mask FROM raw_words LEFT JOIN vocab USING (token), tot)
    SELECT doc_id, round(sum(loss * mask) / nullif(sum(mask), 0), 6) AS masked_mean, sum(mask)::BIGINT AS n_real FROM loss GROUP BY doc_id
    """,
)
def _(t):
    tokens = t.documents.select("doc_id", T.raw_ws_tokens(F.col("text")).alias("tokens"))
    losses = W.token_losses(tokens, W.token_counts(tokens))
    return W.masked_mean(losses, ["doc_id"]).withColumn("masked_mean", F.round("masked_mean", 6))


def _tokenizer(t):
    words = B.word_counts(t.documents)
    return words, *B.tokenizer_tables(t.spark, B.bpe_train(words))


@query("bpe_train")
def _(t):
    return _tokenizer(t)[2]


@query("bpe_encode")
def _(t):
    words, vocab, merges = _tokenizer(t)
    return B.bpe_encode(t.documents, vocab, merges, words).select("doc_id", joined("ids").alias("ids"))


@query("bpe_decode", "SELECT doc_id, text FROM documents")
def _(t):
    words, vocab, merges = _tokenizer(t)
    return B.bpe_decode(B.bpe_encode(t.documents, vocab, merges, words), vocab)


# The stream of byte pairs, with newlines between documents. Documents are whole again when their ids are decoded.
def _byte_pairs(t):
    words, vocab, merges = _tokenizer(t)
    return S.byte_pair_sequences(t.documents, vocab, merges), vocab


@query("token_blocks_bpe")
def _(t):
    return S.token_blocks(_byte_pairs(t)[0]).select("block_id", joined("input_ids").alias("input_ids"))


@query("next_token_samples_bpe")
def _(t):
    seqs, _ = _byte_pairs(t)
    found = stacked([S.next_token_samples(seqs, part=p).withColumn("part", F.lit(p)) for p in ("train", "val")])
    return found.withColumns({c: joined(c) for c in ("inputs", "targets")})


@query("contiguous_split_bpe", "SELECT doc_id, coalesce(text, '') || chr(10) AS text FROM documents")
def _(t):
    seqs, vocab = _byte_pairs(t)
    split = S.contiguous_split(seqs)
    return B.bpe_decode(split.select("doc_id", F.concat("train_ids", "val_ids").alias("ids")), vocab)


@query(
    "sft_tokenize_bpe",
    f"WITH {CHAT} SELECT conv_id, true AS begins_text, true AS whole_if_short FROM chat",
)
def _(t):
    texts = S.sft_format(t.conversations)
    words = B.word_counts(texts)
    vocab, merges = B.tokenizer_tables(t.spark, B.bpe_train(words))
    coded = S.sft_encode(texts, vocab, merges).select(F.col("conv_id").alias("doc_id"), F.col("input_ids").alias("ids"), F.size("attention_mask").alias("n"))
    coded = stage(coded, "sft")
    back = B.bpe_decode(coded, vocab).select(F.col("doc_id").alias("conv_id"), F.rtrim(F.col("text"), F.lit("\ufffd")).alias("back"))
    rows = texts.join(back, "conv_id").join(coded.select(F.col("doc_id").alias("conv_id"), "n"), "conv_id")
    whole = (F.col("n") == 512) | (F.col("back") == F.col("text"))
    return rows.select("conv_id", F.col("text").startswith(F.col("back")).alias("begins_text"), whole.alias("whole_if_short"))
