"""Vocabularies, encoding and padding."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.catalog.registry import RAW, query
from textlake.operators import vocab as V

WORD_VOCAB = f"""{RAW},
vocab AS (SELECT token, row_number() OVER (ORDER BY seen) + 2 AS id FROM (
  SELECT token, min({{'d': doc_id, 'p': pos}}) AS seen FROM raw_words GROUP BY token)),
coded AS (SELECT doc_id, pos, token, coalesce(id, 0) AS id, id IS NULL AS unknown
          FROM raw_words LEFT JOIN vocab USING (token)),
seqs AS (SELECT doc_id, [1] || coalesce(ids, []) || [2] AS ids, coalesce(n_unknown, 0) AS n_unknown
         FROM documents LEFT JOIN (
           SELECT doc_id, list(id ORDER BY pos) AS ids, count(*) FILTER (unknown) AS n_unknown
           FROM coded GROUP BY doc_id) USING (doc_id))"""


def _learned(t):
    return V.word_vocab_first_seen(t.documents)


def joined(ids):
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), " ")


@query(
    "char_vocab",
    """
    SELECT ch, row_number() OVER (ORDER BY ch) - 1 AS id FROM (
      SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''
    """,
)
def _(t):
    return V.char_vocab(t.documents).withColumn("id", F.col("id").cast("bigint"))


@query(
    "char_encode_roundtrip",
    """
    WITH chars AS (SELECT doc_id, unnest(c) AS ch, unnest(range(len(c))) AS pos FROM (
      SELECT doc_id, string_split(text, '') AS c FROM documents WHERE text <> '')),
    vocab AS (SELECT ch, row_number() OVER (ORDER BY ch) - 1 AS id FROM (SELECT DISTINCT ch FROM chars)),
    coded AS (SELECT doc_id, count(*) AS n_ids, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS ids
              FROM chars JOIN vocab USING (ch) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_ids, 0) AS n_ids, md5(coalesce(ids, '')) AS ids_md5, true AS lossless
    FROM documents LEFT JOIN coded USING (doc_id)
    """,
)
def _(t):
    docs = t.documents.select("doc_id", "text")
    vocab = V.char_vocab(docs)
    decoded = V.char_decode(V.char_encode(docs, vocab), vocab)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        F.md5(joined("ids")).alias("ids_md5"),
        (F.col("decoded") == F.col("text")).alias("lossless"),
    )


@query("word_vocab_first_seen", f"WITH {WORD_VOCAB} SELECT token, id FROM vocab")
def _(t):
    return _learned(t).select("token", F.col("id").cast("bigint"))


@query(
    "encode_sequences",
    f"WITH {WORD_VOCAB} SELECT doc_id, array_to_string(ids, ' ') AS ids, n_unknown FROM seqs",
)
def _(t):
    seqs = V.encode_sequences(t.documents, _learned(t))
    return seqs.select("doc_id", joined("ids").alias("ids"), "n_unknown")


@query(
    "pad_sequences",
    f"""
    WITH {WORD_VOCAB}, padded AS (
      SELECT doc_id, ids || list_resize([]::BIGINT[], (SELECT max(len(ids)) FROM seqs) - len(ids), 0) AS ids FROM seqs)
    SELECT doc_id, len(ids) AS n_ids, md5(array_to_string(ids, ' ')) AS ids_md5 FROM padded
    """,
)
def _(t):
    padded = V.pad_sequences(V.encode_sequences(t.documents, _learned(t)))
    return padded.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.md5(joined("ids")).alias("ids_md5"))


@query(
    "padding_mask",
    f"""
    WITH {WORD_VOCAB}, masks AS (
      SELECT doc_id, list_transform(ids, lambda x: CASE WHEN x = 0 THEN 0 ELSE 1 END) AS m FROM seqs)
    SELECT doc_id, array_to_string(m, ' ') AS mask, list_sum(m)::BIGINT AS n_real,
           round(list_sum(m)::DOUBLE / len(m), 6) AS real_ratio FROM masks
    """,
)
def _(t):
    seqs = V.encode_sequences(t.documents, _learned(t))
    masked = seqs.withColumn("m", V.padding_mask(F.col("ids")))
    real = F.aggregate("m", F.lit(0).cast("bigint"), lambda a, x: a + x)
    masked = masked.withColumn("n_real", real)
    ratio = F.round(F.col("n_real") / F.size("m"), 6)
    return masked.select("doc_id", joined("m").alias("mask"), "n_real", ratio.alias("real_ratio"))


@query(
    "decode_sequences",
    f"""
    WITH {WORD_VOCAB}, words_back AS (
      SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS decoded FROM coded WHERE id > 2 GROUP BY doc_id)
    SELECT doc_id, coalesce(decoded, '') AS decoded FROM documents LEFT JOIN words_back USING (doc_id)
    """,
)
def _(t):
    vocab = _learned(t)
    return V.decode_sequences(V.encode_sequences(t.documents, vocab), vocab)
