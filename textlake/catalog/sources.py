"""File sources and sinks: tables are written in the wanted format, then read by the source."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.catalog.registry import query
from textlake.catalog.tables import BANK, bank
from textlake.catalog.features import words_of
from textlake.operators import bpe as B
from textlake.operators import cleaning as C
from textlake.operators import stemming as M
from textlake.plans.staging import new_path
from textlake.sources import files as S

BANK_SCHEMA = (
    "o_orderkey BIGINT, o_totalprice DOUBLE, c_acctbal DOUBLE, o_orderpriority STRING, c_mktsegment STRING, o_orderstatus STRING"
)


@query(
    "read_delimited",
    f"WITH {BANK} SELECT o_orderkey, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, o_orderstatus FROM bank",
)
def _(t):
    path = new_path(t.spark, "bank-csv")
    bank(t).write.option("sep", ";").option("header", True).csv(path)
    return S.read_delimited(t.spark, path, BANK_SCHEMA)


@query(
    "read_labelled_tsv",
    r"""
    SELECT CASE toxic WHEN 1 THEN 'spam' ELSE 'ham' END AS label, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS message
    FROM documents JOIN labels USING (doc_id)
    """,
)
def _(t):
    path = new_path(t.spark, "messages-tsv")
    label = F.when(F.col("toxic") == 1, "spam").otherwise("ham")
    labelled = t.documents.transform(C.clean_text).join(t.labels, "doc_id")
    labelled.select(F.concat_ws("\t", label, "text")).write.text(path)
    return S.read_labelled_tsv(t.spark, path)


@query(
    "read_text_corpus",
    "SELECT source, sum(length(text) + 1)::BIGINT AS n_chars FROM documents GROUP BY source",
)
def _(t):
    path = new_path(t.spark, "corpus-txt")
    t.documents.select("source", "text").write.partitionBy("source").text(path)
    corpus = S.read_text_corpus(t.spark, path)
    source = F.regexp_extract("path", "source=([^/]*)/", 1)
    return corpus.groupBy(source.alias("source")).agg(F.sum(F.length("text")).alias("n_chars"))


@query(
    "read_text_lines",
    """
    SELECT source, sum(len(string_split(text, chr(10))))::BIGINT AS n_lines, sum(length(replace(text, chr(10), '')))::BIGINT AS n_chars
    FROM documents GROUP BY source
    """,
)
def _(t):
    path = new_path(t.spark, "corpus-lines")
    t.documents.select("source", "text").write.partitionBy("source").text(path)
    source = F.regexp_extract("path", "source=([^/]*)/", 1)
    lines = S.read_text_lines(t.spark, path).groupBy(source.alias("source"))
    return lines.agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query(
    "write_digest_files",
    r"""
    WITH named AS (
      SELECT '20260701_120000_' || substring(replace(regexp_replace(text, '[^\p{L}\p{N} _-]', '', 'g'), ' ', '_'), 1, 50) AS name, text,
             'Topic: ' || text || chr(10) AS digest FROM benchmark),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY text, digest) AS n FROM named)
    SELECT CASE WHEN n > 1 THEN name || '_' || n ELSE name END AS name, digest FROM numbered
    """,
)
def _(t):
    digests = t.benchmark.select(F.col("text").alias("topic"), F.concat(F.lit("Topic: "), "text").alias("digest"))
    return S.write_digest_files(digests, new_path(t.spark, "digests"), "20260701_120000")


@query(
    "write_processed_corpus",
    r"""
    SELECT * FROM (SELECT doc_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS text FROM documents) WHERE text <> ''
    """,
)
def _(t):
    cleaned = t.documents.select("doc_id", "text").transform(C.clean_text)
    return S.write_processed_corpus(cleaned, new_path(t.spark, "processed"))


@query("write_tokenizer_tables")
def _(t):
    vocab, merges = B.tokenizer_tables(t.spark, B.bpe_train(B.word_counts(t.documents)))
    vocab, merges = S.write_tokenizer_tables(vocab, merges, new_path(t.spark, "tokenizer"))
    return vocab.join(merges.withColumn("token", F.concat("left", "right")), "token", "left")


@query("stem_vocabulary")
def _(t):
    return M.stem_vocabulary(words_of(t))


@query("stem_conflation")
def _(t):
    return M.conflation_groups(M.stem_vocabulary(words_of(t)))
