"""Cleaning, tokenization and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.catalog.registry import WORDS, query, quoted
from textlake.functions import fixed
from textlake.functions import text as T
from textlake.operators import cleaning as C
from textlake.operators import vocab as V

STOP_SQL = quoted(fixed.STOP_WORDS)
LEMMA_SQL = ", ".join(f"('{k}', '{v}')" for k, v in fixed.LEMMAS.items())


@query("take_first_n", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 5000")
def _(t):
    return C.take_first_n(t.documents.select("doc_id", "text"), "doc_id", 5000)


@query(
    "text_stage_chain",
    # full upper-casing turns the sharp s into SS
    "SELECT doc_id, upper(replace(text, 'ß', 'ss')) || '!' AS text FROM documents",
)
def _(t):
    return t.documents.select("doc_id", "text").transform(C.upper_stage).transform(C.exclaim_stage)


@query(
    "clean_text",
    r"""
    SELECT * FROM (
      SELECT doc_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS text FROM documents
    ) WHERE text <> ''
    """,
)
def _(t):
    return t.documents.select("doc_id", "text").transform(C.clean_text)


@query(
    "map_labels",
    """
    SELECT doc_id, CASE toxic WHEN 1 THEN 1 WHEN 0 THEN 0 END AS label
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def _(t):
    name = F.when(F.col("toxic") == 1, "spam").when(F.col("toxic") == 0, "ham").otherwise("other")
    named = t.documents.select("doc_id").join(t.labels, "doc_id", "left").withColumn("name", name)
    return named.select("doc_id", C.map_labels(F.col("name"), {"spam": 1, "ham": 0}).alias("label"))


@query(
    "missing_report",
    """
    SELECT count(*) AS before, count(*) FILTER (quality IS NULL OR toxic IS NULL) AS dropped,
           count(*) FILTER (quality IS NOT NULL AND toxic IS NOT NULL) AS remaining
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def _(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return C.missing_report(joined)


@query(
    "drop_missing_rows",
    "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def _(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return C.drop_missing_rows(joined)


@query(
    "split_features_target",
    """
    SELECT 'o_totalprice' AS feature, count(o_totalprice) AS n FROM orders
    UNION ALL SELECT 'o_orderpriority', count(o_orderpriority) FROM orders
    UNION ALL SELECT 'target:o_orderstatus', count(o_orderstatus) FROM orders
    """,
)
def _(t):
    table = t.orders.select("o_totalprice", "o_orderpriority", "o_orderstatus")
    features, target = C.split_features_target(table, "o_orderstatus")
    counts = features.agg(*[F.count(c).alias(c) for c in features.columns])
    counts = counts.unpivot([], features.columns, "feature", "n")
    only = target.agg(F.lit("target:o_orderstatus").alias("feature"), F.count("o_orderstatus").alias("n"))
    return counts.unionByName(only)


@query(
    "safe_topic",
    r"""
    SELECT page_id, substring(replace(regexp_replace(
        regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '[^\p{L}\p{N} _-]', '', 'g'), ' ', '_'), 1, 50) AS safe_topic
    FROM pages
    """,
)
def _(t):
    return t.pages.select("page_id", T.safe_topic(T.page_title(F.col("html"))).alias("safe_topic"))


@query(
    "default_result_fields",
    r"""
    SELECT d.doc_id, coalesce(nullif(regexp_extract(p.html, '(?is)<title>(.*?)</title>', 1), ''), 'No Title') AS title,
           coalesce(p.url, '') AS url, coalesce(d.text, 'No content available.') AS content
    FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id
    """,
)
def _(t):
    pages = t.pages.select(
        F.col("page_id").alias("doc_id"), "url", F.nullif(T.page_title(F.col("html")), F.lit("")).alias("title")
    )
    docs = t.documents.select("doc_id", F.col("text").alias("content"))
    return C.default_result_fields(docs.join(pages, "doc_id", "left"))


@query(
    "ws_tokens",
    r"""
    SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM (
      SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS t FROM documents)
    """,
)
def _(t):
    tokens = F.posexplode(T.ws_tokens(F.col("text"))).alias("pos", "token")
    return t.documents.select("doc_id", tokens).withColumn("pos", F.col("pos").cast("bigint"))


@query("word_tokens", f"WITH {WORDS} SELECT doc_id, pos, term AS token FROM words")
def _(t):
    tokens = F.posexplode(T.word_tokens(F.col("text"))).alias("pos", "token")
    return t.documents.select("doc_id", tokens).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "punct_tokens",
    r"""
    SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM (
      SELECT doc_id, regexp_extract_all(
        regexp_replace(text, '(?i)(n''t|''(?:s|re|ve|m|ll|d))\b', ' \1', 'g'),
        '[\p{L}\p{N}]*''\p{L}+|[\p{L}\p{N}]+|[^\s\p{L}\p{N}]') AS t FROM documents)
    """,
)
def _(t):
    tokens = F.posexplode(T.punct_tokens(F.col("text"))).alias("pos", "token")
    return t.documents.select("doc_id", tokens).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "sentences",
    r"""
    SELECT doc_id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM (
      SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents)
    """,
)
def _(t):
    rows = F.posexplode(T.sentences(F.col("text"))).alias("pos", "sentence")
    return t.documents.select("doc_id", rows).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "char_tokens",
    """
    SELECT ch, count(*) AS n FROM (
      SELECT unnest(string_split(lower(text), '')) AS ch FROM documents) WHERE ch <> '' GROUP BY ch
    """,
)
def _(t):
    return V.char_frequency(t.documents, lower=True)


@query(
    "remove_stopwords",
    f"""
    SELECT doc_id, len(t) AS n_before, len(k) AS n_after, array_to_string(k, ' ') AS tokens FROM (
      SELECT doc_id, t, list_filter(t, lambda x: x NOT IN ({STOP_SQL})) AS k FROM (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS t FROM documents))
    """,
)
def _(t):
    tokens = t.documents.select("doc_id", T.ws_tokens(F.col("text")).alias("tokens"))
    tokens = tokens.withColumn("n_before", F.size("tokens").cast("bigint"))
    kept = C.remove_stopwords(tokens)
    return kept.select(
        "doc_id", "n_before", F.size("tokens").cast("bigint").alias("n_after"), F.array_join("tokens", " ").alias("tokens")
    )


@query(
    "lemmatize_lookup",
    f"""
    WITH {WORDS}, lemmas(form, lemma) AS (VALUES {LEMMA_SQL})
    SELECT term AS token, coalesce(lemma, term) AS lemma, count(*) AS n
    FROM words LEFT JOIN lemmas ON form = term GROUP BY 1, 2
    """,
)
def _(t):
    tokens = t.documents.select(F.explode(T.word_tokens(F.col("text"))).alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    return C.lemma_lookup(counts, C.lemma_table(t.spark)).select("token", "lemma", "n")


@query(
    "lemmatize_documents",
    f"""
    WITH {WORDS}, lemmas(form, lemma) AS (VALUES {LEMMA_SQL})
    SELECT doc_id, coalesce(tokens, '') AS tokens FROM documents LEFT JOIN (
      SELECT doc_id, string_agg(coalesce(lemma, term), ' ' ORDER BY pos) AS tokens FROM words LEFT JOIN lemmas ON form = term GROUP BY doc_id) USING (doc_id)
    """,
)
def _(t):
    tokens = t.documents.select("doc_id", T.word_tokens(F.col("text")).alias("tokens"))
    return C.lemmatize_with(tokens, C.lemma_table(t.spark)).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query(
    "normalise_corpus",
    f"""
    WITH {WORDS}, lemmas(form, lemma) AS (VALUES {LEMMA_SQL}),
    kept AS (SELECT doc_id, pos, coalesce(lemma, term) AS token FROM words LEFT JOIN lemmas ON form = term
             WHERE term NOT IN ({STOP_SQL}))
    SELECT doc_id, coalesce(tokens, '') AS tokens FROM documents LEFT JOIN (
      SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS tokens FROM kept GROUP BY doc_id) USING (doc_id)
    WHERE trim(text) <> ''
    """,
)
def _(t):
    return C.normalise_corpus(t.documents).select("doc_id", F.array_join("tokens", " ").alias("tokens"))
