"""Feature extraction and corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.catalog.registry import WORDS, query
from textlake.operators import features as X
from textlake.operators.modelsel import in_test

TFIDF = f"""{WORDS},
n AS (SELECT count(*) AS n FROM documents),
idf AS (SELECT term, count(DISTINCT doc_id) AS df, ln((1.0 + (SELECT n FROM n)) / (1.0 + count(DISTINCT doc_id))) + 1.0 AS idf
        FROM words GROUP BY term),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
raw_w AS (SELECT doc_id, term, tf, tf * idf AS w FROM tf JOIN idf USING (term)),
tfidf AS (SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw_w)"""

# Documents whose key falls in the 20 % hash bucket are the unseen ones.
UNSEEN = "('0x' || substr(md5('42:' || doc_id), 1, 4))::INT < 13107"




def words_of(t):
    return X.tokenized(t.documents.select("doc_id", "text"))


@query(
    "vocabulary",
    f"WITH {WORDS} SELECT term, row_number() OVER (ORDER BY term) - 1 AS index FROM (SELECT DISTINCT term FROM words)",
)
def _(t):
    return X.vocabulary(words_of(t))


@query("bag_of_words", f"WITH {WORDS} SELECT doc_id, term, count(*) AS count FROM words GROUP BY doc_id, term")
def _(t):
    return X.bag_of_words(words_of(t))


@query(
    "doc_word_frequency",
    f"WITH {WORDS} SELECT doc_id, term, count(*) AS count FROM words WHERE doc_id = 3 GROUP BY doc_id, term",
)
def _(t):
    return X.doc_word_frequency(t.documents, 3)


@query("tfidf", f"WITH {TFIDF} SELECT doc_id, term, tf, round(weight, 6) AS weight FROM tfidf")
def _(t):
    return X.tfidf(words_of(t)).withColumn("weight", F.round("weight", 6))


@query(
    "tfidf_top_terms",
    f"""
    WITH {TFIDF}, r AS (SELECT doc_id, term, round(weight, 6) AS weight,
        row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 6) DESC, term) AS rank FROM tfidf)
    SELECT doc_id, term, weight, rank FROM r WHERE rank <= 5
    """,
)
def tfidf_top_terms(t):
    weights = X.tfidf(words_of(t)).select("doc_id", "term", F.round("weight", 6).alias("weight"))
    return X.top_terms(weights, 5).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "tfidf_matrix_sample",
    f"""
    WITH {TFIDF}, first AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place FROM (
      SELECT doc_id FROM documents ORDER BY doc_id LIMIT 5))
    SELECT term, {", ".join(f"coalesce(max(round(weight, 6)) FILTER (place = {i}), 0.0)::DOUBLE AS doc_{i}" for i in range(1, 6))}
    FROM tfidf JOIN first USING (doc_id) GROUP BY term
    """,
)
def _(t):
    wide = X.tfidf_matrix_sample(t.documents, 5)
    return wide.select("term", *[F.round(f"doc_{i}", 6).alias(f"doc_{i}") for i in range(1, 6)])


@query(
    "tfidf_transform_unseen",
    f"""
    WITH {WORDS},
    train AS (SELECT * FROM words WHERE NOT ({UNSEEN})), test AS (SELECT * FROM words WHERE {UNSEEN}),
    n AS (SELECT count(*) AS n FROM documents WHERE NOT ({UNSEEN})),
    idf AS (SELECT term, ln((1.0 + (SELECT n FROM n)) / (1.0 + count(DISTINCT doc_id))) + 1.0 AS idf FROM train GROUP BY term),
    raw_w AS (SELECT doc_id, term, count(*) AS tf, count(*) * any_value(idf) AS w FROM test JOIN idf USING (term) GROUP BY doc_id, term)
    SELECT doc_id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw_w
    """,
)
def _(t):
    tokens = words_of(t)
    idf = X.idf_table(tokens.where(~in_test(F.col("doc_id"))))
    scored = X.tfidf_transform(tokens.where(in_test(F.col("doc_id"))), idf)
    return scored.withColumn("weight", F.round("weight", 6))


@query(
    "corpus_stats",
    f"""
    WITH {WORDS}
    SELECT (SELECT count(*) FROM documents) AS n_docs, (SELECT sum(length(text))::BIGINT FROM documents) AS n_chars,
           round((SELECT sum(length(text)) FROM documents) / 1e6, 2) AS size_mb, (SELECT count(*) FROM words) AS n_tokens, (SELECT count(*) // 512 FROM words) AS n_samples,
           (SELECT count(*) FROM (SELECT DISTINCT doc_id, term FROM words)) AS n_cells,
           (SELECT count(DISTINCT term) FROM words) AS vocab_size
    """,
)
def _(t):
    return X.corpus_stats(t.documents)
