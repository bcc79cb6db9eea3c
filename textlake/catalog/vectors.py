"""Vectors, chunks, retrieval, digests and quantization."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.catalog.features import words_of
from textlake.catalog.registry import filled_sql, query
from textlake.functions.fixed import PROMPT_FORMAT
from textlake.operators import chunks as K
from textlake.operators import digest as D
from textlake.operators import quantize as Q
from textlake.operators import retrieval as R
from textlake.operators import vectors as V

VECTORS = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings),
placed AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS place FROM v)"""


def _ranked(source: str, k: int, keep: str) -> str:
    return f"""
    SELECT query_id, vec_id, score, rank::INT AS rank FROM (
      SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
        SELECT query_id, v.vec_id, round(list_cosine_similarity(q.e, v.e), 6) AS score FROM {source} q CROSS JOIN v WHERE {keep}))
    WHERE rank <= {k}"""


@query(
    "pair_similarity",
    f"""
    WITH {VECTORS} SELECT a.vec_id, round(list_cosine_similarity(a.e, b.e), 6) AS similarity
    FROM v a JOIN v b ON b.vec_id = a.vec_id + 1
    """,
)
def _(t):
    a = t.embeddings.select("vec_id", F.col("embedding").alias("a"))
    b = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    found = V.pair_similarity(a.join(b, "vec_id"), "a", "b")
    return found.select("vec_id", F.round("similarity", 6).alias("similarity"))


# The query words are the first vector of every label.
@query(
    "most_similar",
    f"WITH {VECTORS}, q AS (SELECT vec_id AS query_id, e FROM placed WHERE place = 1) {_ranked('q', 3, 'v.vec_id <> query_id')}",
)
def _(t):
    return V.most_similar(t.embeddings, V.first_per_label(t.embeddings, 1), 3)


# Per label: first - second + third vector.
def _terms(t):
    sign = F.when(F.col("place") == 2, -1).otherwise(1)
    return V.first_per_label(t.embeddings, 3).select(F.col("label").cast("bigint").alias("query_id"), "vec_id", sign.alias("sign"))


COMBINED = f"""{VECTORS},
unit AS (SELECT *, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS u FROM placed),
three AS (SELECT label::BIGINT AS query_id, max(vec_id) FILTER (place = 1) AS i1, max(vec_id) FILTER (place = 2) AS i2, max(vec_id) FILTER (place = 3) AS i3,
  any_value(u) FILTER (place = 1) AS u1, any_value(u) FILTER (place = 2) AS u2, any_value(u) FILTER (place = 3) AS u3,
  any_value(e) FILTER (place = 1) AS e1, any_value(e) FILTER (place = 2) AS e2, any_value(e) FILTER (place = 3) AS e3
  FROM unit WHERE place <= 3 GROUP BY label),
units AS (SELECT query_id, i1, i2, i3, list_transform(list_zip(u1, u2, u3), lambda z: z[1] - z[2] + z[3]) AS e FROM three),
plains AS (SELECT query_id, list_transform(list_zip(e1, e2, e3), lambda z: z[1] - z[2] + z[3]) AS e FROM three)"""


@query("analogy", f"WITH {COMBINED} {_ranked('units', 3, 'v.vec_id NOT IN (i1, i2, i3)')}")
def _(t):
    return V.analogy(t.embeddings, _terms(t), 3)


@query("similar_by_vector", f"WITH {COMBINED} {_ranked('plains', 10, 'true')}")
def _(t):
    return V.similar_by_sum(t.embeddings, _terms(t), 10)


@query("lsh_similar")
def _(t):
    return V.lsh_similar(t.embeddings, V.first_per_label(t.embeddings, 1), 10)


@query("lsh_recall")
def _(t):
    chosen = V.first_per_label(t.embeddings, 1)
    return V.recall(V.most_similar(t.embeddings, chosen, 10), V.lsh_similar(t.embeddings, chosen, 10))


@query("word2vec_train")
def _(t):
    return V.word2vec_train(words_of(t))


CHUNKS = """cut AS (SELECT doc_id, text, unnest(range(1 + greatest(ceil((length(text) - 500) / 300.0), 0)::BIGINT)) AS chunk_no FROM documents WHERE text <> ''),
chunks AS (SELECT doc_id, chunk_no, doc_id * 1000000 + chunk_no AS chunk_id, substring(text, chunk_no * 300 + 1, 500) AS text FROM cut)"""


@query("chunk_fixed", f"WITH {CHUNKS} SELECT * FROM chunks")
def _(t):
    return K.chunk_fixed(t.documents)


@query("chunk_recursive")
def _(t):
    return K.chunk_recursive(t.documents)


def _buckets(name: str, key: str, source: str) -> str:
    return f"""{name} AS (SELECT {key}, ('0x' || substr(md5(w), 1, 4))::INT % 256 AS b, count(*) AS n FROM (
      SELECT {key}, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS w FROM {source}) GROUP BY ALL)"""


RETRIEVED = f"""{CHUNKS}, {_buckets("cb", "chunk_id", "chunks")}, {_buckets("qb", "item_id", "benchmark")},
cn AS (SELECT chunk_id, sum(n * n)::DOUBLE AS s FROM cb GROUP BY chunk_id), qn AS (SELECT item_id, sum(n * n)::DOUBLE AS s FROM qb GROUP BY item_id),
dots AS (SELECT item_id, chunk_id, sum(qb.n * cb.n)::DOUBLE AS d FROM qb JOIN cb USING (b) GROUP BY item_id, chunk_id),
dist AS (SELECT item_id AS query_id, chunk_id, 2.0::DOUBLE - 2.0::DOUBLE * (d / sqrt(cn.s * qn.s)) AS distance
         FROM dots JOIN cn USING (chunk_id) JOIN qn USING (item_id)),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id)::INT AS rank FROM dist) WHERE rank <= 4),
contexts AS (SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context FROM hits JOIN chunks USING (chunk_id) GROUP BY query_id)"""


def _questions(t):
    return t.benchmark.select(F.col("item_id").alias("query_id"), "text")


def _contexts(t):
    chunks = K.chunk_fixed(t.documents)
    return R.assemble_context(R.retrieve_top_k(chunks, _questions(t)), chunks)


@query("retrieve_top_k", f"WITH {RETRIEVED} SELECT query_id, chunk_id, round(distance, 9) AS distance, rank FROM hits")
def _(t):
    found = R.retrieve_top_k(K.chunk_fixed(t.documents), _questions(t))
    return found.withColumn("distance", F.round("distance", 9))


@query("assemble_context", f"WITH {RETRIEVED} SELECT query_id, context FROM contexts")
def _(t):
    return _contexts(t)


@query(
    "build_prompts",
    f"""
    WITH {RETRIEVED} SELECT item_id AS query_id, {filled_sql(PROMPT_FORMAT, context="coalesce(context, '')", question="text")} AS prompt
    FROM benchmark LEFT JOIN contexts ON query_id = item_id
    """,
)
def _(t):
    return R.build_prompts(_contexts(t), _questions(t))


PAGES = r"""recs AS (SELECT page_id, nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') AS title, url,
  nullif(trim(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')), '') AS content FROM pages)"""

SEARCH = f"""{PAGES},
pw AS (SELECT page_id, unnest(regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM recs WHERE content IS NOT NULL),
n AS (SELECT count(*) AS n FROM recs WHERE content IS NOT NULL),
idf AS (SELECT term, ln((1.0 + (SELECT n FROM n)) / (1.0 + count(DISTINCT page_id))) + 1.0 AS idf FROM pw GROUP BY term),
pt AS (SELECT page_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY page_id)) AS w FROM (
  SELECT page_id, term, count(*) * any_value(idf) AS w FROM pw JOIN idf USING (term) GROUP BY page_id, term)),
qt AS (SELECT query_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS w FROM (
  SELECT query_id, term, count(*) * any_value(idf) AS w FROM (
    SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM benchmark)
  JOIN idf USING (term) GROUP BY query_id, term)),
found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, page_id)::INT AS rank FROM (
  SELECT query_id, page_id, round(sum(qt.w * pt.w), 6) AS score FROM qt JOIN pt USING (term) GROUP BY query_id, page_id)) WHERE rank <= 5)"""


@query("search_pages", f"WITH {SEARCH} SELECT query_id, page_id, title, url, content, score, rank FROM found JOIN recs USING (page_id)")
def _(t):
    records = R.page_records(t.pages)
    found = R.search_pages(records, _questions(t))
    return R.with_records(found, records)


@query(
    "format_results",
    f"""
    WITH {SEARCH}, texts AS (SELECT query_id, count(*) AS n_articles, string_agg('**Article ' || rank || ':** ' || coalesce(title, 'No Title') || chr(10)
        || '   URL: ' || coalesce(url, '') || chr(10) || '   Summary: ' || coalesce(content, 'No content available.') || chr(10), chr(10) ORDER BY rank) AS results
      FROM found JOIN recs USING (page_id) GROUP BY query_id)
    SELECT item_id AS query_id, coalesce(n_articles, 0) AS n_articles, coalesce(results, 'No results found for the given query.') AS results
    FROM benchmark LEFT JOIN texts ON query_id = item_id
    """,
)
def _(t):
    records = R.page_records(t.pages)
    return R.format_results(_questions(t), R.search_pages(records, _questions(t)), records)


DIGEST_DATE = "2026-07-01"


def topics(t):
    """Every benchmark text is a topic; only long ones have a search query of their own."""
    own = F.when(F.length("text") > 150, F.lower("text"))
    return t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("topic"), own.alias("search_query"))


@query(
    "news_digest",
    f"""
    WITH {SEARCH}, sent AS (SELECT page_id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM (
      SELECT page_id, string_split(regexp_replace(content, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS s FROM recs WHERE content IS NOT NULL)),
    sw AS (SELECT page_id, pos, unnest(regexp_extract_all(lower(sentence), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM sent),
    sc AS (SELECT page_id, pos, round(sum(idf), 4) AS score FROM sw JOIN idf USING (term) GROUP BY page_id, pos),
    best AS (SELECT page_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS r FROM sc) WHERE r <= 2),
    summ AS (SELECT page_id, string_agg(sentence, ' ' ORDER BY pos) AS summary FROM sent JOIN best USING (page_id, pos) GROUP BY page_id),
    per AS (SELECT query_id, string_agg('- ' || coalesce(title, 'No Title'), chr(10) ORDER BY rank) AS heads,
      string_agg(coalesce(summary, 'No content available.'), chr(10) ORDER BY rank) AS bodies, string_agg(coalesce(url, ''), chr(10) ORDER BY rank) AS urls
      FROM found JOIN recs USING (page_id) LEFT JOIN summ USING (page_id) GROUP BY query_id)
    SELECT item_id AS query_id, text AS topic, '**News Digest**' || chr(10) || '**Topic:** ' || text || chr(10) || '**Date:** July 01, 2026' || chr(10) || chr(10) || '---' || chr(10) || chr(10)
      || CASE WHEN heads IS NULL THEN 'No results found for the given query.' ELSE '**Key Headlines**' || chr(10) || heads || chr(10) || chr(10) || '**Articles**' || chr(10) || bodies
      || chr(10) || chr(10) || '**Sources**' || chr(10) || urls END AS digest
    FROM benchmark LEFT JOIN per ON query_id = item_id
    """,
)
def _(t):
    return D.news_digest(topics(t), R.page_records(t.pages), DIGEST_DATE)


QUANT = """cells AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
s AS (SELECT (max(x) - min(x)) / 255.0::DOUBLE AS scale FROM cells),
quant AS (SELECT vec_id, i, x, scale, greatest(least(round_even(x / scale, 0), 127), -128)::INT AS q FROM cells, s)"""


@query("quantize_int8", f"WITH {QUANT} SELECT vec_id, i::INT AS i, q FROM quant")
def _(t):
    cells = F.posexplode("q").alias("i", "q")
    return Q.quantize_int8(t.embeddings).select("vec_id", cells).withColumn("q", F.col("q").cast("int"))


@query("dequantize_error", f"WITH {QUANT} SELECT vec_id, round(avg(abs(x - q * scale)), 9) AS mean_error FROM quant GROUP BY vec_id")
def _(t):
    errors = Q.dequantize_error(Q.quantize_int8(t.embeddings))
    return errors.select("vec_id", F.round("mean_error", 9).alias("mean_error"))


@query("mean_absolute_error", f"WITH {QUANT} SELECT round(avg(abs(x - q * scale)), 9) AS mean_absolute_error FROM quant")
def _(t):
    found = Q.mean_absolute_error(Q.dequantize_error(Q.quantize_int8(t.embeddings)))
    return found.select(F.round("mean_absolute_error", 9).alias("mean_absolute_error"))
