"""The registered queries of this subpackage, each an operator over a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textlake.llm import (
    bpe_stream, conversation_repair, embedding_dedup, interpolation, language_id, minhash, mixing, ranked_search, suffix_dedup, token_files, toxicity, warc, weighted_sampling,
)
from textlake.plans.shipping import ship


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated strings of 50 bytes removed from all documents."""
    return suffix_dedup.repeated_digests(_table(spark, folder, "documents"))


def op2_weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return weighted_sampling.edited_fingerprints(_table(spark, folder, "documents"))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(_table(spark, folder, "documents"), similarity=85)


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token ids, written and read back."""
    return token_files.written_tokens(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document."""
    return interpolation.scored(_table(spark, folder, "documents"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mixing.mixed_words(_table(spark, folder, "documents"))


def op7_bpe_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded again."""
    return bpe_stream.digested(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.toxic_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages archived and read back."""
    return warc.archived(_table(spark, folder, "pages"))


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings."""
    return embedding_dedup.near_vectors(_table(spark, folder, "embeddings"))


def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    return language_id.predicted(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations damaged and repaired."""
    return conversation_repair.damaged_and_repaired(_table(spark, folder, "conversations"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked_search.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), top=50)


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_weighted_sampling, op3_minhash, op4_token_files, op5_interpolation, op6_mixing, op7_bpe_stream, op8_toxicity, op9_warc, op10_embedding_dedup,
    op11_language_id, op12_conversation_repair, op13_ranked_search,
)}
# Components in SQL: everything reachable over links(x, y), which holds both directions.
_REACH = """reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x, least(x, min(y)) AS component_id FROM reach GROUP BY x)"""

def _edit(state: str, cost: object, initials: str) -> str:
    """The state after an edit; none without state or cost."""
    return f"CASE WHEN ({state}) IS NOT NULL AND ({cost}) IS NOT NULL THEN {{'c': ({state}).c + {cost}, 'a': ({state}).a || '{initials}'}} END"


ORACLES: dict[str, str] = {
    "op3_minhash": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
{_REACH}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least ON x = doc_id""",
    "op9_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
best AS (SELECT payload_digest, payload_bytes, max(page_id) AS best FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN best <> page_id THEN best END AS refers_to
FROM p LEFT JOIN best USING (payload_digest, payload_bytes)""",
    "op10_embedding_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS r FROM v WHERE len(e) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.r > 0 AND b.r > 0 AND list_inner_product(a.e, b.e) / (a.r * b.r) >= 0.95),
{_REACH}
SELECT vec_id, coalesce(k, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT x, count(*) AS k FROM links GROUP BY x) c ON c.x = vec_id LEFT JOIN least ON least.x = vec_id""",
    "op12_conversation_repair": f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295::BIGINT, list_reduce(
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT)) % 20 AS code FROM conversations, crc),
hurt AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
  CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, code,
  unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM keyed),
placed AS (SELECT *, left(role, 1) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k FROM hurt),
flawed AS (SELECT *, lead(i) OVER (PARTITION BY conv_id ORDER BY k) AS next,
  CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
ids AS (SELECT DISTINCT conv_id FROM conversations),
-- s0 to s3: least (cost, audit) at the beginning, behind s, behind u and behind a
dp AS (
  SELECT conv_id, 0::BIGINT AS k, {{'c': 0::BIGINT, 'a': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR) AS s1,
    {{'c': 3::BIGINT, 'a': 'I'}} AS s2, {{'c': 6::BIGINT, 'a': 'II'}} AS s3 FROM ids
  UNION ALL
  SELECT conv_id, k, t0, t1, least({_edit('t0', 3, 'I')}, {_edit('t1', 3, 'I')}, t2, {_edit('t3', 3, 'I')}),
    least({_edit('t0', 6, 'II')}, {_edit('t1', 6, 'II')}, {_edit('t2', 3, 'I')}, t3)
  FROM (SELECT dp.conv_id, f.k, {_edit('s0', 4, 'D')} AS t0,
      least({_edit('s1', 4, 'D')}, CASE WHEN f.i = 's' THEN {_edit('s0', 'keep', 'K')} END) AS t1,
      least({_edit('s2', 4, 'D')}, CASE WHEN f.i = 'u' THEN {_edit('least(s0, s1, s3)', 'keep', 'K')} ELSE {_edit('least(s0, s1, s3)', 'keep + 3', 'R')} END) AS t2,
      least({_edit('s3', 4, 'D')}, CASE WHEN f.i = 'a' THEN {_edit('s2', 'keep', 'K')} ELSE {_edit('s2', 'keep + 3', 'R')} END) AS t3
    FROM dp JOIN (SELECT conv_id, k, i, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 3 END AS keep FROM flawed) f
      ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.k = dp.k + 1)),
best AS (SELECT conv_id, min(least(s0, s3)) AS b FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) AS r FROM dp) WHERE r = 1 GROUP BY conv_id),
edits AS (SELECT conv_id, unnest(string_split(b.a, '')) AS e, unnest(range(len(b.a))) AS pos FROM best WHERE b.a <> ''),
taken AS (SELECT *, CASE WHEN e <> 'I' THEN count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) END AS k FROM edits),
stays AS (SELECT t.conv_id, t.e, t.pos, f.role, f.i, CASE WHEN t.e = 'I' THEN '' ELSE f.text END AS text,
    row_number() OVER (PARTITION BY t.conv_id ORDER BY t.pos) AS n
  FROM taken t LEFT JOIN flawed f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.k = t.k WHERE t.e <> 'D'),
told AS (SELECT *, (n + max(CASE WHEN n = 1 AND e = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)) % 2 AS odd FROM stays),
texts AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN odd = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS whole
  FROM told GROUP BY conv_id),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (next IS NOT NULL AND i || next NOT IN ('su', 'ua', 'au')) AS illegal FROM flawed GROUP BY conv_id)
SELECT best.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b.c AS cost, b.a AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM best LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM best.conv_id""",
    "op13_ranked_search": """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
sizes AS (SELECT row_number() OVER () AS row, doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
tf AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(ts) AS term FROM sizes)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term, docs),
parts AS (SELECT row, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS part
  FROM tf JOIN w USING (term) JOIN sizes USING (row), total),
scores AS (SELECT item_id, row, sum(part)::BIGINT AS score FROM q JOIN parts USING (term) GROUP BY ALL HAVING sum(part) > 0),
ranks AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores JOIN sizes USING (row))
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 50""",
}
