"""Classification, sentiment, entities, topics and the feedback report."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.catalog.features import TFIDF, UNSEEN, words_of
from textlake.catalog.registry import WORDS, query
from textlake.functions import text as T
from textlake.functions.fixed import ENTITY_TYPES
from textlake.operators import classify as N
from textlake.operators import entities as E
from textlake.operators import features as X
from textlake.operators import report as R
from textlake.operators import sentiment as S
from textlake.operators import topics as L
from textlake.operators.modelsel import in_test
from textlake.plans.staging import stage

NB = f"""{WORDS},
train AS (SELECT * FROM words JOIN labels USING (doc_id) WHERE NOT ({UNSEEN})),
traindocs AS (SELECT doc_id, toxic FROM labels SEMI JOIN documents USING (doc_id) WHERE NOT ({UNSEEN})),
n AS (SELECT count(*) AS n FROM traindocs),
idf AS (SELECT term, ln((1.0 + (SELECT n FROM n)) / (1.0 + count(DISTINCT doc_id))) + 1.0 AS idf FROM train GROUP BY term),
trainw AS (SELECT doc_id, term, toxic, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM (
  SELECT doc_id, term, any_value(toxic) AS toxic, count(*) * any_value(idf) AS w FROM train JOIN idf USING (term) GROUP BY doc_id, term)),
cw AS (SELECT c.toxic AS label, term, coalesce(sum(weight) FILTER (w.toxic = c.toxic), 0) AS w
       FROM trainw w, (SELECT DISTINCT toxic FROM traindocs) c GROUP BY 1, 2),
model AS (SELECT label, term, ln((w + 1) / (sum(w) OVER (PARTITION BY label) + count(*) OVER (PARTITION BY label))) AS ll FROM cw),
prior AS (SELECT toxic AS label, ln(count(*)::DOUBLE / (SELECT n FROM n)) AS lp FROM traindocs GROUP BY toxic)"""


def _nb_model(t):
    labels = t.labels.select("doc_id", F.col("toxic").alias("label")).where(~in_test(F.col("doc_id")))
    return N.nb_train(words_of(t), labels)


@query("nb_train", f"WITH {NB} SELECT label, term, round(ll, 6) AS log_likelihood FROM model")
def _(t):
    return N.nb_table(_nb_model(t)).withColumn("log_likelihood", F.round("log_likelihood", 6))


@query(
    "nb_predict",
    f"""
    WITH {NB}, testw AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM (
      SELECT doc_id, term, count(*) * any_value(idf) AS w FROM words JOIN idf USING (term) WHERE {UNSEEN} GROUP BY doc_id, term)),
    dots AS (SELECT doc_id, label, sum(weight * ll) AS s FROM testw JOIN model USING (term) GROUP BY doc_id, label),
    scores AS (SELECT d.doc_id, p.label, lp + coalesce(s, 0) AS score
      FROM (SELECT doc_id FROM documents WHERE {UNSEEN}) d CROSS JOIN prior p
      LEFT JOIN dots s ON s.doc_id = d.doc_id AND s.label = p.label)
    SELECT doc_id, round(max(score) FILTER (label = 0), 4) AS score_0, round(max(score) FILTER (label = 1), 4) AS score_1,
           CASE WHEN max(score) FILTER (label = 1) > max(score) FILTER (label = 0) THEN 1 ELSE 0 END AS prediction
    FROM scores GROUP BY doc_id
    """,
)
def _(t):
    unseen = words_of(t).where(in_test(F.col("doc_id")))
    found = N.nb_predict(unseen, _nb_model(t))
    return found.withColumns({c: F.round(c, 4) for c in ("score_0", "score_1")})


LEXICON = f"""{WORDS},
counts AS (SELECT term, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 0) AS bad
           FROM words JOIN labels USING (doc_id) GROUP BY term),
tot AS (SELECT count(*) AS v, sum(good) AS g, sum(bad) AS b FROM counts),
lexicon AS (SELECT term, round(ln(((good + 1) / (g + v)::DOUBLE) / ((bad + 1) / (b + v)::DOUBLE)) * 10000)::BIGINT AS weight FROM counts, tot),
sums AS (SELECT doc_id, sum(weight)::BIGINT AS total, count(*) AS n FROM words JOIN lexicon USING (term) GROUP BY doc_id),
scored AS (SELECT doc_id, CASE WHEN total > 0 THEN 'POSITIVE' WHEN total < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS label,
    round(1 / (1 + exp(-abs(coalesce(total / (n * 10000.0::DOUBLE), 0)))), 2) AS confidence
    FROM documents LEFT JOIN sums USING (doc_id)),
stats AS (SELECT count(*) AS total_reviews, count(*) FILTER (label = 'POSITIVE') AS positive_reviews,
    count(*) FILTER (label = 'NEGATIVE') AS negative_reviews,
    round(count(*) FILTER (label = 'POSITIVE') * 100.0::DOUBLE / count(*), 2) AS positive_percentage,
    round(count(*) FILTER (label = 'NEGATIVE') * 100.0::DOUBLE / count(*), 2) AS negative_percentage FROM scored)"""


def _good(t):
    return t.labels.select("doc_id", F.col("quality").alias("label"))


def _scored(t):
    tokens = words_of(t)
    return S.sentiment_score(tokens, S.learned_lexicon(tokens, _good(t)))


@query("sentiment_lexicon", f"WITH {LEXICON} SELECT term, weight FROM lexicon")
def _(t):
    return S.learned_lexicon(words_of(t), _good(t)).select("term", "weight")


@query("sentiment_score", f"WITH {LEXICON} SELECT doc_id, label, confidence FROM scored")
def _(t):
    return _scored(t)


@query("sentiment_summary", f"WITH {LEXICON} SELECT * FROM stats")
def _(t):
    return S.sentiment_summary(_scored(t))


@query(
    "distinctive_terms",
    f"""
    WITH {LEXICON}, sides AS (SELECT 'POSITIVE' AS label, term, weight FROM lexicon UNION ALL SELECT 'NEGATIVE', term, -weight FROM lexicon)
    SELECT * FROM (SELECT label, row_number() OVER (PARTITION BY label ORDER BY weight DESC, term) AS rank, term, weight FROM sides)
    WHERE rank <= 10
    """,
)
def _(t):
    return S.distinctive_terms(words_of(t), _good(t))


@query(
    "zero_shot_scores",
    f"""
    WITH {TFIDF}, pc AS (SELECT lang AS label, term, count(DISTINCT doc_id) AS n FROM words JOIN documents USING (doc_id) GROUP BY 1, 2),
    prof AS (SELECT label, term, n / sqrt(sum(n * n) OVER (PARTITION BY label)) AS lw FROM pc),
    cells AS (SELECT doc_id, label, coalesce(s, 0) AS c FROM documents CROSS JOIN (SELECT DISTINCT lang AS label FROM documents)
      LEFT JOIN (SELECT doc_id, label, sum(weight * lw) AS s FROM tfidf JOIN prof USING (term) GROUP BY ALL) USING (doc_id, label)),
    sm AS (SELECT doc_id, label, round(exp(c) / sum(exp(c)) OVER (PARTITION BY doc_id), 6) AS score FROM cells)
    SELECT doc_id, label, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label)::INT AS rank FROM sm
    """,
)
def _(t):
    docs = t.documents.select("doc_id", "lang", "text")
    tokens = X.tokenized(docs)
    return N.zero_shot_scores(X.tfidf(tokens), docs, N.label_profiles(tokens, "lang"))


# The phrase list: every run of one to four words of every benchmark text. SQL goes from each document's start on
# behind a match or by one token, in doubled steps: 2 ** STEPS of them cover a document.
STEPS = 17
_REACHED = ",\n".join(
    f"""s{k + 1} AS MATERIALIZED (SELECT * FROM s{k} UNION ALL SELECT s.doc_id, j.nxt FROM s{k} s JOIN j{k} j USING (doc_id, pos)),
j{k + 1} AS MATERIALIZED (SELECT a.doc_id, a.pos, b.nxt FROM j{k} a JOIN j{k} b ON a.doc_id = b.doc_id AND a.nxt = b.pos)"""
    for k in range(STEPS)
)
ENTITIES = f"""{WORDS},
bt AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM benchmark),
sizes AS (SELECT unnest([1, 2, 3, 4]) AS n),
places AS (SELECT item_id, t, unnest(range(1, len(t) + 1)) AS p FROM bt),
gaz AS (SELECT entity, ['PRODUCT', 'ORG', 'GPE', 'PERSON'][1 + min(item_id) % 4] AS type
  FROM (SELECT item_id, array_to_string(t[p:p + n - 1], ' ') AS entity FROM places, sizes WHERE p + n - 1 <= len(t)) GROUP BY entity),
spots AS (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS p FROM toks),
grams AS (SELECT doc_id, p - 1 AS start, n AS len, array_to_string(t[p:p + n - 1], ' ') AS entity FROM spots, sizes WHERE p + n - 1 <= len(t)),
cand AS MATERIALIZED (SELECT doc_id, start, max(len) AS len, arg_max(type, len) AS type, arg_max(entity, len) AS entity FROM grams JOIN gaz USING (entity) GROUP BY ALL),
j0 AS MATERIALIZED (SELECT words.doc_id, pos, pos + coalesce(len, 1) AS nxt FROM words LEFT JOIN cand ON cand.doc_id = words.doc_id AND start = pos),
s0 AS (SELECT doc_id, 0::BIGINT AS pos FROM toks WHERE len(t) > 0),
{_REACHED},
mentions AS (SELECT c.doc_id, start::INT AS start, len, type, entity FROM cand c JOIN s{STEPS} s ON s.doc_id = c.doc_id AND s.pos = c.start)"""


def _gazetteer(t):
    tokens = t.benchmark.select("item_id", T.word_tokens(F.col("text")).alias("tokens"))

    def runs(n: int):
        starts = F.sequence(F.lit(1), F.size("tokens") - n + 1)
        run = F.transform(starts, lambda i: F.array_join(F.slice("tokens", i, n), " "))
        return F.when(F.size("tokens") >= n, run).otherwise(F.array().cast("array<string>"))

    phrases = tokens.select("item_id", F.explode(F.concat(*[runs(n) for n in range(1, 5)])).alias("entity"))
    first = phrases.groupBy("entity").agg(F.min("item_id").alias("item_id"))
    types = F.array(*[F.lit(x) for x in ENTITY_TYPES])
    kind = F.get(types, (F.col("item_id") % 4).cast("int"))
    return stage(first.select("entity", kind.alias("type")), "gazetteer")


def _mentions(t):
    return E.entity_mentions(words_of(t), _gazetteer(t))


@query("extract_entities", f"WITH {ENTITIES} SELECT * FROM mentions")
def _(t):
    return _mentions(t)


TOP = """topent AS (SELECT * FROM (SELECT type, row_number() OVER (PARTITION BY type ORDER BY n DESC, d, s) AS rank, entity, n FROM (
  SELECT type, entity, count(*) AS n, min(doc_id) AS d, arg_min(start, {'d': doc_id, 's': start}) AS s FROM mentions GROUP BY type, entity))
  WHERE rank <= 5)"""


@query("top_entities", f"WITH {ENTITIES}, {TOP} SELECT * FROM topent")
def _(t):
    return E.top_entities(_mentions(t))


@query(
    "iob_tags",
    f"""
    WITH {ENTITIES}, tags AS (SELECT doc_id, start AS pos, 'B-' || type AS tag FROM mentions
      UNION ALL SELECT doc_id, start + unnest(range(1, len)), 'I-' || type FROM mentions)
    SELECT doc_id, pos::INT AS pos, term AS token, coalesce(tag, 'O') AS tag FROM words LEFT JOIN tags USING (doc_id, pos)
    """,
)
def _(t):
    return E.iob_tags(words_of(t), _mentions(t))


@query("lda_topics")
def _(t):
    return L.lda_topics(L.fit_topics(words_of(t)), t.spark)


@query("lda_infer")
def _(t):
    tokens = words_of(t)
    seen = tokens.where(~in_test(F.col("doc_id")))
    return L.lda_infer(L.fit_topics(seen, iterations=10), tokens.where(in_test(F.col("doc_id"))))


@query("topics_by_sentiment")
def _(t):
    return L.topics_by_sentiment(words_of(t), _scored(t))


HEADING = "CASE type WHEN 'PRODUCT' THEN 'Products' WHEN 'ORG' THEN 'Organization' WHEN 'GPE' THEN 'Locations' ELSE 'People Mentioned' END"


@query(
    "feedback_report",
    f"""
    WITH {ENTITIES}, {TOP}, {LEXICON.removeprefix(WORDS + ",")},
    five AS (SELECT row_number() OVER (ORDER BY doc_id) AS i, * FROM (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 5) JOIN scored USING (doc_id))
    SELECT '1 statistics' AS section, 1 AS line_no, 'Total Reviews: ' || total_reviews AS line FROM stats
    UNION ALL SELECT '1 statistics', 2, format('Positive Reviews: {{}} ({{:.2f}}%)', positive_reviews, positive_percentage) FROM stats
    UNION ALL SELECT '1 statistics', 3, format('Negative Reviews: {{}} ({{:.2f}}%)', negative_reviews, negative_percentage) FROM stats
    UNION ALL SELECT '2 reviews', i::INT, format('{{}}. Review: {{}} | Sentiment: {{}} (Confidence: {{:.2f}})', i, text, label, confidence) FROM five
    UNION ALL SELECT '2 reviews', 6, format('... and {{}} more reviews analyzed', total_reviews - 5) FROM stats WHERE total_reviews > 5
    UNION ALL SELECT '4 entities', (CASE type WHEN 'PRODUCT' THEN 1 WHEN 'ORG' THEN 2 WHEN 'GPE' THEN 3 ELSE 4 END * 100 + rank)::INT,
      format('{{}} - {{}} (mentioned {{}} times)', {HEADING}, entity, n) FROM topent
    """,
)
def _(t):
    tokens = words_of(t)
    return R.feedback_report(t.documents, tokens, S.learned_lexicon(tokens, _good(t)), _gazetteer(t))


@query("feedback_report_with_topics")
def _(t):
    tokens = words_of(t)
    topics = L.lda_topics(L.fit_topics(tokens), t.spark)
    return R.feedback_report(t.documents, tokens, S.learned_lexicon(tokens, _good(t)), _gazetteer(t), topics)
