"""Table profiling and model selection, on orders joined to customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.catalog.registry import query
from textlake.operators import modelsel as M
from textlake.operators import profile as P
from textlake.plans.lookup import lookup
from textlake.plans.staging import stage

BANK = """bank AS (SELECT o_orderkey, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, o_orderstatus,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS pos
         FROM orders JOIN customer ON o_custkey = c_custkey)"""
TEST = "('0x' || substr(md5('42:' || o_orderkey), 1, 4))::INT < 13107"
NUMERIC = ["o_totalprice", "c_acctbal"]
CATEGORICAL = ["o_orderpriority", "c_mktsegment"]


def bank(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", *NUMERIC, *CATEGORICAL, "o_orderstatus")


def positive():
    return F.col("o_orderstatus") == "F"


def rounded(df, digits, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


_DOCS = [("doc_id", "bigint"), ("lang", "string"), ("quality", "int"), ("toxic", "int")]


@query(
    "table_profile",
    "WITH j AS (SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i}::BIGINT AS position, '{d}' AS dtype, count(*) AS n_rows, 4::BIGINT AS n_columns, "
        f"count(*) - count({c}) AS n_nulls, 4 * count(*) - count(doc_id) - count(lang) - count(quality) - count(toxic) "
        f"AS total_nulls FROM j"
        for i, (c, d) in enumerate(_DOCS, 1)
    ),
)
def _(t):
    return P.table_profile(t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left"))


@query(
    "class_balance",
    """
    SELECT event_type AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM events)::DOUBLE, 6) AS percent
    FROM events GROUP BY event_type
    """,
)
def _(t):
    return rounded(P.class_balance(t.events, "event_type"), 6, "percent")


def _summary_sql(source: str, by: str) -> str:
    group, first = (f" GROUP BY {by}", f"{by}, ") if by else ("", "")
    return " UNION ALL ".join(
        f"""SELECT {first}'{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75 FROM {source}{group}"""
        for c in NUMERIC
    )


@query("numeric_summary", f"WITH {BANK} {_summary_sql('bank', '')}")
def _(t):
    return rounded(P.numeric_summary(bank(t), NUMERIC), 4, "mean", "std", "q25", "q50", "q75")


@query("numeric_summary_by_target", f"WITH {BANK} {_summary_sql('bank', 'o_orderstatus')}")
def _(t):
    return rounded(P.numeric_summary(bank(t), NUMERIC, ["o_orderstatus"]), 4, "mean", "std", "q25", "q50", "q75")


@query(
    "categorical_vs_target",
    f"""
    WITH {BANK} SELECT o_orderpriority AS category, count(*) AS n, sum(pos)::BIGINT AS positives, round(avg(pos), 6) AS rate
    FROM bank GROUP BY ROLLUP (o_orderpriority)
    """,
)
def _(t):
    return rounded(P.categorical_vs_target(bank(t), "o_orderpriority", positive()), 6, "rate")


@query(
    "numeric_vs_target",
    f"WITH {BANK} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg({c}) FILTER (pos = 1), 4) AS mean_pos, "
        f"round(avg({c}) FILTER (pos = 0), 4) AS mean_neg, round(corr({c}, pos), 6) AS corr FROM bank"
        for c in NUMERIC
    ),
)
def _(t):
    found = P.numeric_vs_target(bank(t), NUMERIC, positive())
    return rounded(rounded(found, 4, "mean_pos", "mean_neg"), 6, "corr")


@query(
    "rate_by_quantile_bin",
    f"""
    WITH {BANK}, e AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM bank)
    SELECT (1 + (o_totalprice > q[1])::INT + (o_totalprice > q[2])::INT + (o_totalprice > q[3])::INT)::BIGINT AS bin,
           count(*) AS n, sum(pos)::BIGINT AS positives, round(avg(pos), 6) AS rate
    FROM bank, e GROUP BY 1
    """,
)
def _(t):
    return rounded(P.rate_by_bin(bank(t), "o_totalprice", positive()), 6, "rate")


LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for i, a in enumerate(LINE)
        for b in LINE[i + 1 :]
    ),
)
def _(t):
    return rounded(P.correlation_matrix(t.lineitem, LINE), 6, "corr")


def _encoded(t, table=None):
    table = bank(t) if table is None else table
    train, _ = M.train_test_split(table, "o_orderkey")
    return table, M.fit_encoder(table, train, "o_orderstatus", NUMERIC, CATEGORICAL)


@query(
    "encode_features",
    f"""
    WITH {BANK}, cells AS (
      SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS label, {TEST} AS test, 'o_totalprice' AS feature, o_totalprice AS v FROM bank
      UNION ALL SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderstatus) - 1, {TEST}, 'c_acctbal', c_acctbal FROM bank
      UNION ALL SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderstatus) - 1, {TEST}, 'o_orderpriority=' || c, (o_orderpriority = c)::INT::DOUBLE
        FROM bank, (SELECT DISTINCT o_orderpriority AS c FROM bank WHERE o_orderpriority > (SELECT min(o_orderpriority) FROM bank))
      UNION ALL SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderstatus) - 1, {TEST}, 'c_mktsegment=' || c, (c_mktsegment = c)::INT::DOUBLE
        FROM bank, (SELECT DISTINCT c_mktsegment AS c FROM bank WHERE c_mktsegment > (SELECT min(c_mktsegment) FROM bank))),
    fit AS (SELECT feature, avg(v) AS m, stddev_pop(v) AS s FROM cells WHERE NOT test GROUP BY feature)
    SELECT o_orderkey, label::INT AS label, feature, round((v - m) / s, 6) AS value FROM cells JOIN fit USING (feature)
    """,
)
def _(t):
    table, encoder = _encoded(t)
    cells = encoder.cells(encoder.apply(table, "o_orderkey"), "o_orderkey")
    return cells.select("o_orderkey", "label", "feature", F.round("value", 6).alias("value"))


@query(
    "train_test_split",
    f"SELECT o_orderkey, CASE WHEN {TEST} THEN 'test' ELSE 'train' END AS part FROM orders",
)
def _(t):
    train, test = M.train_test_split(t.orders.select("o_orderkey"), "o_orderkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _predictions(t, names):
    table = bank(t)
    table = table.withColumn("o_orderstatus", F.when(positive(), "yes").otherwise("no"))
    table, encoder = _encoded(t, table)
    train, test = (encoder.vectors(encoder.apply(part, "o_orderkey")) for part in M.train_test_split(table, "o_orderkey"))
    return M.fit_predict(train, test, names)


@query("fit_logistic_regression")
def _(t):
    return _predictions(t, ["Logistic Regression"])


@query("fit_decision_tree")
def _(t):
    return _predictions(t, ["Decision Tree"])


@query("fit_random_forest")
def _(t):
    return _predictions(t, ["Random Forest"])


@query("compare_models")
def _(t):
    return M.accuracy(_predictions(t, M.MODEL_NAMES))


@query("best_trained_model")
def _(t):
    return M.model_report(stage(M.accuracy(_predictions(t, M.MODEL_NAMES)), "accuracies"))


# One rule-based classifier per language: a text is good when it is not toxic.
RULES = """preds AS (SELECT lang AS model, quality AS label, 1 - toxic AS prediction FROM labels JOIN documents USING (doc_id)),
models AS (SELECT model, dense_rank() OVER (ORDER BY model) - 1 AS ordinal, label, prediction FROM preds),
acc AS (SELECT model, ordinal::INT AS ordinal, avg((label = prediction)::INT) AS accuracy FROM models GROUP BY ALL)"""


def _rule_predictions(t):
    joined = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
    langs = M.value_ranks(joined, "lang").withColumnRenamed("value", "lang")
    return lookup(joined, langs, ["lang"], weight="n", how="inner").select(
        F.col("lang").alias("model"),
        (F.col("rank") - 1).cast("int").alias("ordinal"),
        F.col("quality").alias("label"),
        (1 - F.col("toxic")).alias("prediction"),
    )


@query("accuracy", f"WITH {RULES} SELECT model, ordinal, round(accuracy, 6) AS accuracy FROM acc")
def _(t):
    return rounded(M.accuracy(_rule_predictions(t)), 6, "accuracy")


@query(
    "select_best_model",
    f"WITH {RULES} SELECT model, round(accuracy, 6) AS accuracy FROM acc ORDER BY acc.accuracy DESC, ordinal LIMIT 1",
)
def _(t):
    return rounded(M.select_best_model(M.accuracy(_rule_predictions(t))), 6, "accuracy")


@query(
    "model_report",
    f"""
    WITH {RULES}, best AS (SELECT model, accuracy FROM acc ORDER BY accuracy DESC, ordinal LIMIT 1)
    SELECT format('Best model: {{}} with accuracy {{:.4f}}. All accuracies: {{{{{{}}}}}}', model, accuracy,
      (SELECT string_agg(format('''{{}}'': {{:.4f}}', model, accuracy), ', ' ORDER BY ordinal) FROM acc)) AS report FROM best
    """,
)
def _(t):
    return M.model_report(M.accuracy(_rule_predictions(t)))
