"""Feature encoding: category tables of any size, sparse cells, centring."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from textlake.operators import classify, modelsel

ROWS = [(1, 2.0, "b", "x", "yes"), (2, 4.0, "a", "y", "no"), (3, 6.0, "c", "x", "yes"), (4, 8.0, "b", None, None), (5, 5.0, "d", "x", "no")]
KIND = "k long, num double, cat string, other string, target string"


def test_cells_of_a_small_table(spark):
    df = spark.createDataFrame(ROWS, KIND)
    train = df.where("k < 5")
    encoder = modelsel.fit_encoder(df, train, "target", ["num"], ["cat", "other"])
    encoded = encoder.apply(df, "k")
    assert encoder.size == 5 and encoded.columns == ["k", "label", "indices", "values"]
    found = {r["k"]: r for r in encoded.collect()}
    assert [found[k]["label"] for k in range(1, 6)] == [1, 0, 1, None, 0]
    assert [found[k]["indices"] for k in range(1, 6)] == [[0, 1], [0, 4], [0, 2], [0, 1], [0, 3]]
    cells = {(r["k"], r["feature"]): r["value"] for r in encoder.cells(encoded, "k").collect()}
    assert len(cells) == 5 * 5
    assert math.isclose(cells[1, "num"], (2 - 5) / math.sqrt(5)) and math.isclose(cells[1, "cat=b"], 1.0)
    assert math.isclose(cells[2, "cat=b"], -1.0) and math.isclose(cells[2, "other=y"], 0.75 / math.sqrt(3 / 16))
    assert cells[5, "cat=d"] == 1.0 and cells[1, "cat=d"] == 0.0  # not in training: no scale
    vectors = {r["k"]: r["vector"] for r in encoder.vectors(encoded).collect()}
    assert vectors[2].size == 5 and vectors[2].indices.tolist() == [0, 4]


def test_a_million_categories(spark):
    """Categories are joined in: no list of them in the plan, none on the driver."""
    df = spark.range(1_000_000).select(F.col("id").alias("k"), F.concat(F.lit("c"), "id").alias("cat"), (F.col("id") % 2).cast("string").alias("target"))
    encoder = modelsel.fit_encoder(df, df.where("k % 5 > 0"), "target", [], ["cat"])
    encoded = encoder.apply(df, "k")
    assert encoder.size == 999_999
    assert len(encoded._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    row = encoded.agg(F.count_distinct(F.get("indices", F.lit(0))).alias("cells"), F.count_if(F.size("indices") == 0).alias("none")).first()
    assert (row["cells"], row["none"]) == (999_999, 1)


def test_three_models_on_sparse_vectors(spark):
    rows = [(i, float(i % 7), f"c{i % 40}", "y" if i % 40 < 17 else "n") for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, num double, cat string, target string")
    train, test = modelsel.train_test_split(df, "k")
    encoder = modelsel.fit_encoder(df, train, "target", ["num"], ["cat"])
    parts = [encoder.vectors(encoder.apply(p, "k")) for p in (train, test)]
    found = modelsel.accuracy(modelsel.fit_predict(*parts, ["Logistic Regression", "Decision Tree"])).collect()
    assert [r["accuracy"] > bar for r, bar in zip(sorted(found, key=lambda r: r["ordinal"]), (0.99, 0.95), strict=True)] == [True, True]


def test_too_many_classes_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(classify, "MAX_CLASSES", 2)
    with pytest.raises(ValueError, match="more than 2"):
        classify.class_list(spark.createDataFrame([("a",), ("b",), ("c",)], "text string"), "text")
