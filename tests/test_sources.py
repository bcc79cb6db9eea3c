"""Files by lines and by byte ranges, counted writes, dictionaries as tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textlake.operators import cleaning
from textlake.plans.staging import stage
from textlake.sources import files


def test_lines_of_a_file_read_in_ranges(spark, tmp_path):
    wanted = [f"line {i} é" * (i % 5) for i in range(20_000)]
    (tmp_path / "one.txt").write_text("\n".join(wanted), encoding="utf-8")
    (tmp_path / "two.md").write_text("other", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        lines = files.read_text_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        rows = lines.orderBy("path", "block_start", "place").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["line"] for r in rows] == wanted and {r["path"].rsplit("/", 1)[1] for r in rows} == {"one.txt"}


def test_no_text_files(spark, tmp_path):
    for read in (files.read_text_lines, files.read_text_corpus):
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path))


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    docs = spark.range(500).select(F.col("id").alias("doc_id")).mapInArrow(count, "doc_id long")
    assert files.write_processed_corpus(docs, str(tmp_path / "out")).count() == 500
    assert calls.value == 500  # computed once
    assert files.write_processed_corpus(docs.limit(0), str(tmp_path / "none")).count() == 0


def test_a_large_dictionary_is_a_table(spark):
    forms = spark.range(100_000).select(F.concat(F.lit("w"), "id").alias("form"), F.concat(F.lit("v"), "id").alias("lemma"))
    dictionary = stage(forms, "test")
    docs = [(1, ["w5", "x", "w5", "w99999"]), (2, []), (3, None), (4, ["x", None])]
    tokens = spark.createDataFrame(docs, "doc_id long, tokens array<string>")
    found = cleaning.lemmatize_with(tokens, dictionary)
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 10_000
    assert {r["doc_id"]: r["tokens"] for r in found.collect()} == {1: ["v5", "x", "v5", "v99999"], 2: [], 3: None, 4: ["x", None]}
    assert [tuple(r) for r in cleaning.lemma_lookup(spark.createDataFrame([("w7",)], "token string"), dictionary).collect()] == [("w7", "v7")]
