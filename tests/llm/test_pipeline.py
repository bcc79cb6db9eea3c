from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages_follow_one_another(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, {}
    inputs = {name: None for name, _ in corpus_pipeline.STAGES}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = stage(spark, docs, FOLDER)
        rows = [tuple(r) for r in docs.collect()]
        if name != "tokens":
            assert docs.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
        before[name] = rows
    # this table has too few toxic documents to learn from: rows that stay are unchanged, most stay
    whole = {tuple(r) for r in inputs["toxicity"].collect()}
    assert set(before["toxicity"]) <= whole and len(before["toxicity"]) >= 0.8 * len(whole)
    kept = {r[0] for r in brute.near([r[:2] for r in before["toxicity"]], 80) if r[3]}
    assert {r[0] for r in before["near_duplicates"]} == kept
    left = {i: n - gone for i, n, gone, *_ in brute.removed([r[:2] for r in before["near_duplicates"]])}
    for r in before["repeated_passages"]:
        assert left[r[0]] - 6 <= len((r[1] or "").encode()) <= left[r[0]]
        assert r[4] == len(r[1] or "")
    assert set(before["mixing"]) <= set(before["repeated_passages"])
    assert Counter(r[0] for r in before["tokens"]) == Counter(r[0] for r in before["mixing"])


def test_run_is_all_stages(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows.count() > 0
