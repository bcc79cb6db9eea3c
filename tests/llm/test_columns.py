"""Stages carry columns along whatever their names, and take nulls, blanks, repeats and empty tables."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest

from textlake.llm import minhash, mixing, suffix_dedup, toxicity

NAMES = (
    "spans kept shard part topic answer sorter data sizes docs offset node root n sketch bands shingles n_shingles component_id "
    "_kept _text_hash _size _nth _copy _copies _k0 _k1 _k2 _k3 _s size source_size target copies rate score offending label said "
    "a.b carried_0 text_hash"
).split()
LONG = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, LONG + " end one", "x"),
    (2, LONG + " end two", "y"),
    (2, LONG + " end two", "y"),
    (3, "some other words that nobody else has", None),
    (4, "", "x"),
    (5, None, "y"),
    (None, "a text without a number", "x"),
    (6, " \t ", None),
    (7, "seven is long " * 3000, "z"),
]


def table(spark, rows):
    kinds = ", ".join(f"`{c}` string" for c in NAMES)
    own = [(*row, *(f"{c} of {row[0]}" for c in NAMES)) for row in rows]
    return spark.createDataFrame(own, f"doc_id bigint, text string, source string, {kinds}")


def stages(spark):
    labels = spark.createDataFrame([(1, 0), (3, 1), (5, 1), (None, 1)], "doc_id bigint, toxic int")
    return {
        "toxicity": lambda docs: toxicity.drop_toxic(docs, labels),
        "near": minhash.drop_near_duplicates,
        "repeated": suffix_dedup.drop_repeated,
        "mixing": mixing.mix,
    }


@pytest.mark.parametrize("name", ["toxicity", "near", "repeated", "mixing"])
def test_clashing_columns_stay(spark, name):
    docs = table(spark, ROWS)
    found = stages(spark)[name](docs)
    assert found.schema.simpleString() == docs.schema.simpleString()
    rows = found.collect()
    assert rows and all(row[c] == f"{c} of {row['doc_id']}" for row in rows for c in NAMES)
    counts = Counter(row["doc_id"] for row in rows)
    assert counts.keys() <= {row[0] for row in ROWS}
    if name == "near":
        assert counts == Counter([1, 3, 4, 5, 6, 7, None])
    if name == "repeated":
        assert counts == Counter(row[0] for row in ROWS)
        # the passage goes from the second document, and the rows of documents 4 to 6 have nothing to lose
        texts = {row["doc_id"]: row["text"] for row in rows}
        assert texts[1] == ROWS[0][1] and len(texts[2]) < 20 and texts[5] is None and texts[6] == " \t "


@pytest.mark.parametrize("name", ["toxicity", "near", "repeated", "mixing"])
def test_empty_tables(spark, name):
    docs = table(spark, ROWS).where("false")
    found = stages(spark)[name](docs)
    assert found.columns == docs.columns and found.count() == 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    for i, rows in enumerate((ROWS, [])):
        there = tmp_path / str(i)
        docs = [{"doc_id": d, "text": t, "source": s, "lang": "en", "n_chars": len(t or "")} for d, t, s in rows]
        spark.createDataFrame([tuple(row[f.name] for f in schema) for row in docs], schema).write.parquet(f"{there}/documents.parquet")
        spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{there}/labels.parquet")
        ids = {row["doc_id"] for row in corpus_pipeline.run(spark, str(there)).collect()}
        assert ids <= {row[0] for row in rows} and bool(ids) == bool(rows)
