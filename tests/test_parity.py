"""Every registered query runs at the smallest scale; those with a SQL twin equal it."""

from __future__ import annotations

import pytest

from tests.parity import TESTDATA, compare, connect
from textlake.catalog import QUERIES

FOLDER = TESTDATA / "sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


@pytest.mark.parametrize("name", ["tfidf", "encode_sequences", "zero_shot_scores", "top_entities", "token_blocks"])
def test_no_nested_loops(spark, name):
    plan = QUERIES[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_key_filter_reaches_the_scan(spark):
    plan = QUERIES["doc_word_frequency"](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id" in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan
