"""Registered queries give the same rows when every size bound is tiny, as on very big tables."""

from __future__ import annotations

import pytest

from tests.parity import TESTDATA, compare, connect
from textlake.plans import lookup, nearest, ranking

FOLDER = TESTDATA / "sf0.001"
NAMES = ["tfidf", "nb_predict", "encode_sequences", "numeric_summary_by_target", "token_blocks", "next_token_top_p", "search_pages"]


@pytest.fixture
def tiny_bounds(monkeypatch):
    monkeypatch.setattr(lookup.lookup, "__defaults__", (None, "left", 50, 10**9))
    monkeypatch.setattr(ranking.running_total, "__defaults__", (None, None, "running", None, 300))
    monkeypatch.setattr(ranking.split_points, "__defaults__", (300,))
    monkeypatch.setattr(nearest, "SPARSE_QUERY_BLOCK", 17)
    monkeypatch.setattr(nearest, "SPARSE_CELL_BLOCK", 200)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, tiny_bounds, name):
    assert compare(spark, connect(FOLDER), name, FOLDER) == ""
