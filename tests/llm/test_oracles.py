from __future__ import annotations

from collections import Counter

import pytest

from tests.parity import TESTDATA, connect, plain
from textlake.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    folder = TESTDATA / "sf0.001"
    found = QUERIES[name](spark, str(folder))
    result = connect(folder).sql(ORACLES[name])
    assert sorted(found.columns) == sorted(result.columns)
    order = [result.columns.index(c) for c in found.columns]
    rows = Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    assert Counter(tuple(map(plain, r)) for r in found.collect()) == rows
