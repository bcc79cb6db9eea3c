from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from textlake.llm import memory, suffix_dedup

MB = 1_000_000


def littered(pins: list) -> None:
    """Frees 144 MB of arrays that lie below one that stays, which keeps them with the process."""
    arrays = [np.ones(12_000) for _ in range(1500)]
    pins.append(np.ones(12_000))
    del arrays


def test_a_task_gives_memory_back():
    pins: list = []

    def run(batches):
        for batch in batches:
            littered(pins)
            yield batch

    batch = pa.RecordBatch.from_pydict({"x": [1]})
    memory.give_back()
    before = memory.held()
    assert list(memory.freed(run)(iter([batch]))) == [batch]
    assert memory.held() < before + 60 * MB


@pytest.mark.parametrize("wrap", [memory.freed_group, memory.freed_cogroup])
def test_groups_give_memory_back_when_it_has_grown(wrap, monkeypatch):
    pins: list = []
    run = wrap((lambda a: littered(pins)) if wrap is memory.freed_group else (lambda a, b: littered(pins)))
    memory.give_back()
    before = memory.held()
    run(*[None] * (1 if wrap is memory.freed_group else 2))
    assert memory.held() < before + memory.GROWN
    trims = []
    monkeypatch.setattr(memory, "give_back", lambda: trims.append(1))
    wrap(lambda *a: None)(*[None] * (1 if wrap is memory.freed_group else 2))
    assert not trims  # little was taken


def test_repeated_passages_take_one_worker_a_task(spark):
    """The remaining text is made where the passages are removed, not by a function of its own."""
    docs = spark.createDataFrame([(1, "é" * 60), (2, "z" + "é" * 60 + "end")], "doc_id long, text string")
    plan = suffix_dedup.drop_repeated(docs)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "ArrowEvalPython" not in plan
