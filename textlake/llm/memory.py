"""Memory that a worker process gives back to the system.

Spark keeps a worker for later tasks and queries. What its arrays took stays with the process
after they are freed, so that waiting workers fill an executor's memory beside a stage that
runs no Python at all. A task of batches gives it back when it ends. Functions of groups can't
tell their last group; they give it back when a group has left the process much larger.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa

GROWN = 64_000_000  # bytes by which groups may leave a worker larger

_least: list[int] = []  # what the process had when memory was last given back


def held() -> int:
    """Bytes of memory that the process has for itself; 0 where the system doesn't tell."""
    try:
        with open("/proc/self/statm", encoding="ascii") as file:
            _, resident, shared, *_ = map(int, file.read().split())
    except OSError:
        return 0
    return (resident - shared) * os.sysconf("SC_PAGE_SIZE")


def give_back() -> None:
    """Return what is free in the process to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
    _least[:] = [held()]


def give_back_if_grown() -> None:
    """After a group: return what is free, if the process has grown since."""
    if held() > (_least[0] if _least else 0) + GROWN:
        give_back()


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function of a task's batches that gives memory back at the end of the task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def freed_group(run: Callable[[pa.Table], pa.Table]) -> Callable:
    """A function of a group."""

    def group(rows: pa.Table) -> pa.Table:
        try:
            return run(rows)
        finally:
            give_back_if_grown()

    return group


def freed_cogroup(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable:
    """A function of two groups with the same key."""

    def group(one: pa.Table, two: pa.Table) -> pa.Table:
        try:
            return run(one, two)
        finally:
            give_back_if_grown()

    return group
