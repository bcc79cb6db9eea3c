"""Documents packed into shards, written once, and questions that shards ask of one another.

A shard is a few megabytes of documents as one compressed Arrow block. Shards are written to
a bucketed table, so that answers are brought to them without moving the texts again.

A question is an array of 64-bit keys, sorted and distinct, with numbers beside them. A shard
sends the keys of each key range as one compressed block; a range's task combines the blocks of
all shards and answers each block by arrays in the order of its keys. Nothing but arrays
is shuffled, a key of a third of all rows is sent once by each shard, and the ranges are as
many as the session's shuffle partitions.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.arrays import packed, packed_sorted, pieces, text_bytes, unpacked, unpacked_sorted
from textlake.llm.memory import freed, freed_cogroup, freed_group
from textlake.plans.staging import new_path, stage

SHARD = 2_000_000  # bytes of text in a shard, or one document


def block(table: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue()


def opened(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all().combine_chunks()


def ranges_of(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def packed_shards(docs: DataFrame, text: str = "text") -> DataFrame:
    """(shard, docs): blocks of rows with all their columns, written and bucketed by shard."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def put() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"shard": [base + number], "docs": pa.array([block(pa.Table.from_batches(held))], pa.binary())})

        for batch in batches:
            _, offsets = text_bytes(batch.column(text))
            for first, last in pieces(offsets, SHARD // 4):
                part = int(offsets[last] - offsets[first])
                if held and size + part > SHARD:
                    yield put()
                    number, held, size = number + 1, [], 0
                held.append(batch.slice(first, last - first))
                size += part
        if held:
            yield put()

    name = f"shards_{uuid.uuid4().hex}"
    rows = docs.mapInArrow(freed(run), "shard bigint, docs binary")
    writer = rows.write.format("parquet").option("path", new_path(spark, "shards")).bucketBy(ranges_of(docs), "shard")
    writer.saveAsTable(name)
    return spark.table(name)


Asked = tuple[np.ndarray, np.ndarray]  # sorted distinct keys, and a number for each


def bounds_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the keys of each range begin, with the end."""
    edges = [(i << 64) // parts for i in range(parts)]
    return np.append(np.searchsorted(keys, np.array(edges, "uint64")), len(keys))


def ask(shards: DataFrame, questions: Callable[[pa.Table], list[Asked]], answer: Callable, kinds: list[str]) -> DataFrame:
    """(shard, topic, part, answer, sums): for each question of each shard, an array per key range.

    answer(topic, keys, numbers) gets the keys of all shards in a range, not sorted, and returns
    an array in the same order, of the kind that kinds has for the topic, and some sums over
    the range, which come in a row without shard. The result is written.
    """
    parts = ranges_of(shards)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                rows = []
                for topic, (keys, numbers) in enumerate(questions(opened(batch.column("docs")[row].as_buffer()))):
                    at = bounds_of(keys, parts)
                    for p in np.flatnonzero(np.diff(at)):
                        some = slice(at[p], at[p + 1])
                        rows.append({"topic": topic, "part": int(p), "shard": batch.column("shard")[row].as_py(), "keys": packed_sorted(keys[some]), "numbers": packed(numbers[some].astype("uint64"))})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, sent)

    sent = pa.schema([("topic", pa.int32()), ("part", pa.int32()), ("shard", pa.int64()), ("keys", pa.binary()), ("numbers", pa.binary())])
    asked = shards.mapInArrow(freed(send), "topic int, part int, shard bigint, keys binary, numbers binary")

    def combine(rows: pa.Table) -> pa.Table:
        topic = rows.column("topic")[0].as_py()
        keys = [unpacked_sorted(x.as_buffer(), "uint64") for x in rows.column("keys")]
        numbers = [unpacked(x.as_buffer(), "uint64") for x in rows.column("numbers")]
        sizes = [len(k) for k in keys]
        found, sums = answer(topic, np.concatenate(keys), np.concatenate(numbers))
        at = np.cumsum([0, *sizes])
        answers = [packed(found[at[i] : at[i + 1]].astype(kinds[topic])) for i in range(len(sizes))]
        part = rows.column("part")[0].as_py()
        return pa.table(
            {
                "shard": pa.array([*rows.column("shard").to_pylist(), None], pa.int64()),
                "topic": pa.array([topic] * (len(sizes) + 1), pa.int32()),
                "part": pa.array([part] * (len(sizes) + 1), pa.int32()),
                "answer": pa.array([*answers, None], pa.binary()),
                "sums": pa.array([None] * len(sizes) + [[int(x) for x in sums]], pa.list_(pa.int64())),
            }
        )

    kind = "shard bigint, topic int, part int, answer binary, sums array<bigint>"
    return stage(asked.groupBy("topic", "part").applyInArrow(freed_group(combine), kind), "answers")


def summed(replies: DataFrame, topic: int, count: int) -> list[int]:
    """The sums of a question over all ranges."""
    rows = replies.where(F.col("shard").isNull() & (F.col("topic") == topic))
    row = rows.agg(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)) for i in range(count)]).first()
    return list(row)


def totals(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key the sum of its numbers and in how many places it is, in the order given."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(first, len(ordered)))
    sums = np.add.reduceat(numbers[order].astype("int64"), first)
    one, two = np.empty(len(keys), "int64"), np.empty(len(keys), "int64")
    one[order], two[order] = np.repeat(sums, sizes), np.repeat(sizes, sizes)
    return one, two


def answers_of(replies: pa.Table, kinds: list[str]) -> list[np.ndarray]:
    """For each question of a shard the answers in the order of its keys."""
    found = []
    for topic, kind in enumerate(kinds):
        rows = sorted((p, a) for t, p, a in zip(*(replies.column(c).to_pylist() for c in ("topic", "part", "answer")), strict=True) if t == topic)
        found.append(np.concatenate([unpacked(a, kind) for _, a in rows]) if rows else np.empty(0, kind))
    return found


def answered(shards: DataFrame, replies: DataFrame, run: Callable, schema: str, what: str = "shard") -> DataFrame:
    """run(documents, replies) for each shard, where the shard lies."""

    def both(one: pa.Table, two: pa.Table) -> pa.Table:
        return run(opened(one.column("docs")[0].as_buffer()), two)

    known = replies.where(F.col(what).isNotNull())
    return shards.groupBy("shard").cogroup(known.groupBy(what)).applyInArrow(freed_cogroup(both), schema)


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

