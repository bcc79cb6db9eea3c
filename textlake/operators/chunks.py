"""Cutting documents into overlapping chunks."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_SIZE, CHUNK_OVERLAP = 500, 200
SEPARATORS = ("\n\n", "\n", " ", "")  # fixed values: paragraph, line, space, character
CHUNKS_PER_DOC = 1_000_000  # spacing of chunk ids


def window_count(n, size: int, step: int):
    """Windows needed to cover n items."""
    more = F.greatest(F.ceil((n - size) / F.lit(step)), F.lit(0)).cast("int")
    return F.lit(1) + more


def chunk_fixed(docs: DataFrame, size: int = CHUNK_SIZE, step: int = CHUNK_SIZE - CHUNK_OVERLAP) -> DataFrame:
    """(doc_id, chunk_no, chunk_id, text): fixed windows over the whole text."""
    last = window_count(F.length("text"), size, step) - 1
    rows = docs.where(F.length("text") > 0).select(
        "doc_id", "text", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no")
    )
    return rows.select(
        "doc_id",
        F.col("chunk_no").cast("bigint"),
        (F.col("doc_id") * CHUNKS_PER_DOC + F.col("chunk_no")).alias("chunk_id"),
        F.substring("text", F.col("chunk_no") * step + 1, F.lit(size)).alias("text"),
    )


def _pieces(text: str, separator: str) -> list[str]:
    """Split, each separator staying at the start of the piece that follows it."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in [head, *(separator + r for r in rest)] if p]


def _packed(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    """Join neighbours up to `size`; start the next chunk with up to `overlap` kept characters."""
    held: deque[str] = deque()
    length = 0
    for piece in pieces:
        if length + len(piece) > size:
            if held:
                yield "".join(held).strip()
            while length and (length > overlap or length + len(piece) > size):
                length -= len(held.popleft())
        held.append(piece)
        length += len(piece)
    if held:
        yield "".join(held).strip()


def split_text(text: str, size: int, overlap: int, separators: tuple[str, ...] = SEPARATORS) -> Iterator[str]:
    place = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    finer = separators[place + 1 :]
    small: list[str] = []
    for piece in _pieces(text, separators[place]):
        if len(piece) < size:
            small.append(piece)
            continue
        yield from filter(None, _packed(small, size, overlap))
        small = []
        if finer:
            yield from split_text(piece, size, overlap, finer)
        else:
            yield piece
    yield from filter(None, _packed(small, size, overlap))


def chunk_recursive(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """(doc_id, chunk_no, chunk_id, text): split at paragraphs, then lines, spaces, characters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cut = [
                (doc_id, number, chunk)
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True)
                for number, chunk in enumerate(split_text(text or "", size, overlap))
            ]
            if cut:
                yield pd.DataFrame(cut, columns=["doc_id", "chunk_no", "text"])

    cut = docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, chunk_no bigint, text string")
    chunk_id = F.col("doc_id") * CHUNKS_PER_DOC + F.col("chunk_no")
    return cut.select("doc_id", "chunk_no", chunk_id.alias("chunk_id"), "text")
