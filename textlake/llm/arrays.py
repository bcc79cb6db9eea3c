"""Texts as byte arrays: Arrow columns in bounded pieces, words, hashes and ranges in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 2_000_000  # bytes of text worked on at once; a longer text is a piece of its own

U = np.uint64
ODD_A, ODD_B, ODD_C = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xBF58476D1CE4E5B9)

BYTES = np.arange(256)
IS_SPACE = np.isin(BYTES, [32, 9, 10, 11, 12, 13])
LOWER = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype("uint8")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> U(30))
    x = x * ODD_C
    x ^= x >> U(27)
    x *= ODD_B
    x ^= x >> U(31)
    return x


def spreads(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, count + 1, dtype="uint64") * ODD_A + U(seed))


BYTE_CODES = spreads(256, 11)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string() if not pa.types.is_binary(column.type) else pa.large_binary())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, "int64")[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return np.empty(0, "uint8"), np.zeros(1, "int64")
    data = np.frombuffer(data, "uint8")[offsets[0] : offsets[-1]] if data else np.empty(0, "uint8")
    return data, offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts are at most `most` bytes together, or a single row."""
    row, last = 0, len(offsets) - 1
    while row < last:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), last)
        yield row, end
        row = end


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i] … starts[i] + sizes[i] - 1, one range after the other."""
    sizes = np.asarray(sizes, "int64")
    total = int(sizes.sum())
    if total == 0:
        return np.empty(0, "int64")
    ends = np.cumsum(sizes)
    return np.arange(total, dtype="int64") + np.repeat(np.asarray(starts, "int64") - (ends - sizes), sizes)


def cut(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, which also end where a text ends."""
    n = len(inside)
    if n == 0:
        return np.empty(0, "int64"), np.empty(0, "int64")
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class Powers:
    """Powers of an odd number and of its inverse, for hashes of any range from prefix sums."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, "uint64")

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            for name, number in (("up", self.base), ("down", self.inverse)):
                factors = np.full(size, number, "uint64")
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype="uint64"))
        return self.up, self.down


POWERS = Powers()


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = BYTE_CODES) -> np.ndarray:
    """64-bit hashes of the byte strings data[starts[i]:ends[i]]; equal strings, equal hashes."""
    up, down = POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, "uint64")
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + mix((ends - starts).astype("uint64")))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the word with A-Z lower-cased, row, start) of every [^\\x20\\x09-\\x0D]+."""
    starts, ends = cut(~IS_SPACE[data], offsets)
    hashes = range_hashes(LOWER[data], starts, ends)
    return hashes, np.searchsorted(offsets, starts, "right") - 1, starts


def packed(values: np.ndarray) -> bytes:
    """An array as compressed bytes: columns of equal significance together."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(values).view("uint8").reshape(-1, values.dtype.itemsize).T.tobytes()
    )


def unpacked(blob: bytes, dtype: str) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "uint8")
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def packed_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_sorted(blob: bytes, dtype: str) -> np.ndarray:
    return np.cumsum(unpacked(blob, dtype), dtype=dtype)


def row_ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers that sort; null sorts last."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).fill_null(np.iinfo("int64").max).to_numpy(zero_copy_only=False)
