"""Words and their hashes for whole Arrow batches at once.

A word is a run of bytes other than space and 0x09 to 0x0D, which in UTF-8 is the same as a run of
such characters. Everything here works on one flat byte array per chunk of documents: no Python
code runs per document, word or byte. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# White space and ASCII punctuation: what is left are letters, digits and all of UTF-8 beyond ASCII.
MARKS = np.array([not (chr(i).isalnum() or i >= 0x80) for i in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    up = np.full(size, base, dtype=np.uint64)
    down = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(base: np.uint64, size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(int(base), 1 << max(10, int(size).bit_length()))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64):
    """Hash of ``values[s:e]`` for each pair: a polynomial by prefix sums, then mixed."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and where each row begins; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    skip = column.offset * np.dtype(width).itemsize
    offsets = np.frombuffer(column.buffers()[1], width, len(column) + 1, skip).astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds at most ``size`` bytes of text, or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def valid(column: pa.Array) -> pa.Array:
    """The column itself, or if it holds broken UTF-8, a copy with replacement characters."""
    try:
        column.validate(full=True)
        return column
    except pa.ArrowInvalid:
        raw = column.cast(pa.binary()).to_pylist()
        return pa.array([x if x is None else x.decode("utf-8", "replace") for x in raw], pa.string())


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows and where each row begins; null counts as empty."""
    data, offsets = buffers(column)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return points, leads[offsets]


@dataclass
class Words:
    data: np.ndarray  # bytes of all rows
    starts: np.ndarray  # of words, in data
    ends: np.ndarray
    first: np.ndarray  # word index at which each row begins, and the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        values = self.data.astype(np.uint64) + np.uint64(1)
        return run_hashes(values, self.starts, self.ends, _BYTE_BASE)


def split(column: pa.Array, lower: bool = False, between: np.ndarray = SPACE) -> Words:
    """The words of each row; ``lower`` turns A-Z into a-z first, ``between`` marks separators."""
    data, offsets = buffers(column)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~between[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def gram_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words that stay within a row, and the word each begins at."""
    at = gram_starts(first, k)
    return run_hashes(words, at, at + k, _WORD_BASE), at


def gram_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Words at which a run of ``k`` words of the same row begins."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    return ranges(first[:-1], counts)


def ranges(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (counts[0] numbers), then those of begin[1], and so on."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - counts), counts)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold all rows of the keys in them; needs input sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        before = np.flatnonzero(keys != keys[-1])
        cut = int(before[-1]) + 1 if len(before) else 0
        if held and keys[0] != held[-1].column(key)[held[-1].num_rows - 1].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def lists_of(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from its flat values and the length of each list."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column: the bytes of ``values[cuts[i]:cuts[i + 1]]`` in row i."""
    offsets = (np.asarray(cuts) * values.dtype.itemsize).astype(np.int32)
    body = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    parts = [None, pa.py_buffer(offsets.tobytes()), body]
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, parts)


def unpacked(column, kind) -> np.ndarray:
    """All values of a binary column, row after row."""
    return np.concatenate([_binary(c, kind) for c in pieces(column)] or [np.zeros(0, kind)])


def unpacked_counts(column, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.concatenate(
        [np.diff(_offsets(c)) // size for c in pieces(column)] or [np.zeros(0, np.int64)]
    )


def pieces(column) -> list[pa.Array]:
    return column.chunks if isinstance(column, pa.ChunkedArray) else [column]


def _offsets(c: pa.Array) -> np.ndarray:
    return np.frombuffer(c.buffers()[1], np.int32, len(c) + 1, c.offset * 4).astype(np.int64)


def _binary(c: pa.Array, kind) -> np.ndarray:
    offsets = _offsets(c)
    body = c.buffers()[2]
    if body is None or offsets[-1] == offsets[0]:
        return np.zeros(0, kind)
    # Copied, as a view could be unaligned.
    return np.frombuffer(np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]].tobytes(), kind)
