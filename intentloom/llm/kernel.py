"""NumPy helpers over Arrow batches of text: byte views, word spans and prefix polynomial hashes.

All arithmetic on hashes is modulo 2**64, which unsigned arrays do by themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = [np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for seed in (7, 11)]
_powers: dict[tuple[int, bool], np.ndarray] = {}


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows of about ``limit`` bytes; a longer text is alone."""
    data, at = bytes_of(column)
    row, n = 0, len(at) - 1
    while row < n:
        last = min(max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1), n)
        yield row, last, data[at[row] : at[last]], at[row : last + 1] - at[row]
        row = last


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def powers(n: int, which: int = 0, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1), or those of its inverse."""
    key = (which, inverse)
    if key not in _powers or len(_powers[key]) < n:
        base = pow(BASES[which], -1, 2**64) if inverse else BASES[which]
        out = np.full(max(n, 2 * CHUNK_BYTES), base, np.uint64)
        out[0] = 1
        _powers[key] = np.multiply.accumulate(out)
    return _powers[key][:n]


def prefix_hashes(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums H with hash(i, j) = (H[j] - H[i]) * base**-i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[which][data] * powers(len(data), which), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    return (prefix[end] - prefix[start]) * powers(len(prefix), which, True)[start]


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each row): words are runs of bytes other than white space; rows end words."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    start = np.flatnonzero(inside[1:-1] & (cut[:-1] | ~inside[:-2]))
    end = np.flatnonzero(inside[1:-1] & (cut[1:] | ~inside[2:])) + 1
    return start, end, np.searchsorted(start, at)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, first word of each row)."""
    start, end, first = words(data, at)
    return mix(span_hashes(prefix_hashes(lower(data)), start, end)), first


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word windows of a run of words; fewer words make one shorter window."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(k, n)
    out = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        out = (out + hashes[j : n - size + 1 + j]) * np.uint64(BASES[1])
        out ^= out >> np.uint64(31)
    return mix(out)


def where_arrow(df: DataFrame, column: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """Rows for which ``keep`` of a column's batch is true; all columns stay and no row moves."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch.column(at))))

    return df.mapInArrow(run, df.schema)
