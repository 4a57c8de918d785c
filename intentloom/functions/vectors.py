"""Vector columns: cut, unit length, dot product, signature.

Arithmetic over whole vectors runs on Arrow batches with NumPy: Spark evaluates
higher-order functions value by value, which measured many times slower.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from intentloom.functions.text import col
from intentloom.params import SIGNATURE_DECIMALS


def has_dim(v: Column | str, dim: int) -> Column:
    """Usable for a cut to ``dim``: long enough and present."""
    return F.coalesce(F.size(col(v)) >= dim, F.lit(False))


def cut(v: Column | str, dim: int | None) -> Column:
    """First ``dim`` values; too short a vector gives null (checked by the caller)."""
    if dim is None:
        return col(v)
    if dim <= 0:
        raise ValueError(f"dim must be positive or None, got {dim}")
    return F.when(F.size(col(v)) >= dim, F.slice(col(v), 1, dim))


def sizes_of(lists: pa.Array) -> np.ndarray:
    """List lengths, 0 for a null list."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def as_lists(values: pa.Array, sizes: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    """Consecutive values cut into lists of the given sizes."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=None if null is None else pa.array(null))


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def _sum_each(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), values, minlength=len(sizes))


def unit(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Consecutive vectors scaled to unit length; a zero vector stays as it is."""
    wide = values.astype(np.float64)
    norms = np.sqrt(_sum_each(wide * wide, sizes))
    norms[norms == 0] = 1
    return (wide / np.repeat(norms, sizes)).astype(np.float32)


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _normalize(v: pa.Array) -> pa.Array:
    sizes = sizes_of(v)
    null = v.is_null().to_numpy(zero_copy_only=False)
    return as_lists(pa.array(unit(_flat(v), sizes)), sizes, null)


def normalize(v: Column | str) -> Column:
    return _normalize(col(v))


@F.arrow_udf(T.DoubleType())
def _dot(a: pa.Array, b: pa.Array) -> pa.Array:
    sizes = sizes_of(a)
    if not np.array_equal(sizes, sizes_of(b)):
        raise ValueError("vectors of different length; check them with vector_dim_check first")
    return pa.array(_sum_each(_flat(a) * _flat(b), sizes))


def dot(a: Column | str, b: Column | str) -> Column:
    return _dot(col(a), col(b))


def signature(v: Column | str, decimals: int = SIGNATURE_DECIMALS) -> Column:
    """SHA-256 over the whole rounded vector, so that a distinct moves 64 bytes per row."""

    @F.arrow_udf(T.StringType())
    def digest(lists: pa.Array) -> pa.Array:
        rounded = np.round(_flat(lists), decimals) + 0.0  # no negative zero
        ends = np.cumsum(sizes_of(lists))
        parts = np.split(rounded, ends[:-1])
        return pa.array([hashlib.sha256(p.tobytes()).hexdigest() for p in parts], pa.string())

    return digest(col(v))
