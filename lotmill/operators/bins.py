"""Cut points per feature, and rows as small bin numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BINS = 256  # bin 0 holds missing values
ACCURACY = 10_000


def as_array(column: str, df: DataFrame) -> Column:
    """A feature column (ml vector or array) as array<double>."""
    from pyspark.ml.functions import vector_to_array

    kind = df.schema[column].dataType.typeName()
    return vector_to_array(column) if kind.startswith("vector") else F.col(column).cast("array<double>")


@dataclass
class Profile:
    """Per feature: smallest and largest value, rows with the largest, and whether these two are all its values."""

    rows: int
    low: np.ndarray
    high: np.ndarray
    highs: np.ndarray
    two: np.ndarray  # two values, both finite
    many: np.ndarray


def joined(a, b):
    """State of two parts of a table: (rows, low, high, rows with the largest value, more than two values)."""
    low, high = np.minimum(a[1], b[1]), np.maximum(a[2], b[2])
    many = a[4] | b[4]
    for part in (a, b):
        many = many | ((part[1] != low) & (part[1] != high)) | ((part[2] != low) & (part[2] != high))
    return a[0] + b[0], low, high, np.where(a[2] == high, a[3], 0) + np.where(b[2] == high, b[3], 0), many


def part_of(x: np.ndarray) -> tuple:
    """State of the rows of a matrix, as :func:`joined` takes it."""
    low, high = x.min(axis=0), x.max(axis=0)
    top = x == high
    return len(x), low, high, top.sum(axis=0), ~(top | (x == low)).all(axis=0)


def profile(df: DataFrame, features: Column, width: int) -> Profile:
    """One pass over array<double> rows. A feature with a missing value counts as one of many values."""

    def run(batches):
        state = None
        for batch in batches:
            if batch.num_rows:
                part = part_of(matrix(batch.column(0), width))
                state = part if state is None else joined(state, part)
        if state is not None:
            rows, *columns = state
            yield pa.RecordBatch.from_arrays([pa.array([rows]), *[pa.array([c.tolist()]) for c in columns]], names=["rows", "low", "high", "highs", "many"])

    kinds = "rows long, low array<double>, high array<double>, highs array<long>, many array<boolean>"
    total = 0, np.full(width, np.inf), np.full(width, -np.inf), np.zeros(width, int), np.zeros(width, bool)
    for r in df.select(features.alias("_f")).mapInArrow(run, kinds).collect():  # one row a task
        part = r["rows"], np.array(r["low"], float), np.array(r["high"], float), np.array(r["highs"], int), np.array(r["many"], bool)
        total = part if not total[0] else joined(total, part)
    rows, low, high, highs, many = total
    many = many | ~(np.isfinite(low) & np.isfinite(high))
    return Profile(rows, low, high, highs, ~many & (low < high), many)


def cut_points(df: DataFrame, features: Column, width: int, bins: int = MOST_BINS) -> list[np.ndarray]:
    """At most ``bins`` - 2 increasing cuts per feature; a value x lies behind the cuts c with c <= x.

    The cuts are values of the feature at even ranks, from one mergeable sketch per feature: exact up to ACCURACY rows a
    partition, beyond it within 1 / ACCURACY of the rank. The smallest value is no cut, as nothing lies before it.
    A feature of two values needs no sketch, as its values are counted.
    """
    most = bins - 2
    grid = F.split(F.lit(",".join(str((i + 1) / (most + 1)) for i in range(most))), ",").cast("array<double>")
    found = profile(df, features, width)
    cuts = [np.array([])] * width
    last = math.ceil(most / (most + 1) * found.rows)  # rank of the largest quantile
    for i in np.flatnonzero(found.two):
        if found.rows - found.highs[i] < last:
            cuts[i] = found.high[i:i + 1].copy()
    wide = np.flatnonzero(found.many).tolist()
    if wide:
        known = {i: F.nanvl(features[i], F.lit(None).cast("double")) for i in wide}
        row = df.agg(*[F.percentile_approx(v, grid, F.lit(ACCURACY)).alias(f"q{i}") for i, v in known.items()], *[F.min(v).alias(f"low{i}") for i, v in known.items()]).first()
        for i in wide:
            cuts[i] = np.array(sorted({v for v in row[f"q{i}"] or () if v > row[f"low{i}"]}))
    return cuts


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of an array<double> column; null counts as missing."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, width)


def binned(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers as bytes: 0 for missing, else 1 + number of cuts at or below the value."""
    out = np.empty(values.shape, np.uint8)
    for i, c in enumerate(cuts):
        out[:, i] = np.where(np.isnan(values[:, i]), 0, 1 + np.searchsorted(c, values[:, i], "right"))
    return out


def hashed(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per key and salt."""
    x = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * (1.0 / (1 << 53))


def packed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    step = rows.dtype.itemsize * rows.shape[1]
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(step)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """The matrix of a column made by :func:`packed`, without a Python value per row."""
    if not len(column) or not width:
        return np.zeros((len(column), width), kind)
    ends = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind).reshape(-1, width)
