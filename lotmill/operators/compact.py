"""Rows of many columns in a few bytes, for learners that pass over them again and again.

Columns with two values (such as 0/1 columns of levels, scaled or not) are not stored: those that exclude each other share a
digit, and digits share a code of at most CODES values. Other columns stay numbers. A row is then u @ basis for a u that
holds its numbers, a 1, and a 1 at each of its codes, so sums over rows are sums over few columns and codes, and the basis
turns them into sums over all features. Which columns share a digit is found on a few rows; a row they do not fit is
stored whole, so nothing depends on the choice but the size.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.operators.bins import matrix, packed, profile, unpacked
from lotmill.session import dropped, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CODES = 256
SAMPLED_TASKS, SAMPLED_ROWS = 16, 512


@dataclass
class Compact:
    """``table``: one row per block of rows, with the numbers (column by column), the codes, the labels, and whole rows where no code fits."""

    table: DataFrame
    width: int
    counts: np.ndarray  # rows per class
    numbers: int
    groups: list[int]
    basis: np.ndarray  # (numbers + 1 + codes) x (width + 1), the intercept last

    @property
    def classes(self) -> int:
        return len(self.counts)

    @property
    def rows(self) -> int:
        return int(self.counts.sum())

    def blocks(self, batch: pa.RecordBatch):
        """Per block (numbers with a last column of 1, codes of each group, labels) and (whole rows with a 1, their labels)."""
        for size, numbers, codes, labels, other, other_labels in zip(*[batch.column(i) for i in range(6)]):
            size = size.as_py()
            n = np.ones((size, self.numbers + 1))
            n[:, :self.numbers] = np.frombuffer(numbers.as_buffer(), "<f8").reshape(self.numbers, size).T
            codes = np.frombuffer(codes.as_buffer(), np.uint8).reshape(len(self.groups), size).astype(np.intp)
            x = np.frombuffer(other.as_buffer(), "<f8").reshape(-1, self.width)
            whole = np.hstack([x, np.ones((len(x), 1))]), np.frombuffer(other_labels.as_buffer(), "<i4")
            yield (n, list(codes), np.frombuffer(labels.as_buffer(), "<i4")), whole

    def scores(self, block, values: np.ndarray) -> np.ndarray:
        """u @ values of the rows of a block."""
        n, codes, _ = block
        out, start = n @ values[:self.numbers + 1], self.numbers + 1
        for code, size in zip(codes, self.groups):
            out += values[start:start + size][code]
            start += size
        return out

    def sums(self, block, weights: np.ndarray) -> np.ndarray:
        """u.T @ weights of the rows of a block."""
        n, codes, _ = block
        out = [n.T @ weights]
        for code, size in zip(codes, self.groups):
            out.append(np.stack([np.bincount(code, w, size) for w in np.ascontiguousarray(weights.T)], axis=1))
        return np.vstack(out)

    def squares(self, block) -> np.ndarray:
        """u.T @ u of the rows of a block."""
        n, codes, _ = block
        first = self.numbers + 1
        out = np.zeros((first + sum(self.groups),) * 2)
        out[:first, :first] = n.T @ n
        starts = first + np.cumsum([0, *self.groups])
        columns = np.ascontiguousarray(n.T)
        for i, (a, size) in enumerate(zip(codes, self.groups)):
            across = slice(starts[i], starts[i] + size)
            out[:first, across] = [np.bincount(a, c, size) for c in columns]
            out[across, :first] = out[:first, across].T
            out[np.arange(starts[i], starts[i] + size), np.arange(starts[i], starts[i] + size)] = np.bincount(a, minlength=size)
            for j in range(i):
                down, other = slice(starts[j], starts[j] + self.groups[j]), self.groups[j]
                out[across, down] = np.bincount(a * other + codes[j], minlength=size * other).reshape(size, other)
                out[down, across] = out[across, down].T
        return out

    def drop(self) -> None:
        dropped(self.table)

    def slim(self) -> "Compact":
        """What tasks need."""
        return Compact(None, self.width, self.counts, self.numbers, self.groups, None)


def digits(on: np.ndarray, most: int = CODES - 1) -> list[list[int]]:
    """Columns of ``on`` (rows x columns) in lists whose members are never on together."""
    together, out = (on.T.astype(np.float32) @ on.astype(np.float32)) > 0, []
    for j in range(on.shape[1]):
        for members in reversed(out):
            if len(members) < most and not together[j, members].any():
                members.append(j)
                break
        else:
            out.append([j])
    return out


def _first_rows(rows: DataFrame, width: int) -> np.ndarray:
    """Rows spread over the first batches of the first tasks."""

    def run(batches):
        if TaskContext.get().partitionId() < SAMPLED_TASKS:
            for batch in batches:
                if batch.num_rows:
                    at = np.unique(np.linspace(0, batch.num_rows - 1, SAMPLED_ROWS).astype(int))
                    yield pa.RecordBatch.from_arrays([packed(np.ascontiguousarray(matrix(batch.column(0), width)[at], "<f8"))], names=["x"])
                    break

    found = rows.select("f").mapInArrow(run, "x binary").toArrow().column(0).combine_chunks()
    return np.vstack([np.zeros((0, width)), *[unpacked(c, "<f8", width) for c in (found.chunks if isinstance(found, pa.ChunkedArray) else [found])]])


def compact(df: DataFrame, width: int, classes: int, name: str) -> Compact:
    """``df(f array<double>, label int)`` as a written table of blocks."""
    found = profile(df, F.col("f"), width)
    two, low, high = np.flatnonzero(found.two), found.low, found.high
    constant = found.low == found.high
    numbers = np.flatnonzero(~(found.two | constant))
    lists = digits(_first_rows(df, width)[:, two] == high[two]) if len(two) else []
    groups: list[list[list[int]]] = []
    for members in sorted(lists, key=len, reverse=True):
        for group in groups:
            if np.prod([len(m) + 1 for m in group]) * (len(members) + 1) <= CODES:
                group.append(members)
                break
        else:
            groups.append([members])
    sizes = [int(np.prod([len(m) + 1 for m in group])) for group in groups]

    flat = [(g, m) for g, group in enumerate(groups) for m in group]
    place, member, stride = np.zeros((len(two), len(flat)), np.float32), np.zeros((len(two), len(flat)), np.float32), []
    at = {}
    for i, (g, members) in enumerate(flat):
        stride.append(at.get(g, 1))
        at[g] = stride[-1] * (len(members) + 1)
        place[members, i], member[members, i] = np.arange(1, len(members) + 1), 1.0

    basis = np.zeros((len(numbers) + 1 + sum(sizes), width + 1))
    basis[np.arange(len(numbers)), numbers] = 1.0
    basis[len(numbers)] = np.append(np.where(found.two | constant, low, 0.0), 1.0)
    start = len(numbers) + 1
    for g, size in enumerate(sizes):
        for i, (group, members) in enumerate(flat):
            if group == g:
                digit = np.arange(size) // stride[i] % (len(members) + 1)
                on = np.flatnonzero(digit)
                column = two[np.array(members)[digit[on] - 1]]
                basis[start + on, column] = high[column] - low[column]
        start += size
    names = ["size", "numbers", "codes", "labels", "other", "other_labels"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, labels = matrix(batch.column(0), width), batch.column(1).to_numpy().astype("<i4")
            on = x[:, two] == high[two]
            fits = (on | (x[:, two] == low[two])).all(axis=1) & (x[:, constant] == low[constant]).all(axis=1)
            on = on.astype(np.float32)
            fits &= (on @ member <= 1).all(axis=1)
            digit = (on @ place).astype(np.int64)[fits]
            codes = np.zeros((len(sizes), len(digit)), np.uint8)
            for i, (g, _) in enumerate(flat):
                codes[g] += (digit[:, i] * stride[i]).astype(np.uint8)
            parts = np.ascontiguousarray(x[fits][:, numbers].T, "<f8"), codes, labels[fits], np.ascontiguousarray(x[~fits], "<f8"), labels[~fits]
            yield pa.RecordBatch.from_arrays([pa.array([len(digit)], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=names)

    table = written(df.select("f", "label").mapInArrow(run, "size int, " + ", ".join(f"{n} binary" for n in names[1:])), name)
    out = Compact(table, width, np.zeros(classes), len(numbers), sizes, basis)
    part = out.slim()
    out.counts = added(table, lambda block, whole: np.bincount(np.append(block[2], whole[1]), minlength=classes).astype(float), classes, part)
    return out


FEW = 1 << 14


def added(table: DataFrame, of_block, size: int, part: Compact, finish=None) -> np.ndarray:
    """Adds the vectors that ``of_block`` gives for the blocks of all tasks: on the driver when they are short, else by slot.

    ``finish`` turns the sums of a task into what is added over the tasks; it has to be linear.
    """
    finish = finish or (lambda total: total)
    length = len(finish(np.zeros(size)))
    few = length <= FEW

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for block, whole in part.blocks(batch):
                total += of_block(block, whole)
        total = finish(total)
        if few:
            yield pa.RecordBatch.from_arrays([packed(total[None, :])], names=["sums"])
        else:
            kept = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(total[kept])], names=["slot", "v"])

    out = np.zeros(length)
    if few:
        for row in table.mapInArrow(run, "sums binary").collect():  # at most 128 KB a task
            out += np.frombuffer(row["sums"], "<f8")
        return out
    found = table.mapInArrow(run, "slot long, v double").groupBy("slot").agg(F.sum("v").alias("v")).toArrow()
    out[found["slot"].to_numpy()] = found["v"].to_numpy()
    return out
