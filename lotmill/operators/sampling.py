"""Exact-size splits and samples in a reproducible order, without sorting a class in one task.

Rows are ordered by a hash of their content (and copy number). To take the first k rows of a
class it is enough to know the hash of its k-th row: a histogram over hash prefixes finds the
prefix that holds it, and only rows with that prefix are ranked. All other rows are decided by
one comparison, so the table itself is not shuffled by these operators.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotmill.operators.copies import count_copies, unfold
from lotmill.operators.lookups import attach
from lotmill.session import kept

PREFIX = 4  # hex digits: 65,536 histogram cells per class


DOUBLES = 4  # double columns from which on a hash is dearer than 16 bytes written, as numbers are slow to turn into text
MOST_HASHES = 1_000  # copies of a row whose hashes are written beside it


def content_text(columns: Sequence[str], seed: int, doubles: frozenset[str] = frozenset()) -> Column:
    """The values as one text. ``doubles`` are double columns without a negative zero, where 0 and 1 need no formatting."""

    def text(c: str) -> Column:
        value = F.col(f"`{c}`")
        plain = F.coalesce(value.cast("string"), F.lit(""))
        return F.when(value == 0, "0.0").when(value == 1, "1.0").otherwise(plain) if c in doubles else plain

    return F.concat_ws("|", F.lit(str(seed)), *map(text, columns))


def content_hash(columns: Sequence[str], seed: int) -> Column:
    return F.md5(content_text(columns, seed))


def in_random_order(df: DataFrame, seed: int = 42, unique_key: Sequence[str] | None = None) -> DataFrame:
    """Adds ``_h``, distinct for every row.

    ``unique_key`` names columns known to identify a row; without it copies are numbered first, so
    that equal rows still get different positions. Rows of several doubles become text once for all copies, and their hashes are
    written beside the counted row (16 bytes a copy), as they are looked at several times.
    """
    if unique_key is None:
        columns = df.columns
        counted, doubles = count_copies(df, "_times"), frozenset(c for c, kind in df.dtypes if kind == "double")
        if len(doubles) < DOUBLES:
            return unfold(kept(counted, "copies"), "_times", "_copy", keep=False).withColumn("_h", content_hash([*columns, "_copy"], seed)).drop("_copy")
        text = content_text(columns, seed, doubles)  # grouped values hold no negative zero
        numbers = F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)
        hashes = F.transform(F.array(text), lambda t: F.transform(numbers, lambda i: F.unhex(F.md5(F.concat(t, F.lit("|"), i.cast("string"))))))[0]
        counted = kept(counted.withColumn("_hashes", F.when(F.col("_times") <= MOST_HASHES, hashes)), "copies")
        values = [F.col(f"`{c}`") for c in columns]
        rows = counted.where(F.col("_times") <= MOST_HASHES).select(*values, F.explode("_hashes").alias("_h")).withColumn("_h", F.lower(F.hex("_h")))
        if (counted.agg(F.max("_times")).first()[0] or 0) > MOST_HASHES:
            many = unfold(counted.where(F.col("_times") > MOST_HASHES).drop("_hashes"), "_times", "_copy", keep=False)
            rows = rows.unionByName(many.withColumn("_h", content_hash([*columns, "_copy"], seed)).drop("_copy"))
        return rows
    return df.withColumn("_h", content_hash(unique_key, seed))


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """(label, n): rows per class, any number of classes. Rows without a label belong to no class."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)


def nth_hashes(ordered: DataFrame, label: str, ranks: DataFrame, names: Sequence[str]) -> DataFrame:
    """(label, name columns): hash of the rank-th row of each class; ``ranks`` holds (label, name, rank)."""
    slim = ordered.select(label, "_h", F.substring("_h", 1, PREFIX).alias("_p"))
    cells = slim.groupBy(label, "_p").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(W.partitionBy(label).orderBy("_p"))
    running = cells.select(label, "_p", (upto - F.col("_n")).alias("_before"), upto.alias("_upto"))
    target = running.join(ranks.where("rank > 0"), label).where(
        (F.col("_before") < F.col("rank")) & (F.col("rank") <= F.col("_upto"))
    ).select(label, "_p", "name", (F.col("rank") - F.col("_before")).alias("_local"))
    local = F.row_number().over(W.partitionBy(label, "_p", "name").orderBy("_h"))
    hits = attach(slim, target, [label, "_p"], "inner").withColumn("_rn", local).where(F.col("_rn") == F.col("_local"))
    return hits.groupBy(label).agg(*[F.max(F.when(F.col("name") == n, F.col("_h"))).alias(n) for n in names])


def proportional(sizes: DataFrame, label: str, size: str, wanted: int, total: int, name: str) -> DataFrame:
    """Adds ``name``: ``wanted`` shared in proportion to ``size`` (which sums to ``total``), largest remainders first.

    The windows hold one row per class.
    """
    exact = F.lit(wanted) * F.col(size) / F.lit(max(total, 1))
    parts = sizes.withColumns({"_floor": F.floor(exact), "_left": exact - F.floor(exact)})
    spare = F.lit(wanted) - F.sum("_floor").over(W.partitionBy())
    place = F.row_number().over(W.orderBy(F.desc("_left"), label))
    return parts.withColumn(name, F.col("_floor") + (place <= spare).cast("long")).drop("_floor", "_left")


def stratified_split(df: DataFrame, label: str, test_size: float = 0.2, val_size: float = 0.25, seed: int = 42,
                     unique_key: Sequence[str] | None = None) -> DataFrame:
    """Adds ``split``: test = ceil(test_size N), val = ceil(val_size of the rest), train = remainder.

    Rows with a null label are left out, as they are by every operator here that goes by class.
    """
    df = df.where(F.col(label).isNotNull())
    sizes = class_sizes(df, label)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    n_test = math.ceil(test_size * total)
    tested = proportional(sizes, label, "n", n_test, total, "_in_test").withColumn("_rest", F.col("n") - F.col("_in_test"))
    parts = proportional(tested, label, "_rest", math.ceil(val_size * (total - n_test)), total - n_test, "_in_val")
    both = F.array(F.struct(F.lit("_test").alias("name"), F.col("_in_test").alias("rank")),
                   F.struct(F.lit("_val").alias("name"), (F.col("_in_test") + F.col("_in_val")).alias("rank")))
    ranks = parts.select(label, F.inline(both))
    ordered = in_random_order(df, seed, unique_key)
    joined = attach(ordered, nth_hashes(ordered, label, ranks, ["_test", "_val"]), [label])
    split = F.when(F.col("_h") <= F.col("_test"), "test").when(F.col("_h") <= F.col("_val"), "val").otherwise("train")
    return joined.withColumn("split", split).select(*df.columns, "split")


def undersample(df: DataFrame, label: str, seed: int = 42, unique_key: Sequence[str] | None = None) -> DataFrame:
    """Every class cut to the size of the smallest one."""
    df = df.where(F.col(label).isNotNull())
    sizes = class_sizes(df, label)
    smallest = sizes.agg(F.min("n")).first()[0] or 0
    ordered = in_random_order(df, seed, unique_key)
    cuts = nth_hashes(ordered, label, sizes.select(label, F.lit("_last").alias("name"), F.lit(smallest).cast("long").alias("rank")), ["_last"])
    joined = attach(ordered, cuts, [label], "inner")
    return joined.where(F.col("_h") <= F.col("_last")).select(*df.columns)


def sample_rows(df: DataFrame, n: int, seed: int = 42, unique_key: Sequence[str] | None = None) -> DataFrame:
    """Exactly n rows (all, when there are fewer) in reproducible random choice."""
    ordered = in_random_order(df, seed, unique_key).withColumn("_all", F.lit(0))
    total = df.count()
    if total <= n:
        return df
    ranks = df.sparkSession.createDataFrame([(0, "_last", n)], "_all int, name string, rank long")
    cut = nth_hashes(ordered, "_all", ranks, ["_last"]).select("_last").scalar()
    return ordered.where(F.col("_h") <= cut).select(*df.columns)


def class_ranks(df: DataFrame, label: str, seed: int = 42, unique_key: Sequence[str] | None = None,
                name: str = "class_rank") -> DataFrame:
    """1-based position of every row within its class in hash order."""
    df = df.where(F.col(label).isNotNull())
    ordered = in_random_order(df, seed, unique_key).withColumn("_p", F.substring("_h", 1, PREFIX))
    cells = ordered.groupBy(label, "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(label).orderBy("_p")) - F.col("_n")
    offsets = cells.select(label, "_p", before.alias("_before"))
    local = F.row_number().over(W.partitionBy(label, "_p").orderBy("_h"))
    joined = attach(ordered, offsets, [label, "_p"])
    return joined.withColumn(name, local + F.col("_before")).select(*df.columns, name)


def stratified_folds(df: DataFrame, label: str, folds: int = 5, seed: int = 42,
                     unique_key: Sequence[str] | None = None) -> DataFrame:
    """Adds ``fold`` 0..folds-1; every class is spread evenly (usable as ``CrossValidator(foldCol=)``)."""
    ranked = class_ranks(df, label, seed, unique_key, "_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")
