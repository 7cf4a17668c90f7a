"""Isolation forest: multivariate outliers.

Only a bounded sample (trees x 256 rows) is used to grow the trees, one tree per task group; the
trees (at most trees x 511 nodes) are then applied to every row in Arrow batches.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.functions.numeric import known
from lotmill.operators.copies import number_copies
from lotmill.operators.order_stats import ROWS_PER_BUCKET, quantile_columns, ranked_values
from lotmill.session import kept

# tasks get the functions of this module by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 256
DEPTH = 8
NODES = 511  # a binary tree of this depth in heap order


def average_path(n):
    """Mean depth of an unsuccessful search in a binary tree of n leaves."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    return np.where(n > 2, 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int):
    """Split at random until ``limit``; returns (feature, threshold, path length) per heap slot."""
    feature = np.full(NODES, -1, dtype=np.int32)
    threshold = np.zeros(NODES)
    length = np.zeros(NODES)
    pending = [(0, points, 0)]
    while pending:
        slot, rows, depth = pending.pop()
        spread = np.ptp(rows, axis=0) if len(rows) else np.zeros(points.shape[1])
        usable = np.flatnonzero(spread > 0)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            length[slot] = depth + float(average_path(len(rows)))
            continue
        f = int(rng.choice(usable))
        cut = rng.uniform(rows[:, f].min(), rows[:, f].max())
        feature[slot], threshold[slot] = f, cut
        left = rows[:, f] <= cut
        pending += [(2 * slot + 1, rows[left], depth + 1), (2 * slot + 2, rows[~left], depth + 1)]
    return feature, threshold, length


def fit_trees(df: DataFrame, columns: Sequence[str], rows: int, trees: int = 100, seed: int = 42) -> list:
    """One bounded random sample per tree; trees are grown in parallel."""
    take = min(SAMPLE, rows)
    limit = max(1, math.ceil(math.log2(max(take, 2))))
    # content and copy number decide, by one rule at every size: which trees a row may enter, and its place in their samples
    row = [*columns, "_copy"]
    share = min(1.0, 4.0 * SAMPLE / max(rows, 1))
    enters = lambda t: F.pmod(F.xxhash64(*row, t, F.lit(seed)), F.lit(1 << 30)) < F.lit(share * (1 << 30))
    drawn = number_copies(df.select(*columns), "_copy")
    if share < 1:
        # one hash says how many trees a row misses before its first (a geometric number), so most rows end here; later trees are drawn one by one
        missed = F.log((F.pmod(F.xxhash64(*row, F.lit(seed + 2)), F.lit(1 << 52)) + 1) / F.lit(float(1 << 52))) / F.lit(math.log1p(-share))
        drawn = drawn.withColumn("_first", missed).where(F.col("_first") < trees).withColumn("_first", F.col("_first").cast("int"))
        later = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: (t > F.col("_first")) & enters(t))
        mine = F.concat(F.array("_first"), later)
    else:
        mine = F.sequence(F.lit(0), F.lit(trees - 1))
    drawn = drawn.select(*row, F.explode(mine).alias("tree"))
    drawn = drawn.select(*columns, "tree", F.xxhash64(*row, "tree", F.lit(seed + 1)).alias("u"))
    width = len(columns)

    def grow(rows_of_tree: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows_of_tree["tree"].iloc[0])
        chosen = rows_of_tree.sort_values(["u", *columns]).head(take)[list(columns)].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        feature, threshold, length = _grow(chosen.reshape(-1, width), rng, limit)
        return pd.DataFrame({"tree": [tree], "feature": [feature.tolist()], "threshold": [threshold.tolist()], "length": [length.tolist()]})

    grown = drawn.groupBy("tree").applyInPandas(grow, "tree int, feature array<int>, threshold array<double>, length array<double>")
    return sorted(grown.collect(), key=lambda r: r["tree"])


def anomaly_scores(df: DataFrame, columns: Sequence[str], forest: list, take: int) -> DataFrame:
    """Adds ``score`` in 0..1, higher = easier to isolate."""
    feature = np.array([r["feature"] for r in forest], dtype=np.int32)
    threshold = np.array([r["threshold"] for r in forest])
    length = np.array([r["length"] for r in forest])
    norm = float(average_path(take)) or 1.0
    # a leaf leads to itself: nothing is above its threshold
    inner, slots = feature >= 0, np.arange(NODES)
    shared = df.sparkSession.sparkContext.broadcast((np.maximum(feature, 0).astype(np.int64), np.where(inner, threshold, np.inf), np.where(inner, 2 * slots + 1, slots), length))

    @F.pandas_udf("double")
    def score(*values: pd.Series) -> pd.Series:
        feature, threshold, left, length = shared.value
        flat = np.concatenate([v.to_numpy(dtype=float) for v in values])  # column after column
        n = len(values[0])
        at_row = np.arange(n)
        total = np.zeros(n)
        for column, t, to, path in zip(feature * n, threshold, left, length):
            slot = np.zeros(n, dtype=np.int64)
            for _ in range(DEPTH):
                slot = to.take(slot) + (flat.take(column.take(slot) + at_row) > t.take(slot))
            total += path.take(slot)
        return pd.Series(np.exp2(-(total / len(feature)) / norm))

    return df.withColumn("score", score(*[F.col(c) for c in columns]))


def isolation_forest(df: DataFrame, columns: Sequence[str] = rules.NUMERIC_COLUMNS, contamination: float = 0.12,
                     trees: int = 100, seed: int = 42, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One report row: rows evaluated, outliers beyond the contamination quantile of the score."""
    complete = kept(df.select(*[known(c).alias(c) for c in columns]).dropna(), "complete")  # counted, drawn from and scored
    rows = complete.count()
    fields = "rows long, outlier_count long, outlier_pct double, quality_score_pct double"
    if rows < 10:
        return df.sparkSession.createDataFrame([(rows, None, None, None)], fields)
    forest = fit_trees(complete, columns, rows, trees, seed)
    scored = anomaly_scores(complete, columns, forest, min(SAMPLE, rows)).select("score").persist(StorageLevel.MEMORY_AND_DISK)
    ranked = ranked_values(scored, ["score"], rows_per_bucket=rows_per_bucket)
    cut = ranked.groupBy("column").agg(*quantile_columns({"cut": 1.0 - contamination}))
    flagged = ranked.join(F.broadcast(cut), "column").agg(  # one row on the broadcast side
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("value") > F.col("cut"), F.col("n"))), F.lit(0)).alias("outlier_count"))
    pct = F.round(F.col("outlier_count") * 100.0 / F.col("rows"), 4)
    return flagged.withColumn("outlier_pct", pct).withColumn("quality_score_pct", F.round(100.0 - F.col("outlier_pct"), 2))
