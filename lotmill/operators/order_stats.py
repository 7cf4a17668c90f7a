"""Exact order statistics (quantiles, medians, modes, ranks) as distributed aggregations.

The built-in exact ``percentile`` and ``mode`` keep every distinct value of a group in one
aggregation buffer, and a global ``rank()`` sorts the whole table in one task. Here the values
are counted first (copies combine map-side), spread over range buckets fitted with a mergeable
quantile sketch, and turned into running counts bucket by bucket. Only the table of bucket
totals, whose size is the number of buckets, is summed in order per column.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotmill.operators.fixed import Fixed
from lotmill.functions.numeric import known

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 4096


SMALL_INPUT_BYTES = 256 << 20


def _reads_little(df: DataFrame) -> bool:
    """Whether the tables under the plan are small by their metadata (no job is run)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return size <= SMALL_INPUT_BYTES


def fit_buckets(df: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> dict[str, list[float]]:
    """Range-bucket boundaries per column; none while the table is small.

    Count and sketch share one pass. Small inputs are counted first, which mostly saves the sketch.
    """
    if _reads_little(df) and df.count() <= rows_per_bucket:
        return {c: [] for c in columns}
    # one foldable expression for all probabilities: 4,095 separate literals take seconds to analyse
    grid = F.split(F.lit(",".join(str(i / MAX_BUCKETS) for i in range(1, MAX_BUCKETS))), ",").cast("array<double>")
    values = df.select(*[known(c).alias(f"v{i}") for i, c in enumerate(columns)])
    row = values.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.percentile_approx(f"v{i}", grid, F.lit(10 * MAX_BUCKETS)).alias(f"q{i}") for i in range(len(columns))],
    ).first()
    wanted = min(MAX_BUCKETS, math.ceil(row["rows"] / rows_per_bucket))
    if wanted <= 1:
        return {c: [] for c in columns}
    picks = [round(k * (MAX_BUCKETS - 1) / wanted) for k in range(1, wanted)]
    cuts = {}
    for i, c in enumerate(columns):
        found = row[f"q{i}"] or []
        cuts[c] = sorted({found[min(p, len(found) - 1)] for p in picks}) if found else []
    return cuts


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                 cuts: Mapping[str, list[float]] | None = None) -> DataFrame:
    """One row per (by, column, bucket, value) with its number of copies ``n``.

    Null values and rows with a null group key are left out.
    """
    cuts = cuts or {}
    if by:
        df = df.dropna(subset=list(by))
    work = df.select(*by, *[known(c).alias(f"_v{i}") for i, c in enumerate(columns)])
    buckets = {}
    for i, c in enumerate(columns):
        if cuts.get(c):
            splits = [-math.inf, *cuts[c], math.inf]
            work = Bucketizer(splits=splits, inputCol=f"_v{i}", outputCol=f"_b{i}", handleInvalid="keep").transform(work)
            buckets[i] = F.col(f"_b{i}").cast("int")
        else:
            buckets[i] = F.lit(0)
    cells = work.select(*by, *[
        F.struct(buckets[i].alias("bucket"), F.col(f"_v{i}").alias("value")).alias(c) for i, c in enumerate(columns)
    ])
    long = cells.unpivot(list(by), list(columns), "column", "cell")
    return (
        long.select(*by, "column", "cell.bucket", "cell.value").where(F.col("value").isNotNull())
        .groupBy(*by, "column", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def running_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``upto`` (copies at or below the value) and ``total`` to :func:`value_counts`."""
    group = [*by, "column"]
    sizes = counts.groupBy(*group, "bucket").agg(F.sum("n").alias("_size"))
    in_order = W.partitionBy(*group).orderBy("bucket")
    offsets = sizes.select(
        *group, "bucket",
        (F.sum("_size").over(in_order) - F.col("_size")).alias("_before"),
        F.sum("_size").over(W.partitionBy(*group)).alias("total"),
    )
    inside = W.partitionBy(*group, "bucket").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = counts.withColumn("_run", F.sum("n").over(inside))
    return local.join(offsets, [*group, "bucket"]).select(
        *group, "value", "n", (F.col("_run") + F.col("_before")).alias("upto"), "total"
    )


def ranked_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    cuts = fit_buckets(df, columns, rows_per_bucket)
    return running_counts(value_counts(df, columns, by, cuts), by)


def quantile_columns(probs: Mapping[str, float]) -> list:
    """Aggregates over :func:`ranked_values` rows giving linearly interpolated quantiles."""
    out = []
    for name, p in probs.items():
        position = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.floor(position), F.ceil(position)
        covers = lambda at: (F.col("upto") - F.col("n") <= at) & (at < F.col("upto"))
        at_low = F.max(F.when(covers(low), F.col("value")))
        at_high = F.max(F.when(covers(high), F.col("value")))
        weight = F.max(position - low)
        out.append((at_low + (at_high - at_low) * weight).alias(name))
    return out


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def quantiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float] = QUARTILES,
              by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per (by, column) with the exact quantiles, the row count and the mode."""
    ranked = ranked_values(df, columns, by, rows_per_bucket)
    return ranked.groupBy(*by, "column").agg(
        F.max("total").alias("total"),
        *quantile_columns(probs),
        F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("v")))["v"].alias("mode"),
    )


def quantile_row(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float] = QUARTILES,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> Fixed:
    """All quantiles of a table as literals for other plans: ``.getField('price_q1')``."""
    table = quantiles(df, columns, probs, rows_per_bucket=rows_per_bucket)
    fields = [
        F.max(F.when(F.col("column") == c, F.col(name))).alias(f"{c}_{name}") for c in columns for name in probs
    ]
    return Fixed(table.agg(*fields))


def average_ranks(df: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(column, value, rank): 1-based rank, ties sharing the mean of their positions."""
    ranked = ranked_values(df, columns, rows_per_bucket=rows_per_bucket)
    return ranked.select("column", "value", (F.col("upto") - (F.col("n") - 1) / F.lit(2.0)).alias("rank"))
