"""Mutual information between a number and a class, from distances to the k-th neighbour inside the class.

For a row i of class y let r be the distance to its k-th nearest row of the class, and m the number of rows of all
classes closer than r, itself included. With the digamma function D the estimate is
``D(N) + mean D(k) - mean D(N_y) - mean D(m)``, not below 0 (Ross, PLoS ONE 9(2), 2014). Where k rows of the class share
the row's value, r is 0 and the equal rows count instead: k is their number in the class, m in all classes (the rule of
Gao and others for mixed data, 2017), so a column of few values gets its plain contingency estimate and no noise has to
be added. A class of n <= k rows uses n - 1 neighbours; classes of one row are left out. Distances are compared by
``x - r`` and ``x + r``; on the side of the k-th neighbour its own value is the border.

Rows travel as value counts. The k values before and after a value come from windows inside range buckets; the first and
last k values of each bucket, a table bounded by the number of buckets, supply what lies across their borders. The rows
closer than r are a difference of two ranks in the sorted column, found by sorting the borders among the values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotmill.operators.order_stats import fit_buckets, value_counts
from lotmill.session import kept, written

_SHIFT = 8
ROWS_PER_BUCKET = 250_000  # a bucket is sorted three times in one task, so it is smaller than those of plain ranks


def digamma(n: Column) -> Column:
    """Of positive numbers, to about 1e-13: recurrence up to n + 8, then the asymptotic series."""
    n = n.cast("double")
    x = n + F.lit(float(_SHIFT))
    s = F.lit(1.0) / (x * x)
    series = F.log(x) - 0.5 / x - s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s * (1 / 240 - s / 132))))
    for i in range(_SHIFT):
        series = series - F.lit(1.0) / (n + F.lit(float(i)))
    return series


def _surroundings(counts: DataFrame, k: int) -> DataFrame:
    """Adds ``before`` and ``after``: the k distinct values of the class next to each value, as (value, n), nearest first."""
    group = ["column", "_y"]
    entry = F.struct("value", "n")
    here, across = W.partitionBy(*group, "bucket"), W.partitionBy(*group)
    # one order serves both sides, so that each table is sorted once
    before = lambda w: F.reverse(F.collect_list(entry).over(w.orderBy("value").rowsBetween(-k, -1)))
    after = lambda w: F.collect_list(entry).over(w.orderBy("value").rowsBetween(1, k))
    local = counts.withColumns({"_first": F.row_number().over(here.orderBy("value")), "_before": before(here), "_after": after(here)})
    local = local.withColumn("_last", F.when(F.size("_after") < k, F.size("_after") + 1))  # null where k values or more follow
    edges = local.where(f"_first <= {k} OR _last IS NOT NULL").select(*group, "bucket", "value", "n", "_first", "_last")
    edges = edges.withColumns({"_left": before(across), "_right": after(across)})
    borders = edges.groupBy(*group, "bucket").agg(
        F.max(F.when(F.col("_first") == 1, F.col("_left"))).alias("_left"), F.max(F.when(F.col("_last") == 1, F.col("_right"))).alias("_right"))
    return local.join(borders, [*group, "bucket"]).select(
        *group, "bucket", "value", "n",
        F.slice(F.concat("_before", "_left"), 1, k).alias("before"), F.slice(F.concat("_after", "_right"), 1, k).alias("after"))


def _kth(wanted: Column) -> Column:
    """(d, v) of the neighbour that completes ``wanted`` rows, the row's own copies first; d is 0 within those."""
    start = F.struct((wanted - (F.col("n") - 1)).alias("left"), F.lit(0.0).alias("d"), F.col("value").alias("v"))
    ranked = F.array_sort(F.transform(
        F.concat("before", "after"), lambda e: F.struct(F.abs(e["value"] - F.col("value")).alias("d"), e["value"].alias("v"), e["n"].alias("n"))))
    return F.aggregate(ranked, start, lambda a, e: F.when(a["left"] <= 0, a).otherwise(
        F.struct((a["left"] - e["n"]).alias("left"), e["d"].alias("d"), e["v"].alias("v"))))


def _in_buckets(rows: DataFrame, at: str, cuts: dict[str, list[float]]) -> DataFrame:
    """Adds the range bucket of ``at`` in its own column of the source table."""
    bucket = F.lit(0)
    for i, (c, edges) in enumerate(cuts.items()):
        if edges:
            rows = rows.withColumn(f"_t{i}", F.when(F.col("column") == c, F.col(at)))
            rows = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol=f"_t{i}", outputCol=f"_b{i}", handleInvalid="keep").transform(rows)
            bucket = F.when(F.col("column") == c, F.col(f"_b{i}").cast("int")).otherwise(bucket)
    return rows.withColumn("bucket", bucket)


def neighbour_information(df: DataFrame, features: Sequence[str], label: str, k: int = 3, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(feature, score) in nats. Null or NaN numbers and rows without a class are left out; a feature without two rows
    of one class gets no row. ``features`` hold numbers."""
    names = {f"f{i}": c for i, c in enumerate(features)}
    # adding 0 turns -0.0 into 0.0, which range buckets would tell apart
    slim = df.select(F.col(f"`{label}`").alias("_y"), *[(F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias(f) for f, c in names.items()]).where("_y IS NOT NULL")
    slim = kept(slim, "numbers")
    cuts = fit_buckets(slim, list(names), rows_per_bucket)
    counts = value_counts(slim, list(names), ["_y"], cuts)
    sizes = counts.groupBy("column", "_y").agg(F.sum("n").alias("size")).where("size > 1")  # features x classes rows
    counts = written(counts.join(sizes, ["column", "_y"]), "value-counts")
    wanted = F.least(F.lit(k), F.col("size") - 1)
    near = _surroundings(counts.drop("size"), k).join(sizes, ["column", "_y"]).withColumn("_kth", _kth(wanted))
    d, v, x = F.col("_kth.d"), F.col("_kth.v"), F.col("value")
    low, high = F.when(v < x, v).otherwise(x - d), F.when(v > x, v).otherwise(x + d)
    # kind 0 is placed before the rows of its value, kind 2 behind them
    probe = lambda at, kind, sign: F.struct(at.alias("at"), F.lit(kind).alias("kind"), F.lit(sign).alias("sign"))
    probes = F.when(d > 0, F.array(probe(high, 0, 1), probe(low, 2, -1))).otherwise(F.array(probe(x, 2, 1), probe(x, 0, -1)))
    used = F.when(d > 0, wanted).otherwise(F.col("n"))
    asked = near.select("column", "_y", "value", "n", "size", used.alias("k"), F.explode(probes).alias("p"))
    asked = _in_buckets(asked.select("column", "_y", "value", "n", "size", "k", "p.at", "p.kind", "p.sign"), "at", cuts)
    held = counts.groupBy("column", "bucket", "value").agg(F.sum("n").alias("rows"))
    nothing = {c: F.lit(None).cast(asked.schema[c].dataType) for c in ("_y", "n", "size", "k")}
    events = asked.select("column", "bucket", "at", "kind", "sign", "value", *nothing, F.lit(0).cast("long").alias("rows")).unionByName(held.select(
        "column", "bucket", F.col("value").alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("sign"), "value", *[e.alias(c) for c, e in nothing.items()], "rows"))
    inside = W.partitionBy("column", "bucket").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = held.groupBy("column", "bucket").agg(F.sum("rows").alias("rows"))  # one row per bucket
    lower = W.partitionBy("column").orderBy("bucket")
    starts = events.select("column", "bucket").distinct().join(totals, ["column", "bucket"], "left").select(
        "column", "bucket", (F.sum(F.coalesce("rows", F.lit(0))).over(lower) - F.coalesce("rows", F.lit(0))).alias("_start"))
    found = events.withColumn("_run", F.sum("rows").over(inside)).where("kind <> 1").join(starts, ["column", "bucket"])
    closer = found.groupBy("column", "_y", "value").agg(
        F.sum(F.col("sign") * (F.col("_run") + F.col("_start"))).alias("m"), *[F.max(c).alias(c) for c in ("n", "size", "k")])
    total = F.sum("n")
    score = digamma(total) + F.sum(F.col("n") * (digamma(F.col("k")) - digamma(F.col("size")) - digamma(F.col("m")))) / total
    scored = closer.groupBy("column").agg(F.greatest(score, F.lit(0.0)).alias("score"))
    known = F.create_map(*[F.lit(t) for pair in names.items() for t in pair])
    return scored.select(known[F.col("column")].alias("feature"), "score")
