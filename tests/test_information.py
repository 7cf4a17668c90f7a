"""Mutual information by neighbours against a brute-force estimator."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from lotmill.operators.neighbour_information import digamma, neighbour_information
from lotmill.operators.selection import FeatureSelector, neighbour_scores


def _digamma(n: int) -> float:
    return -0.5772156649015329 + math.fsum(1.0 / i for i in range(1, n))


def brute(x, y, k):
    size = {c: int((y == c).sum()) for c in set(y.tolist())}
    kept = np.array([size[c] > 1 for c in y.tolist()])
    x, y = x[kept], y[kept]
    terms = []
    for i in range(len(x)):
        mates = [j for j in range(len(x)) if y[j] == y[i] and j != i]
        mates.sort(key=lambda j: (abs(x[j] - x[i]), x[j]))
        wanted = min(k, len(mates))
        end = x[mates[wanted - 1]]
        if end == x[i]:
            used, m = int(((x == x[i]) & (y == y[i])).sum()), int((x == x[i]).sum())
        else:
            d = abs(end - x[i])
            low, high = (end, x[i] + d) if end < x[i] else (x[i] - d, end)
            used, m = wanted, int(((x > low) & (x < high)).sum())
        terms.append(_digamma(used) - _digamma(len(mates) + 1) - _digamma(m))
    return max(0.0, _digamma(len(x)) + math.fsum(terms) / len(x))


def _columns():
    rng = np.random.default_rng(5)
    y = rng.choice([0, 1, 2], 500, p=[0.7, 0.28, 0.02])
    y[0] = 9  # a class of one row
    return y, {
        "even": rng.normal(size=500),
        "moved": rng.normal(size=500) + y,
        "ties": np.round(rng.normal(size=500) + y, 1),
        "hot": np.where(rng.random(500) < 0.4, 7.0, rng.integers(0, 50, 500).astype(float)),
        "constant": np.ones(500),
        "known": (y * 3).astype(float),
    }


@pytest.mark.parametrize("k,per_bucket", [(3, 10**6), (3, 40), (5, 11), (1, 40)])
def test_equals_brute_force(spark, k, per_bucket):
    y, columns = _columns()
    names = list(columns)
    rows = [(int(y[i]), *[float(columns[c][i]) for c in names]) for i in range(500)]
    df = spark.createDataFrame([*rows, (None, *[0.5] * len(names))], "y int, " + ", ".join(f"{c} double" for c in names))
    found = {r["feature"]: r["score"] for r in neighbour_information(df, names, "y", k, per_bucket).collect()}
    assert found == pytest.approx({c: brute(columns[c], y, k) for c in names}, abs=1e-10)


def test_digamma(spark):
    rows = spark.range(1, 300).select("id", digamma(F.col("id")).alias("d")).collect()
    assert max(abs(r["d"] - _digamma(r["id"])) for r in rows) < 1e-12


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "y int, a double")
    assert [tuple(r) for r in neighbour_scores(empty, ["a"], "y").collect()] == [("a", 0.0)]
    lone = spark.createDataFrame([(0, 1.0), (1, None)], "y int, a double")
    assert neighbour_information(lone, ["a"], "y").count() == 0


def test_selector_ranks_the_related_feature_first(spark):
    y, columns = _columns()
    rows = [(int(y[i]), float(columns["even"][i]), float(columns["moved"][i])) for i in range(500)]
    df = spark.createDataFrame(rows, "label int, even double, moved double")
    assert FeatureSelector("mutual_info", k=1).fit(df, ["even", "moved"]).selected == ["moved"]
    assert FeatureSelector("binned_info", k=1).fit(df, ["even", "moved"]).selected == ["moved"]


def test_neighbour_information_computes_its_rows_once(spark):
    """Bucket borders and counts read one table, and small buckets give the same score."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    noted = counted.asNondeterministic()  # so that filters do not run it a second time
    rows = spark.range(0, 4_000, 1, 3).select((F.col("id") * 37 % 1009).cast("double").alias("a"), (F.col("id") % 3).alias("y"))
    one = neighbour_information(rows.select(noted("a").alias("a"), "y"), ["a"], "y", rows_per_bucket=100).first()
    assert seen.value == 4_000
    assert one["score"] == pytest.approx(neighbour_information(rows, ["a"], "y", rows_per_bucket=10_000).first()["score"], abs=1e-9)
