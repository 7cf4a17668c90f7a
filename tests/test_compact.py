"""Compact rows, what learns from them, and what a search of several points does only once."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lotmill.operators import class_trees, compact, linear, sampling
from lotmill.operators.bins import cut_points, profile
from lotmill.plans import train


def _levels(n=400, seed=5):
    """Numbers, two sets of exclusive 0/1 columns (scaled), a constant, and labels that depend on them."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 4, n), rng.integers(0, 3, n)
    x = np.hstack([rng.normal(size=(n, 2)), (a[:, None] == [1, 2, 3]) * 2.0 - 0.5, (b[:, None] == [1, 2]) * 1.0, np.full((n, 1), 7.0)])
    return x, ((x[:, 0] + 0.7 * (a == 2) + 0.3 * rng.normal(size=n)) > 0.2).astype(int) + (b == 2)


def _table(spark, x, y, partitions=3):
    rows = [([float(v) for v in row], int(k)) for row, k in zip(x, y)]
    return spark.createDataFrame(rows, "f array<double>, label int").repartition(partitions)


@pytest.mark.parametrize("odd", [False, True])
def test_compact_rows_hold_every_value(spark, odd, monkeypatch):
    x, y = _levels()
    if odd:  # columns that exclude each other in the rows looked at, and not in others
        monkeypatch.setattr(compact, "SAMPLED_ROWS", 1)
    found = compact.compact(_table(spark, x, y, 1), x.shape[1], 3, "test-rows")
    assert found.numbers == 2 and found.counts.tolist() == np.bincount(y).tolist()
    back, whole_rows = [], 0
    for batch in found.table.toArrow().to_batches():
        for (n, codes, labels), (whole, other) in found.slim().blocks(batch):
            u = np.hstack([n, *[np.eye(size)[c] for c, size in zip(codes, found.groups)]])
            back += [*np.column_stack([u @ found.basis, labels]).tolist(), *np.column_stack([whole, other]).tolist()]
            whole_rows += len(whole)
            assert np.allclose(found.squares((n, codes, labels)), u.T @ u)
    assert sorted(back) == sorted(np.column_stack([x, np.ones(len(x)), y]).tolist())
    assert (whole_rows > 0) == odd


def test_linear_sums_include_rows_that_no_code_fits(spark, monkeypatch):
    x, y = _levels()
    w = np.random.default_rng(6).normal(size=(2, 3, x.shape[1] + 1))
    usual = linear._losses(compact.compact(_table(spark, x, y), x.shape[1], 3, "a"), w)
    machine = linear.squared_hinge(compact.compact(_table(spark, x, y), x.shape[1], 3, "a"), 1.0)
    monkeypatch.setattr(compact, "SAMPLED_ROWS", 1)
    rows = compact.compact(_table(spark, x, y, 1), x.shape[1], 3, "b")
    for ours, theirs in zip(linear._losses(rows, w), usual):
        assert np.allclose(ours, theirs)
    assert np.allclose(linear.squared_hinge(rows, 1.0), machine, atol=1e-6)


def test_logistic_models_reach_the_loss_of_spark(spark):
    x, y = _levels()
    x = (x - x.mean(axis=0)) / np.where(x.std(axis=0, ddof=1) > 0, x.std(axis=0, ddof=1), 1.0)
    df = _table(spark, x, y).withColumnRenamed("f", "features")
    points = [LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", maxIter=100, regParam=r) for r in (1e-4, 1e-2)]
    vectors = df.withColumn("features", array_to_vector("features"))
    for point, model in zip(points, linear.logistic_models(df, points)):
        theirs = point.fit(vectors)

        def loss(m):
            z = x @ m.coefficientMatrix.toArray().T + m.interceptVector.toArray()
            return (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).mean() + point.getRegParam() / 2 * (m.coefficientMatrix.toArray() ** 2).sum()

        assert loss(model) <= loss(theirs) + 1e-5
        assert np.abs(np.array([r["probability"].toArray() for r in model.transform(vectors).collect()]) -
                      np.array([r["probability"].toArray() for r in theirs.transform(vectors).collect()])).max() < 0.02


def test_points_of_a_search_share_their_rows(spark, monkeypatch):
    x, y = _levels()
    names = [f"c{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(*map(float, row), float(k)) for row, k in zip(x, y)], ", ".join(f"{c} double" for c in [*names, "label"]))
    written, real = [], class_trees.written
    monkeypatch.setattr(class_trees, "written", lambda rows, name: written.append(name) or real(rows, name))
    config = train.Config(train._tree, {"depth": [1, 2, 3], "min_split": [2], "min_leaf": [1], "criterion": ["gini"], "max_features": [None]}, 3)
    result, _ = train.train_one("decision_tree", "none", df, df, df, names, config)
    assert written == ["tree-rows"] and len(result["attempts"]) == 3


def test_features_of_two_values_are_counted(spark):
    x = np.array([[0.0, i % 2, 5.0, np.nan if i == 3 else i, float(i == 0)] for i in range(300)])
    df = _table(spark, x, np.zeros(300, int)).select("f")
    found = profile(df, F.col("f"), 5)
    assert found.rows == 300 and found.two.tolist() == [False, True, False, False, True] and found.many.tolist() == [False, False, False, True, False]
    assert found.highs[[1, 4]].tolist() == [150, 1]
    cuts = cut_points(df, F.col("f"), 5)
    assert cuts[0].tolist() == cuts[2].tolist() == [] and cuts[1].tolist() == [1.0] and cuts[4].tolist() == []  # one row in 300 lies beyond the last of 255 ranks
    assert len(cuts[3]) > 200


def test_hashes_of_copies_are_written_once(spark, monkeypatch):
    rows = [(0.0, 1.0, -0.0, 0.1 * i, None if i % 3 else 2.5, "x") for i in range(5) for _ in range(i + 1)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f string")
    tables, real = [], sampling.kept
    monkeypatch.setattr(sampling, "kept", lambda part, name: tables.append(part.columns) or real(part, name))
    text = {0.1 * i: str(0.1 * i) for i in range(5)}
    want = sorted(hashlib.md5("|".join(["42", "0.0", "1.0", "0.0", text[0.1 * i], "" if i % 3 else "2.5", "x", str(k)]).encode()).hexdigest() for i in range(5) for k in range(i + 1))
    for most in (1000, 2):  # with and without rows of more copies than are written
        monkeypatch.setattr(sampling, "MOST_HASHES", most)
        ordered = sampling.in_random_order(df)
        assert sorted(r["_h"] for r in ordered.collect()) == want and ordered.columns == [*df.columns, "_h"]
    assert all("_hashes" in columns for columns in tables)


def test_whole_newton_steps_take_one_pass(spark, monkeypatch):
    x, y = _levels()
    rows = compact.compact(_table(spark, x, y), x.shape[1], 3, "svm")
    passes, shorter, real, real_shorter = [], [], linear.added, linear._shorter
    monkeypatch.setattr(linear, "added", lambda *a: passes.append(1) or real(*a))
    monkeypatch.setattr(linear, "_shorter", lambda *a: shorter.append(1) or real_shorter(*a))
    w = np.array(linear.squared_hinge(rows, 1.0))
    assert len(passes) - 2 * len(shorter) <= 15 and len(shorter) < len(passes) / 3
    full = np.column_stack([x, np.ones(len(x))])
    for k in range(3):
        side = np.where(y == k, 1.0, -1.0)
        slack = np.maximum(0.0, 1.0 - side * (full @ w[k]))
        assert np.abs(w[k] - 2 * full.T @ (side * slack)).max() < 1e-5


def test_written_tables_leave_no_shuffle_files(spark):
    from lotmill.session import CLEANUP, dropped, written

    before = spark.conf.get(CLEANUP, None)
    blocks = lambda: sum(1 for b in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split() if b.startswith("shuffle"))
    n = blocks()
    table = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert blocks() <= n and spark.conf.get(CLEANUP, None) == before and table.count() == 7
    dropped(table)
    with pytest.raises(Exception):
        table.collect()
