"""Boosted and random trees and linear machines against plain numpy versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotmill.operators import boosting
from lotmill.operators.bins import cut_points


def table_of(spark, x, y, partitions):
    rows = [([None if np.isnan(v) else float(v) for v in r], int(label)) for r, label in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label int").repartition(partitions)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(600, 4)), 2)
    x[:, 2] = rng.integers(0, 3, 600)
    x[rng.random(600) < 0.1, 1] = np.nan
    y = (x[:, 0] + x[:, 2] > 1).astype(int) + ((np.nan_to_num(x[:, 1], nan=2.0) > 0.5) & (x[:, 3] > 0))
    return x, y


def plain_booster(x, y, cuts, rounds, depth, rate, reg=1.0, least=1.0):
    """Nested-loop booster over the same cuts; returns margins, and the gains of each feature."""
    classes, margins, gains = int(y.max()) + 1, np.zeros((len(x), int(y.max()) + 1)), {}

    def node(rows, g, h, level, out):
        ga, ha = g[rows].sum(), h[rows].sum()
        best = None
        if level < depth:
            for f in range(x.shape[1]):
                for c in [*cuts[f], np.inf]:  # the last one splits known from missing values
                    for missing_left in (False, True):
                        v = x[rows, f]
                        left = np.where(np.isnan(v), missing_left, v < c)
                        if not left.any() or left.all():
                            continue
                        gl, hl = g[rows][left].sum(), h[rows][left].sum()
                        gr, hr = ga - gl, ha - hl
                        if hl < least or hr < least:
                            continue
                        gain = gl * gl / (hl + reg) + gr * gr / (hr + reg) - ga * ga / (ha + reg)
                        if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                            best = gain, f, left
        if best is None:
            out[rows] = -ga / (ha + reg) * rate
            return
        gains.setdefault(best[1], []).append(best[0])
        node(rows[best[2]], g, h, level + 1, out)
        node(rows[~best[2]], g, h, level + 1, out)

    for _ in range(rounds):
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        step = np.zeros_like(margins)
        for c in range(classes):
            out = np.zeros(len(x))
            node(np.arange(len(x)), p[:, c] - (y == c), np.maximum(2 * p[:, c] * (1 - p[:, c]), 1e-16), 0, out)
            step[:, c] = out
        margins += step
    return margins, gains


def probabilities(model, df):
    rows = model.transform(df).select("features", "label", "probability").collect()
    return {(tuple(r["features"]), r["label"]): r["probability"].toArray() for r in rows}


def test_boosting_equals_a_plain_booster(spark, sample):
    x, y = sample
    df = table_of(spark, x, y, 5)
    cuts = cut_points(df, F.col("features"), 4, 40)
    assert all(len(c) <= 38 for c in cuts) and list(cuts[2]) == [1.0, 2.0]
    model = boosting.BoostedTrees(rounds=3, depth=3, rate=0.3, bins=40).fit(df)
    margins, gains = plain_booster(x, y, cuts, 3, 3, 0.3)
    e = np.exp(margins)
    want = e / e.sum(axis=1, keepdims=True)
    found = probabilities(model, df)
    for row, label, p in zip(x, y, want):
        key = tuple(None if np.isnan(v) else float(v) for v in row), int(label)
        assert np.abs(found[key] - p).max() < 1e-6
    means = {f: np.mean(v) for f, v in gains.items()}
    for r in model.importances(["0", "1", "2", "3"]).collect():
        f = int(r["feature"])
        assert r["splits"] == len(gains.get(f, [])) and r["score"] == pytest.approx(means.get(f, 0.0) / sum(means.values()), abs=1e-6)


def test_boosting_is_independent_of_partitioning_and_survives_saving(spark, sample, tmp_path):
    x, y = sample
    models = [boosting.BoostedTrees(rounds=2, depth=2, subsample=0.7, seed=5).fit(table_of(spark, x, y, n)) for n in (1, 6)]
    tables = [sorted(map(str, m.table.collect())) for m in models]
    assert tables[0] == tables[1]
    other = boosting.BoostedTrees(rounds=2, depth=2, subsample=0.7, seed=6).fit(table_of(spark, x, y, 2))
    assert sorted(map(str, other.table.collect())) != tables[0]
    models[0].write().overwrite().save(str(tmp_path / "m"))
    again = boosting.BoostedTreesModel.load(str(tmp_path / "m"))
    df = table_of(spark, x, y, 3)
    a, b = probabilities(models[0], df), probabilities(again, df)
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_boosting_of_constant_features_and_single_class(spark):
    df = spark.createDataFrame([([1.0, None], 0)] * 5, "features array<double>, label int")
    model = boosting.BoostedTrees(rounds=2, depth=2).fit(df)
    assert {r["prediction"] for r in model.transform(df).collect()} == {0.0}
    with pytest.raises(ValueError):
        boosting.BoostedTrees().fit(df.limit(0))


# ---- class trees ------------------------------------------------------------------------------


def plain_tree(x, y, classes, depth, pick, min_split=2, min_leaf=1, criterion="gini"):
    """Nested tree as {path: (feature, cut)}; ``pick(rows, path)`` lists candidate (feature, cut) with values <= cut on the left."""
    from lotmill.operators.class_trees import impurity

    out, todo = {}, [((), np.arange(len(x)))]
    while todo:
        path, rows = todo.pop(0)
        counts = np.bincount(y[rows], minlength=classes)
        if len(path) >= depth or len(rows) < min_split or (counts > 0).sum() < 2:
            continue
        best = None
        for f, cut in pick(rows, path):
            left = x[rows, f] <= cut
            if left.sum() < min_leaf or (~left).sum() < min_leaf:
                continue
            parts = [np.bincount(y[rows][side], minlength=classes).astype(float) for side in (left, ~left)]
            loss = sum(p.sum() * impurity(p, criterion) for p in parts)
            if best is None or loss < best[0]:
                best = loss, f, cut, left
        if best is not None:
            out[path] = best[1], best[2]
            todo += [((*path, 0), rows[best[3]]), ((*path, 1), rows[~best[3]])]
    return out


def grown(nodes, tree=0):
    """The same form from node rows, and the node number behind every path."""
    by_number = {n[1]: n for n in nodes if n[0] == tree}
    out, numbers, todo = {}, {}, [((), 0)]
    while todo:
        path, number = todo.pop()
        numbers[path] = number
        _, _, feature, cut, left, right, _, _ = by_number[number]
        if feature >= 0:
            out[path] = feature, cut
            todo += [((*path, 0), left), ((*path, 1), right)]
    return out, numbers


@pytest.mark.parametrize("criterion, min_split, min_leaf", [("gini", 2, 1), ("entropy", 10, 8)])
def test_best_cuts_equal_a_plain_tree(spark, sample, criterion, min_split, min_leaf):
    from lotmill.operators import class_trees

    x, y = np.nan_to_num(sample[0]), sample[1]
    df = table_of(spark, x, y, 4)
    nodes, classes, _ = class_trees.grow(df, "features", "label", 1, 4, min_split, min_leaf, criterion, bins=64)
    cuts = [np.nextafter(c, -np.inf) for c in cut_points(df, F.col("features"), 4, 64)]
    pick = lambda rows, path: [(f, c) for f in range(4) for c in cuts[f]]
    want = plain_tree(x, y, classes, 4, pick, min_split, min_leaf, criterion)
    found, _ = grown(nodes)
    assert found == want


def test_feature_subsets_per_node(spark, sample):
    from lotmill.operators import class_trees

    x, y = np.nan_to_num(sample[0]), sample[1]
    x = np.hstack([x, np.zeros((len(x), 5))])  # nine features, five of them constant
    by_partitions = []
    for partitions in (1, 5):
        by_partitions.append([class_trees.grow(table_of(spark, x, y, partitions), "features", "label", 1, 4, max_features=most, seed=9)[0] for most in (None, "sqrt", "log2")])
    assert by_partitions[0] == by_partitions[1]
    whole, sqrt, log2 = by_partitions[0]
    assert all(n[7] == list(range(9)) for n in whole if n[2] >= 0)
    for nodes in (sqrt, log2):
        for tree, number, feature, _, _, _, _, offered in nodes:
            if feature >= 0:
                order = class_trees.feature_order(9, tree, number, 9).tolist()
                assert len(offered) % 3 == 0 and offered == order[:len(offered)] and feature in offered[-3:]
                assert all(f >= 4 for f in offered[:-3])  # earlier subsets had constant features only
    assert len({tuple(n[7]) for n in sqrt if n[2] >= 0}) > 1


def test_random_cuts_equal_a_plain_tree(spark, sample):
    from lotmill.operators import class_trees
    from lotmill.operators.bins import hashed

    x, y = np.nan_to_num(sample[0]), sample[1]
    grown_by = [class_trees.grow(table_of(spark, x, y, n), "features", "label", 3, 5, 4, max_features="sqrt", random_cuts=True, seed=7)[0] for n in (1, 6)]
    assert grown_by[0] == grown_by[1]
    for tree in range(3):
        found, numbers = grown(grown_by[0], tree)

        def pick(rows, path):
            number = numbers.get(path)
            if number is None:
                return []
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            chosen = [f for f in class_trees.feature_order(7, tree, number, 4) if low[f] < high[f]][:2]
            at = hashed(np.array(chosen, np.int64), 7 * 15_485_863 + tree * 32_452_843 + number)
            return [(f, low[f] + u * (high[f] - low[f])) for f, u in zip(chosen, at)]

        assert plain_tree(x, y, 3, 5, pick, 4) == found
    cuts = {(t, c) for t, _, f, c, *_ in grown_by[0] if f >= 0}
    assert len(cuts) > 10


def test_class_trees_score_and_save(spark, sample, tmp_path):
    from lotmill.operators import class_trees

    x, y = np.nan_to_num(sample[0]), sample[1]
    df = table_of(spark, x, y, 3)
    model = class_trees.ClassTrees(trees=10, depth=10, maxFeatures="sqrt", randomCuts=True).fit(df)
    right = model.transform(df).where("prediction = label").count()
    assert right > 0.95 * len(y)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = class_trees.ClassTreesModel.load(str(tmp_path / "m"))
    a, b = probabilities(model, df), probabilities(again, df)
    assert all(np.array_equal(a[k], b[k]) for k in a) and all(abs(p.sum() - 1) < 1e-12 for p in a.values())


# ---- linear machines --------------------------------------------------------------------------


def squared_hinge(w, x, side, c):
    slack = np.maximum(0.0, 1.0 - side * (x @ w[:-1] + w[-1]))
    return 0.5 * w @ w + c * (slack ** 2).sum()


@pytest.mark.parametrize("c", [0.01, 1.0, 100.0])
def test_squared_hinge_reaches_the_minimum(spark, sample, c):
    from lotmill.operators.linear import SquaredHingeSVM

    x, y = np.nan_to_num(sample[0]), sample[1]
    df = table_of(spark, x, y, 4)
    model = SquaredHingeSVM(C=c).fit(df)
    for k, w in enumerate(model.weights()):
        side = np.where(y == k, 1.0, -1.0)
        v = np.zeros(x.shape[1] + 1)
        for _ in range(2_000):  # plain Newton steps with halving
            margin = side * (x @ v[:-1] + v[-1])
            active = margin < 1
            xa = np.hstack([x[active], np.ones((active.sum(), 1))])
            grad = v - 2 * c * xa.T @ (side[active] * (1 - margin[active]))
            if np.abs(grad).max() < 1e-10:
                break
            step, t = np.linalg.solve(np.eye(len(v)) + 2 * c * xa.T @ xa, -grad), 1.0
            while squared_hinge(v + t * step, x, side, c) > squared_hinge(v, x, side, c) and t > 1e-12:
                t /= 2
            v = v + t * step
        best = squared_hinge(v, x, side, c)
        assert squared_hinge(np.array(w), x, side, c) <= best * (1 + 1e-6)
        assert np.abs(np.array(w) - v).max() < 1e-5


def test_squared_hinge_scores_and_saves(spark, sample, tmp_path):
    from lotmill.operators.linear import SquaredHingeSVM, SquaredHingeSVMModel

    x, y = np.nan_to_num(sample[0]), sample[1]
    df = table_of(spark, x, y, 2)
    model = SquaredHingeSVM(C=1.0).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    for m in (model, SquaredHingeSVMModel.load(str(tmp_path / "m"))):
        scores = np.array([[*w[:-1]] for w in m.weights()]) @ x.T + np.array([[w[-1]] for w in m.weights()])
        want = {tuple(map(float, r)): float(p) for r, p in zip(x, scores.argmax(axis=0))}
        assert all(want[tuple(r["features"])] == r["prediction"] for r in m.transform(df).collect())
    with pytest.raises(ValueError):
        SquaredHingeSVM().fit(df.limit(0))


def test_packed_rows_come_back_from_slices_and_empty_columns():
    from lotmill.operators.bins import packed, unpacked

    for kind in ("u1", "<f8"):
        rows = np.arange(12).reshape(4, 3).astype(kind)
        column = packed(rows)
        assert (unpacked(column, kind, 3) == rows).all() and (unpacked(column.slice(1, 2), kind, 3) == rows[1:3]).all()
        assert unpacked(column.slice(0, 0), kind, 3).shape == (0, 3)
