"""Passes of extra trees: rows come in blocks, ranges of features with two values come from bits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotmill.operators import class_trees
from lotmill.operators.class_trees import Node, _Forest, _ranges, _two_values, grow, tree_rows, walk


def _rows(n=500, seed=4):
    rng = np.random.default_rng(seed)
    x = np.hstack([rng.normal(size=(n, 3)), rng.integers(0, 2, (n, 70)) * 3.0 - 1.0, np.full((n, 1), 2.0), (rng.random((n, 1)) < 0.01) * 1.0])
    return x, ((x[:, 0] > 0) * 1 + (x[:, 5] > 0) * 1).astype(int)


def _table(spark, x, y, partitions=3):
    return spark.createDataFrame([([float(v) for v in row], int(k)) for row, k in zip(x, y)], "features array<double>, label int").repartition(partitions)


def test_rows_are_written_in_blocks(spark, monkeypatch):
    x, y = _rows()
    rows = tree_rows(_table(spark, x, y), "features", "label", random_cuts=True)
    assert rows.table.count() <= 3 and rows.counts.tolist() == np.bincount(y).tolist()
    monkeypatch.setattr(class_trees, "BLOCK_BYTES", 10 * 8 * x.shape[1])
    small = tree_rows(_table(spark, x, y), "features", "label", random_cuts=True)
    assert small.table.count() >= 50 and small.counts.tolist() == rows.counts.tolist()
    same = [class_trees.grown(r, 3, 4, max_features="sqrt", seed=3) for r in (rows, small)]
    assert same[0] == same[1] and len(same[0][0]) > 10


@pytest.mark.parametrize("trees", [1, 2])
def test_ranges_of_nodes(spark, trees):
    x, y = _rows()
    rows = tree_rows(_table(spark, x, y), "features", "label", random_cuts=True)
    two, values = _two_values(rows.table, x.shape[1])
    assert two.tolist() == [*range(3, 73), 74]
    forest, nodes = _Forest(trees), []
    for t in range(trees):  # one split each; the left side of the second tree is closed
        forest.feature[t][0], forest.cut[t][0] = t, 0.1
        forest.left[t][0], forest.right[t][0] = forest.add(t, None), forest.add(t, None)
        nodes += [Node(t, forest.right[t][0], 1, None)] if t else [Node(t, forest.left[t][0], 1, None), Node(t, forest.right[t][0], 1, None)]
    low, high = _ranges(rows.table, forest, nodes, x.shape[1], two, values)
    for i, n in enumerate(nodes):
        own = x[(x[:, n.tree] > 0.1) == (n.number == forest.right[n.tree][0])]
        assert (low[i] == own.min(axis=0)).all() and (high[i] == own.max(axis=0)).all()


@pytest.mark.parametrize("levels", [None, 0, 1, 2, 9])
def test_walk_equals_a_plain_walk(levels):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    feature = np.array([2, 0, -1, 3, -1, 1, -1, -1, -1])
    cut, children = rng.normal(size=9) / 3, np.array([[1, 2], [3, 4], [0, 0], [5, 6], [0, 0], [7, 8], [0, 0], [0, 0], [0, 0]])
    want = []
    for row in x:
        node, left = 0, 99 if levels is None else levels
        while feature[node] >= 0 and left > 0:
            node, left = children[node, int(row[feature[node]] > cut[node])], left - 1
        want.append(node)
    assert walk(x, feature, cut, children, levels).tolist() == want
    assert walk(x[:0], feature, cut, children, levels).tolist() == []


def test_counts_do_not_depend_on_how_they_are_added(spark):
    slots = np.array([3, 3, 1])
    for size in (5, 500):
        sums = np.zeros(size, np.int64)
        class_trees._count(sums, [slots, slots[:0], slots[:1]])
        assert sums[3] == 3 and sums[1] == 1 and sums.sum() == 4


def test_labels_without_rows_and_nulls(spark):
    x, y = _rows(60)
    df = _table(spark, x, y).withColumn("label", F.when(F.col("label") != 1, F.col("label")))
    nodes, classes, width = grow(df, "features", "label", 1, 3, random_cuts=True)
    assert classes == 3 and width == x.shape[1] and sum(nodes[0][6]) == (y != 1).sum()
