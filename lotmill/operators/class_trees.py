"""Classification trees grown level by level on whole data: random cuts (extra trees), or best cuts with feature subsets.

Both kinds of tree share the walk of a level. With random cuts one aggregation finds the range of every feature in every
open node, a cut is drawn inside it by a hash of (seed, tree, node, feature), and a second aggregation counts the
classes left of it. With best cuts one aggregation counts classes per (node, feature, bin). Counts are whole numbers,
so the trees do not depend on the partitioning. Open nodes go in groups of bounded size; the driver sees counts of nodes, not rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.operators.bins import MOST_BINS, as_array, binned, cut_points, hashed, joined, matrix, packed, part_of
from lotmill.operators.encode import _TableReader, _TableWriter
from lotmill.session import dropped, written

BLOCK_BYTES = 4 << 20  # rows are written in blocks, as a row a time is slow to hand to Python
CELLS = 4_000_000  # counts of one pass, in each task and in the result
NODES = "tree int, node int, feature int, cut double, left int, right int, counts array<double>, offered array<int>"


@dataclass
class Node:
    """A node while its tree grows; ``begin`` is how many features of its own order were tried without a split."""

    tree: int
    number: int
    level: int
    counts: np.ndarray
    begin: int = 0
    offered: list[int] = field(default_factory=list)


def impurity(counts: np.ndarray, criterion: str) -> np.ndarray:
    """Gini impurity or entropy of class counts (last axis); 0 without rows."""
    total = counts.sum(axis=-1, keepdims=True)
    p = np.divide(counts, total, out=np.zeros(counts.shape), where=total > 0)
    if criterion == "gini":
        return np.where(total[..., 0] > 0, 1.0 - (p * p).sum(axis=-1), 0.0)
    return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(axis=-1)


def feature_order(seed: int, tree: int, node: int, width: int) -> np.ndarray:
    """All features in the order in which a node may use them."""
    keys = hashed(np.arange(width), seed * 7_368_787 + tree * 104_729 + node)
    return np.argsort(keys, kind="stable")


def subset_size(max_features: str | None, width: int) -> int:
    return {"": width, "sqrt": max(1, math.isqrt(width)), "log2": max(1, int(math.log2(width))) if width else 1}[max_features or ""]


class _Forest:
    """Trees under construction as arrays per tree."""

    def __init__(self, trees: int):
        self.feature = [[-1] for _ in range(trees)]
        self.cut = [[0.0] for _ in range(trees)]
        self.left = [[0] for _ in range(trees)]
        self.right = [[0] for _ in range(trees)]
        self.counts: list[list] = [[None] for _ in range(trees)]
        self.offered: list[list] = [[[]] for _ in range(trees)]

    def add(self, tree: int, counts: np.ndarray) -> int:
        for part, value in ((self.feature, -1), (self.cut, 0.0), (self.left, 0), (self.right, 0), (self.counts, counts), (self.offered, [])):
            part[tree].append(value)
        return len(self.feature[tree]) - 1

    def arrays(self, trees) -> dict[int, tuple]:
        return {t: (np.array(self.feature[t]), np.array(self.cut[t]), np.ascontiguousarray(np.array([self.left[t], self.right[t]]).T)) for t in trees}


def walk(rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, children: np.ndarray, levels: int | None = None) -> np.ndarray:
    """Node of every row; left where the value is at most the cut."""
    at, line = np.zeros(len(rows), np.int64), np.arange(len(rows))
    values, sides, place, here = rows.ravel(), children.ravel(), np.arange(len(rows)) * rows.shape[1], at
    while levels is None or levels > 0:
        f = feature.take(here)
        inner = np.flatnonzero(f >= 0)
        if len(inner) < len(f):  # rows in a leaf are done
            at[line] = here
            line, here, f, place = line[inner], here[inner], f[inner], place[inner]
        if not len(line):
            break
        here = sides.take(2 * here + (values.take(place + f) > cut.take(here)))
        levels = None if levels is None else levels - 1
    at[line] = here
    return at


def _blocks(batch: pa.RecordBatch, width: int, kind: str):
    """(rows, labels) of every block of a batch."""
    for values, labels in zip(batch.column(0), batch.column(1)):
        yield np.frombuffer(values.as_buffer(), kind).reshape(-1, width), np.frombuffer(labels.as_buffer(), "<i4")


def _in_nodes(rows, arrays, group, places):
    """(tree, rows in open nodes, their places) for every tree of the group."""
    for t in group:
        place = places[t][walk(rows, *arrays[t])]
        there = np.flatnonzero(place >= 0)
        if len(there):
            yield there, place[there]


def _passes(state: DataFrame, forest: _Forest, nodes: list[Node], width: int, kind: str):
    """Broadcast for a pass over the rows: trees, and the place of every open node."""
    group = sorted({n.tree for n in nodes})
    places = {t: np.full(len(forest.feature[t]), -1, np.int64) for t in group}
    for i, n in enumerate(nodes):
        places[n.tree][n.number] = i
    return group, state.sparkSession.sparkContext.broadcast((forest.arrays(group), places))


def _summed(state: DataFrame, run, size: int) -> np.ndarray:
    found = state.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # CELLS rows at most
    out = np.zeros(size, np.int64)
    out[found["slot"].to_numpy()] = found["n"].to_numpy()
    return out


def _count(sums: np.ndarray, slots: list[np.ndarray]) -> None:
    """Adds 1 at every slot; a whole count is faster when there are slots enough."""
    slots = np.concatenate([np.zeros(0, np.int64), *slots])
    if 2 * len(slots) >= len(sums):
        sums += np.bincount(slots, minlength=len(sums))
    else:
        np.add.at(sums, slots, 1)


def _nonzero(sums: np.ndarray) -> pa.RecordBatch:
    kept = np.flatnonzero(sums)
    return pa.RecordBatch.from_arrays([pa.array(kept), pa.array(sums[kept])], names=["slot", "n"])


def _sorted_places(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by place, and where each place begins. Places of 16 bits are sorted by counting."""
    order = np.argsort(place.astype(np.uint16) if len(place) and place.max() < 1 << 16 else place, kind="stable")
    return order, np.flatnonzero(np.r_[True, np.diff(place[order]) != 0])


def _ranges(state, forest, nodes, width, two, values) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value per (open node, feature). The features ``two`` have two ``values``: a bit each, 64 to a word."""
    group, shared = _passes(state, forest, nodes, width, "<f8")
    wide = np.setdiff1d(np.arange(width), two)
    words = [two[i:i + 64] for i in range(0, len(two), 64)]

    def run(batches):
        arrays, places = shared.value
        low, high = np.full((len(nodes), len(wide)), np.inf), np.full((len(nodes), len(wide)), -np.inf)
        seen = np.zeros(len(nodes), bool)
        some, every = np.zeros((len(words), len(nodes)), np.uint64), np.full((len(words), len(nodes)), ~np.uint64(0))
        for batch in batches:
            for rows, _ in _blocks(batch, width, "<f8"):
                numbers = rows[:, wide]
                bits = [((rows[:, w] == values[1, w]).astype(np.uint64) << np.arange(len(w), dtype=np.uint64)).sum(axis=1, dtype=np.uint64) for w in words]
                for there, place in _in_nodes(rows, arrays, group, places):
                    order, first = _sorted_places(place)
                    line, at = there[order], place[order][first]
                    seen[at] = True
                    here = numbers[line]
                    low[at] = np.minimum(low[at], np.minimum.reduceat(here, first))
                    high[at] = np.maximum(high[at], np.maximum.reduceat(here, first))
                    for i, b in enumerate(bits):
                        some[i, at] |= np.bitwise_or.reduceat(b[line], first)
                        every[i, at] &= np.bitwise_and.reduceat(b[line], first)
        lows, highs = np.zeros((len(nodes), width)), np.zeros((len(nodes), width))
        lows[:, wide], highs[:, wide] = low, high
        for i, w in enumerate(words):
            shift = np.arange(len(w), dtype=np.uint64)
            lows[:, w] = np.where((every[i][:, None] >> shift) & np.uint64(1), values[1, w], values[0, w])
            highs[:, w] = np.where((some[i][:, None] >> shift) & np.uint64(1), values[1, w], values[0, w])
        at = np.flatnonzero(np.repeat(seen, width) & np.isfinite(lows).ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(lows.ravel()[at]), pa.array(highs.ravel()[at])], names=["slot", "low", "high"])

    low, high = np.zeros(len(nodes) * width), np.zeros(len(nodes) * width)
    found = state.mapInArrow(run, "slot long, low double, high double").groupBy("slot").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    at = found["slot"].to_numpy()
    low[at], high[at] = found["low"].to_numpy(), found["high"].to_numpy()
    return low.reshape(-1, width), high.reshape(-1, width)


def _two_values(state, width) -> tuple[np.ndarray, np.ndarray]:
    """Features with two values in all, and smallest and largest value of every feature."""

    def run(batches):
        total = None
        for batch in batches:
            for rows, _ in _blocks(batch, width, "<f8"):
                if len(rows):
                    total = part_of(rows) if total is None else joined(total, part_of(rows))
        if total is not None:
            yield pa.RecordBatch.from_arrays([packed(np.ascontiguousarray(np.stack([total[1], total[2], total[4]]).astype("<f8")).reshape(1, -1))], names=["x"])

    out = None
    for r in state.mapInArrow(run, "x binary").collect():  # a row a task
        low, high, many = np.frombuffer(r["x"], "<f8").reshape(3, width)
        part = 1, low, high, np.zeros(width, int), many > 0
        out = part if out is None else joined(out, part)
    _, low, high, _, many = out
    return np.flatnonzero(~many & np.isfinite(low) & np.isfinite(high) & (low < high)), np.stack([low, high])


def _random_cuts(state, forest, nodes, width, classes, most, seed, two, values):
    """Per node its candidate features, their cuts, and class counts left of each."""
    low, high = _ranges(state, forest, nodes, width, two, values)
    offered, cuts = np.full((len(nodes), most), -1), np.zeros((len(nodes), most))
    for i, n in enumerate(nodes):
        order = feature_order(seed, n.tree, n.number, width)
        chosen = order[low[i, order] < high[i, order]][:most]
        offered[i, :len(chosen)] = chosen
        at = hashed(chosen, seed * 15_485_863 + n.tree * 32_452_843 + n.number)
        cuts[i, :len(chosen)] = low[i, chosen] + at * (high[i, chosen] - low[i, chosen])
    group, shared = _passes(state, forest, nodes, width, "<f8")

    def run(batches):
        arrays, places = shared.value
        sums = np.zeros(len(nodes) * most * classes, np.int64)
        for batch in batches:
            for rows, labels in _blocks(batch, width, "<f8"):
                slots, values = [], rows.ravel()
                for there, place in _in_nodes(rows, arrays, group, places):
                    f = offered[place]
                    left = (f >= 0) & (values.take((there * width)[:, None] + np.maximum(f, 0)) <= cuts[place])
                    slots.append(((place[:, None] * most + np.arange(most)) * classes + labels[there][:, None])[left])
                _count(sums, slots)
        yield _nonzero(sums)

    counts = _summed(state, run, len(nodes) * most * classes).reshape(len(nodes), most, classes)
    return offered, cuts, counts


def _best_cuts(state, forest, nodes, width, classes, most, seed, edges, bins):
    """As :func:`_random_cuts` with one candidate per bin of the node's next ``most`` features."""
    offered = np.full((len(nodes), most), -1)
    for i, n in enumerate(nodes):
        chosen = feature_order(seed, n.tree, n.number, width)[n.begin:n.begin + most] if most < width else np.arange(width)
        offered[i, :len(chosen)] = chosen
    group, shared = _passes(state, forest, nodes, width, "u1")

    def run(batches):
        arrays, places = shared.value
        sums = np.zeros(len(nodes) * most * bins * classes, np.int64)
        for batch in batches:
            for rows, labels in _blocks(batch, width, "u1"):
                slots = []
                for there, place in _in_nodes(rows, arrays, group, places):
                    f = offered[place]
                    slots.append((((place[:, None] * most + np.arange(most)) * bins + rows[there[:, None], np.maximum(f, 0)]) * classes + labels[there][:, None])[f >= 0])
                _count(sums, slots)
        yield _nonzero(sums)

    counts = _summed(state, run, len(nodes) * most * bins * classes).reshape(len(nodes), most, bins, classes)
    left = counts.cumsum(axis=2).reshape(len(nodes), most * bins, classes)
    cuts = np.broadcast_to(np.arange(bins, dtype=float), (len(nodes), most, bins)).reshape(len(nodes), -1)
    return np.repeat(offered, bins, axis=1), cuts, left


@dataclass
class TreeRows:
    """Rows as trees read them: values (or bin numbers, with the ``edges`` of the bins) and label, and the rows per class."""

    table: DataFrame
    width: int
    counts: np.ndarray
    edges: list[np.ndarray] | None

    def drop(self) -> None:
        dropped(self.table)


def tree_rows(df: DataFrame, features: str, label: str, random_cuts: bool = False, bins: int = MOST_BINS) -> TreeRows:
    """The written rows that any number of :func:`grown` forests read. Values must be known; rows without a label are left out.

    The table is read up to four times and its flat features are not kept: hand in one that is cheap to read.
    """
    rows = df.where(F.col(label).isNotNull()).select(as_array(features, df).alias("f"), F.col(label).cast("int").alias("label"))
    first, top = rows.select(F.size("f").alias("width")).first(), rows.agg(F.max("label")).first()[0]
    if top is None:
        raise ValueError("no labelled rows")
    width = first["width"]
    edges = None if random_cuts else cut_points(rows, F.col("f"), width, bins)

    def start(batches):
        for batch in batches:
            values, labels = matrix(batch.column(0), width), batch.column(1).to_numpy().astype("<i4")
            values = np.ascontiguousarray(values, "<f8") if random_cuts else binned(values, edges)
            for i in range(0, len(values), size):
                yield pa.RecordBatch.from_arrays([pa.array([v[i:i + size].tobytes()], pa.binary()) for v in (values, labels)], names=["values", "labels"])

    size = max(1, BLOCK_BYTES // (max(width, 1) * (8 if random_cuts else 1)))
    state = written(rows.mapInArrow(start, "values binary, labels binary"), "tree-rows")
    whole = np.zeros(max(2, top + 1))

    def counted(batches):
        counts = np.zeros(len(whole), np.int64)
        for batch in batches:
            for labels in batch.column(0):
                counts += np.bincount(np.frombuffer(labels.as_buffer(), "<i4"), minlength=len(counts))
        yield _nonzero(counts)

    for r in state.select("labels").mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # classes
        whole[r["slot"]] = r["n"]
    return TreeRows(state, width, whole, edges)


def grow(df: DataFrame, features: str, label: str, trees: int, depth: int, min_split: int = 2, min_leaf: int = 1, criterion: str = "gini",
         max_features: str | None = None, random_cuts: bool = False, seed: int = 42, bins: int = MOST_BINS) -> tuple[list[tuple], int, int]:
    """:func:`grown` from a table of features."""
    return grown(tree_rows(df, features, label, random_cuts, bins), trees, depth, min_split, min_leaf, criterion, max_features, seed)


def grown(rows: TreeRows, trees: int, depth: int, min_split: int = 2, min_leaf: int = 1, criterion: str = "gini", max_features: str | None = None,
          seed: int = 42) -> tuple[list[tuple], int, int]:
    """Node rows (as NODES), number of classes, number of features. Cuts are random where the rows hold values.

    A node whose subset of features has no valid cut tries the next features of its order. Ties go to the first candidate.
    """
    state, width, whole, edges = rows.table, rows.width, rows.counts, rows.edges
    classes, random_cuts = len(whole), edges is None
    bins = None if random_cuts else max(map(len, edges), default=0) + 2
    two, values = _two_values(state, width) if random_cuts else (None, None)
    forest = _Forest(trees)
    waiting = []
    for t in range(trees):
        forest.counts[t][0] = whole
        waiting.append(Node(t, 0, 0, whole))
    most = subset_size(max_features, width)
    cells = (width * 2 + most * classes) if random_cuts else most * bins * classes
    is_open = lambda n: n.level < depth and n.counts.sum() >= max(min_split, 2) and (n.counts > 0).sum() > 1
    waiting = [n for n in waiting if is_open(n)]
    while waiting:
        nodes, waiting = waiting[:max(1, CELLS // cells)], waiting[max(1, CELLS // cells):]
        if random_cuts:
            offered, cuts, left = _random_cuts(state, forest, nodes, width, classes, most, seed, two, values)
        else:
            offered, cuts, left = _best_cuts(state, forest, nodes, width, classes, most, seed, edges, bins)
        for i, n in enumerate(nodes):
            right = n.counts - left[i]
            nl, nr = left[i].sum(axis=-1), right.sum(axis=-1)
            valid = (offered[i] >= 0) & (nl >= max(1, min_leaf)) & (nr >= max(1, min_leaf))
            n.offered += [int(f) for f in dict.fromkeys(offered[i].tolist()) if f >= 0]
            if not valid.any():
                if not random_cuts and n.begin + most < width:
                    n.begin += most
                    waiting.insert(0, n)
                continue
            loss = np.where(valid, nl * impurity(left[i], criterion) + nr * impurity(right, criterion), np.inf)
            best = int(np.argmin(loss))
            f = int(offered[i, best])
            forest.feature[n.tree][n.number] = f
            forest.cut[n.tree][n.number] = float(cuts[i, best])
            forest.offered[n.tree][n.number] = n.offered
            for side, counts in ((forest.left, left[i, best].astype(float)), (forest.right, right[best].astype(float))):
                child = forest.add(n.tree, counts)
                side[n.tree][n.number] = child
                child = Node(n.tree, child, n.level + 1, counts)
                if is_open(child):
                    waiting.append(child)
    out = []
    for t in range(trees):
        for i, f in enumerate(forest.feature[t]):
            cut = forest.cut[t][i]
            if f >= 0 and not random_cuts:  # left are the bins up to the cut, i.e. the values below the next edge
                cut = float(np.nextafter(edges[f][int(cut) - 1], -np.inf))
            out.append((t, i, f, cut, forest.left[t][i], forest.right[t][i], [float(c) for c in forest.counts[t][i]], forest.offered[t][i]))
    return out, classes, width


class _TreeParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector or array of known features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "class number from 0", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    minSplit = Param(Params._dummy(), "minSplit", "rows that a node needs to be split", TypeConverters.toInt)
    minLeaf = Param(Params._dummy(), "minLeaf", "rows that a child needs", TypeConverters.toInt)
    criterion = Param(Params._dummy(), "criterion", "gini or entropy", TypeConverters.toString)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "all, sqrt or log2 features per node", TypeConverters.toString)
    randomCuts = Param(Params._dummy(), "randomCuts", "one random cut per feature and node", TypeConverters.toBoolean)
    seed = Param(Params._dummy(), "seed", "seed of cuts and subsets", TypeConverters.toInt)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "number of features", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", labelCol="label", trees=1, depth=30, minSplit=2, minLeaf=1, criterion="gini", maxFeatures="all", randomCuts=False, seed=42)


class ClassTrees(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator form of :func:`grow`."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", trees=1, depth=30, minSplit=2, minLeaf=1, criterion="gini", maxFeatures="all", randomCuts=False, seed=42):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ClassTreesModel":
        rows = self.learning_rows(df)
        model = self.fit_rows(rows)
        rows.drop()
        return model

    def learning_rows(self, df: DataFrame) -> TreeRows:
        """What :meth:`fit_rows` reads, the same for every depth, criterion and subset of features."""
        return tree_rows(df, self.getOrDefault("featuresCol"), self.getOrDefault("labelCol"), self.getOrDefault("randomCuts"))

    def fit_rows(self, rows: TreeRows) -> "ClassTreesModel":
        p = self.getOrDefault
        most = None if p("maxFeatures") == "all" else p("maxFeatures")
        nodes, classes, width = grown(rows, p("trees"), p("depth"), p("minSplit"), p("minLeaf"), p("criterion"), most, p("seed"))
        model = self._copyValues(ClassTreesModel(rows.table.sparkSession.createDataFrame(nodes, NODES).persist()))
        return model._set(classes=classes, width=width)


class ClassTreesModel(Model, _TreeParams, MLReadable, MLWritable):
    """Adds ``probability`` (mean class share of the leaves) and ``prediction``; the trees are a table of nodes."""

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self._defaults()
        self.table = table

    def _by_tree(self) -> list[list]:
        """Node rows of each tree, by node number."""
        by_tree: dict[int, list] = {}
        for r in sorted(self.table.collect(), key=lambda r: (r["tree"], r["node"])):
            by_tree.setdefault(r["tree"], []).append(r)
        return list(by_tree.values())

    def importances(self, names) -> DataFrame:
        """(feature, score): decrease of impurity by a feature's splits, scaled to sum 1 per tree, mean of the trees with a split."""
        found = np.zeros((0, len(names)))
        for rows in self._by_tree():
            counts = np.array([r["counts"] for r in rows])
            loss = counts.sum(axis=1) * impurity(counts, self.getOrDefault("criterion"))
            here = np.zeros(len(names))
            for i, r in enumerate(rows):
                if r["feature"] >= 0:
                    here[r["feature"]] += loss[i] - loss[r["left"]] - loss[r["right"]]
            if here.sum() > 0:
                found = np.vstack([found, here / here.sum()])
        means = found.mean(axis=0) if len(found) else np.zeros(len(names))
        return self.table.sparkSession.createDataFrame([(n, float(v)) for n, v in zip(names, means)], "feature string, score double")

    def _transform(self, df: DataFrame) -> DataFrame:
        trees = []
        for rows in self._by_tree():
            counts = np.array([r["counts"] for r in rows])
            trees.append((np.array([r["feature"] for r in rows]), np.array([r["cut"] for r in rows]), np.array([[r["left"], r["right"]] for r in rows]),
                          counts / np.maximum(counts.sum(axis=1, keepdims=True), 1.0)))
        shared, width, classes = df.sparkSession.sparkContext.broadcast(trees), self.getOrDefault("width"), self.getOrDefault("classes")

        @F.arrow_udf("array<double>")
        def chances(features: pa.Array) -> pa.Array:
            rows = matrix(features, width)
            p = np.zeros((len(rows), classes))
            for feature, cut, children, shares in shared.value:
                p += shares[walk(rows, feature, cut, children)]
            return pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, classes, np.int32)), pa.array((p / max(1, len(shared.value))).ravel()))

        best = lambda p: (F.array_position(p, F.array_max(p)) - 1).cast("double")
        found = df.withColumn("probability", chances(as_array(self.getOrDefault("featuresCol"), df)))
        return found.withColumn("prediction", best(F.col("probability"))).withColumn("probability", array_to_vector("probability"))

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)
