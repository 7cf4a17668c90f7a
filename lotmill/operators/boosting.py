"""Second-order gradient boosting with soft-max over classes, on binned features.

Each round grows one tree per class, all of them level by level together. A level is one aggregation: tasks sum
gradients and curvatures per (class, node, feature, bin) in numpy, Spark adds the sums of the tasks and finds the best
split of every node. Sums are whole numbers of 2^-26, so they do not depend on order or partitioning. The driver sees
one row per node; rows keep their margins in a table that is rewritten every few rounds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotmill.operators.bins import MOST_BINS, as_array, binned, cut_points, hashed, matrix, packed, unpacked
from lotmill.operators.copies import count_copies, unfold
from lotmill.operators.encode import _TableReader, _TableWriter
from lotmill.session import kept, written

SCALE = 1 << 26
LEAST_GAIN = 1e-6
ROUNDS_PER_WRITE = 5  # margins are written to the shared folder that often: plans stay short, and a lost executor costs little

NODES = "round int, class int, node long, feature int, cut double, bin int, missing_left boolean, value double, gain double"


@dataclass
class Tree:
    """One tree as arrays by node number (root 1, children 2n and 2n + 1); feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = 2 << depth
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.zeros(n))

    def nodes(self, rows: np.ndarray, levels: int) -> np.ndarray:
        """Node of every binned row after ``levels`` steps."""
        at, line = np.ones(len(rows), np.int64), np.arange(len(rows))
        for _ in range(levels):
            f = self.feature[at]
            b = rows[line, np.maximum(f, 0)]
            right = np.where(b == 0, ~self.missing_left[at], b > self.bin[at])
            at = np.where(f >= 0, 2 * at + right, at)
        return at


def gradients(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the soft-max loss per row and class, as whole numbers of 1 / SCALE."""
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    p = e / e.sum(axis=1, keepdims=True)
    g = p - (labels[:, None] == np.arange(margins.shape[1]))
    h = np.maximum(2.0 * p * (1.0 - p), 1e-16)
    return np.rint(g * SCALE).astype(np.int64), np.rint(h * SCALE).astype(np.int64)


def _histograms(state: DataFrame, trees: list[Tree], open_nodes: list[np.ndarray], level: int, width: int, bins: int, salt: int, share: float) -> DataFrame:
    """(place, feature, bin, g, h): sums per open node, combined in the tasks first."""
    places = []
    for nodes in open_nodes:
        place = np.full(2 << level, -1, np.int64)
        place[nodes] = np.arange(len(nodes))
        places.append(place)
    begins = np.cumsum([0, *map(len, open_nodes)])
    shared = state.sparkSession.sparkContext.broadcast((trees, places))

    def run(batches):
        trees, places = shared.value
        size = int(begins[-1]) * width * bins
        sums_g, sums_h = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            rows, labels, keys, margins = _unpacked(batch, width, len(trees))
            if share < 1.0:
                chosen = hashed(keys, salt) < share
                rows, labels, margins = rows[chosen], labels[chosen], margins[chosen]
            if not len(rows):
                continue
            g, h = gradients(margins, labels)
            for c, tree in enumerate(trees):
                node = places[c][tree.nodes(rows, level)]
                there = node >= 0
                if not there.any():
                    continue
                slot = (((begins[c] + node[there])[:, None] * width + np.arange(width)) * bins + rows[there]).ravel()
                for sums, part in ((sums_g, g[there, c]), (sums_h, h[there, c])):
                    np.add.at(sums, slot, np.repeat(part, width))
        kept = np.flatnonzero(sums_h)
        place, feature, at = kept // (width * bins), kept // bins % width, kept % bins
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(feature.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(sums_g[kept]), pa.array(sums_h[kept])],
                                         names=["place", "feature", "bin", "g", "h"])

    # a task has each slot once, so combining again before the shuffle saves nothing; one shuffle serves the sums and the windows
    found = state.mapInArrow(run, "place int, feature int, bin int, g long, h long").repartition("place", "feature")
    return found.groupBy("place", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(sums: DataFrame, reg: float, least_weight: float) -> DataFrame:
    """Best split per node, or totals only: (place, g, h, feature, bin, missing_left, gain, gl, hl).

    Ties go to the smaller feature, then the smaller bin, then to missing values on the right.
    """
    slots = sums.select("place", "feature", "bin",
                        (F.col("g") / F.lit(float(SCALE))).alias("g"), (F.col("h") / F.lit(float(SCALE))).alias("h"))
    side = Window.partitionBy("place", "feature")  # at most 256 rows
    upto = side.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    missing = lambda c: F.sum(F.when(F.col("bin") == 0, F.col(c)).otherwise(0.0)).over(side)
    seen = lambda c: F.sum(F.when(F.col("bin") > 0, F.col(c)).otherwise(0.0)).over(upto)
    rows = slots.select("place", "feature", "bin", F.sum("g").over(side).alias("ga"), F.sum("h").over(side).alias("ha"),
                        seen("g").alias("gs"), seen("h").alias("hs"), missing("g").alias("gm"), missing("h").alias("hm"))
    sides = rows.select("place", "feature", "bin", "ga", "ha", F.explode(F.array(
        F.struct(F.lit(False).alias("missing_left"), F.col("gs").alias("gl"), F.col("hs").alias("hl")),
        F.struct(F.lit(True).alias("missing_left"), (F.col("gs") + F.col("gm")).alias("gl"), (F.col("hs") + F.col("hm")).alias("hl")))).alias("s"))
    sides = sides.select("place", "feature", "bin", "ga", "ha", "s.*")
    part = lambda g, h: g * g / (h + F.lit(reg))
    gr, hr = F.col("ga") - F.col("gl"), F.col("ha") - F.col("hl")
    gain = part(F.col("gl"), F.col("hl")) + part(gr, hr) - part(F.col("ga"), F.col("ha"))
    valid = (F.col("bin") > 0) & (F.col("hl") >= least_weight) & (hr >= least_weight) & (hr > 0)
    order = F.struct(F.col("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), (~F.col("missing_left")).alias("m"))
    scored = sides.withColumn("gain", F.when(valid & (gain > LEAST_GAIN), gain))
    best = F.max_by(F.struct("feature", "bin", "missing_left", "gain", "gl", "hl"), F.when(F.col("gain").isNotNull(), order))
    return scored.groupBy("place").agg(F.max("ga").alias("g"), F.max("ha").alias("h"), best.alias("b")).select("place", "g", "h", "b.*")


def _unpacked(batch: pa.RecordBatch, width: int, classes: int):
    rows, margins = unpacked(batch.column(0), "u1", width), unpacked(batch.column(3), "<f8", classes)
    return rows, batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False), margins


_STATE = "bins binary, label int, key long, margins binary"


def grow(df: DataFrame, features: str, label: str, rounds: int, depth: int, rate: float, subsample: float = 1.0, bins: int = MOST_BINS, reg: float = 1.0,
         least_weight: float = 1.0, seed: int = 42, key: str | None = None, cuts: list[np.ndarray] | None = None) -> tuple[list[tuple], int, int]:
    """Node rows (as NODES) of ``rounds`` x classes trees, the number of classes, and of features.

    Rows without a label are left out. With ``subsample`` below 1 a row is drawn by a hash of its ``key`` (a column that tells
    rows apart) or, without one, of its content and copy number, so the draw does not depend on the partitioning. The table
    is read three times and its flat features are not kept: hand in one that is cheap to read.
    """
    spark = df.sparkSession
    rows = df.where(F.col(label).isNotNull())
    if subsample >= 1.0:
        keyed = rows.select(as_array(features, df).alias("f"), F.col(label).cast("int").alias("label"), F.lit(0).cast("long").alias("key"))
    elif key:
        keyed = rows.select(as_array(features, df).alias("f"), F.col(label).cast("int").alias("label"), F.xxhash64(key).alias("key"))
    else:
        counted = kept(count_copies(rows.select(as_array(features, df).alias("f"), F.col(label).cast("int").alias("label")), "_times"), "copies")
        keyed = unfold(counted, "_times", "copy", keep=False).select("f", "label", F.xxhash64("f", "label", "copy").alias("key"))
    shape = keyed.agg(F.max(F.size("f")).alias("width"), F.max("label").alias("top")).first()
    if shape["top"] is None:
        raise ValueError("no labelled rows")
    width, classes = shape["width"], max(2, shape["top"] + 1)
    cuts = cuts or cut_points(keyed, F.col("f"), width, bins)

    def start(batches):
        for batch in batches:
            rows = binned(matrix(batch.column(0), width), cuts)
            yield pa.RecordBatch.from_arrays([packed(rows), batch.column(1), batch.column(2), packed(np.zeros((len(rows), classes)))], names=["bins", "label", "key", "margins"])

    state = written(keyed.mapInArrow(start, _STATE), "margins")
    out = []
    for number in range(rounds):
        trees = [Tree.empty(depth) for _ in range(classes)]
        open_nodes = [np.array([1])] * classes
        for level in range(depth):
            begins = np.cumsum([0, *map(len, open_nodes)])
            if not begins[-1]:
                break
            sums = _histograms(state, trees, open_nodes, level, width, bins, seed * 1_000_003 + number, subsample)
            found = {r["place"]: r for r in best_splits(sums, reg, least_weight).collect()}  # one row per open node
            following = []
            for c, (tree, nodes) in enumerate(zip(trees, open_nodes)):
                opened = []
                for place, node in enumerate(nodes, int(begins[c])):
                    r = found.get(place)
                    if r is None:
                        continue
                    if r["feature"] is None:
                        tree.value[node] = -r["g"] / (r["h"] + reg) * rate
                        continue
                    tree.feature[node], tree.bin[node], tree.missing_left[node] = r["feature"], r["bin"], r["missing_left"]
                    for child, g, h in ((2 * node, r["gl"], r["hl"]), (2 * node + 1, r["g"] - r["gl"], r["h"] - r["hl"])):
                        tree.value[child] = -g / (h + reg) * rate
                        opened.append(child)
                    edges = cuts[r["feature"]]  # behind the last one, known values are split from missing ones
                    cut = float(edges[r["bin"] - 1]) if r["bin"] <= len(edges) else float("inf")
                    out.append((number, c, int(node), r["feature"], cut, r["bin"], r["missing_left"], 0.0, r["gain"]))
                following.append(np.array(opened, np.int64))
            open_nodes = following
        for c, tree in enumerate(trees):
            inner = np.flatnonzero(tree.feature >= 0)
            leaves = [1] if not len(inner) else [n for i in inner for n in (2 * i, 2 * i + 1) if tree.feature[n] < 0]
            out += [(number, c, int(n), -1, None, 0, False, float(tree.value[n]), 0.0) for n in leaves]
        if number + 1 < rounds:
            state = _stepped(spark, state, trees, depth, width, classes, number)
    state.unpersist()
    return out, classes, width


def _stepped(spark, state: DataFrame, trees: list[Tree], depth: int, width: int, classes: int, number: int) -> DataFrame:
    """The rows with the margins of one more round."""
    shared = spark.sparkContext.broadcast(trees)

    def run(batches):
        for batch in batches:
            rows, _, _, margins = _unpacked(batch, width, classes)
            step = np.column_stack([t.value[t.nodes(rows, depth)] for t in shared.value]) if len(rows) else margins
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), packed(margins + step)], names=["bins", "label", "key", "margins"])

    after = state.mapInArrow(run, _STATE)
    if (number + 1) % ROUNDS_PER_WRITE == 0:
        after = written(after, "margins")
    else:
        after = after.persist(StorageLevel.MEMORY_AND_DISK)
        after.count()
    state.unpersist()
    return after


class _BoostParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector or array of features; NaN is missing", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "class number from 0", TypeConverters.toString)
    rounds = Param(Params._dummy(), "rounds", "trees per class", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "factor of the leaf values", TypeConverters.toFloat)
    subsample = Param(Params._dummy(), "subsample", "share of rows drawn for a round", TypeConverters.toFloat)
    reg = Param(Params._dummy(), "reg", "added to the curvature of a node", TypeConverters.toFloat)
    leastWeight = Param(Params._dummy(), "leastWeight", "least curvature of a child", TypeConverters.toFloat)
    bins = Param(Params._dummy(), "bins", "bins per feature, 256 at most", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the row draws", TypeConverters.toInt)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "number of features", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", labelCol="label", rounds=100, depth=6, rate=0.3, subsample=1.0, reg=1.0, leastWeight=1.0, bins=MOST_BINS, seed=42)


class BoostedTrees(Estimator, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator form of :func:`grow`."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", rounds=100, depth=6, rate=0.3, subsample=1.0, reg=1.0, leastWeight=1.0, bins=MOST_BINS, seed=42):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "BoostedTreesModel":
        p = self.getOrDefault
        nodes, classes, width = grow(df, p("featuresCol"), p("labelCol"), p("rounds"), p("depth"), p("rate"), p("subsample"), p("bins"), p("reg"), p("leastWeight"), p("seed"))
        model = self._copyValues(BoostedTreesModel(df.sparkSession.createDataFrame(nodes, NODES).persist()))
        return model._set(classes=classes, width=width)


class BoostedTreesModel(Model, _BoostParams, MLReadable, MLWritable):
    """Adds ``probability`` and ``prediction``; the trees are a table of nodes."""

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self._defaults()
        self.table = table
        self._scorer = None

    def importances(self, names) -> DataFrame:
        """(feature, score, total_gain, splits): mean gain of a feature's splits, scaled to sum 1; features without a split score 0."""
        named = self.table.sparkSession.createDataFrame(list(enumerate(names)), "place int, name string")
        gains = self.table.where("feature >= 0").groupBy("feature").agg(F.sum("gain").alias("total_gain"), F.count(F.lit(1)).alias("splits"))
        rows = named.join(F.broadcast(gains), F.col("place") == gains["feature"], "left").select(
            F.col("name").alias("feature"), F.coalesce("total_gain", F.lit(0.0)).alias("total_gain"), F.coalesce("splits", F.lit(0).cast("long")).alias("splits"))
        mean = F.coalesce(F.try_divide(F.col("total_gain"), F.col("splits")), F.lit(0.0))
        whole = F.sum(mean).over(Window.partitionBy())  # one row per feature
        return rows.select("feature", F.coalesce(F.try_divide(mean, whole), F.lit(0.0)).alias("score"), "total_gain", "splits")

    def _margins(self):
        """Function of a matrix; the trees are as large as the model, not as the data."""
        if self._scorer is None:
            by_tree: dict[tuple[int, int], list] = {}
            for r in self.table.collect():
                by_tree.setdefault((r["round"], r["class"]), []).append(r)
            trees = []
            for (_, c), rows in sorted(by_tree.items()):
                place = {r["node"]: i for i, r in enumerate(sorted(rows, key=lambda r: r["node"]))}
                rows = sorted(rows, key=lambda r: r["node"])
                trees.append((c, np.array([r["feature"] for r in rows]), np.array([np.nan if r["cut"] is None else r["cut"] for r in rows]), np.array([r["missing_left"] for r in rows]),
                              np.array([r["value"] for r in rows]), np.array([[place.get(2 * r["node"], 0), place.get(2 * r["node"] + 1, 0)] for r in rows])))
            self._scorer = trees, self.getOrDefault("classes")
        return self._scorer

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self._margins())
        width = self.getOrDefault("width")

        @F.arrow_udf("array<double>")
        def chances(features: pa.Array) -> pa.Array:
            trees, classes = shared.value
            rows = matrix(features, width)
            margins, line = np.zeros((len(rows), classes)), np.arange(len(rows))
            for c, feature, cut, missing_left, value, children in trees:
                at = np.zeros(len(rows), np.int64)
                while True:
                    f = feature[at]
                    if (f < 0).all():
                        break
                    x = rows[line, np.maximum(f, 0)]
                    right = np.where(np.isnan(x), ~missing_left[at], x >= cut[at])
                    at = np.where(f >= 0, children[at, right.astype(np.int64)], at)
                margins[:, c] += value[at]
            e = np.exp(margins - margins.max(axis=1, keepdims=True)) if len(rows) else margins
            p = e / e.sum(axis=1, keepdims=True) if len(rows) else margins
            return pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, classes, np.int32)), pa.array(p.ravel()))

        found = chances(as_array(self.getOrDefault("featuresCol"), df))
        best = lambda p: (F.array_position(p, F.array_max(p)) - 1).cast("double")
        return df.withColumn("probability", found).withColumn("prediction", best(F.col("probability"))).withColumn("probability", array_to_vector("probability"))

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)
