"""Approximate nearest neighbours by a forest of random-projection trees.

The split planes of all trees are fitted on a bounded sample; every vector is then routed to one leaf per tree.
A query walks all trees through one shared priority queue ordered by the worst margin on the way. How many leaves it
takes is measured: for a bounded sample of queries the exact neighbours are found by comparing them with all vectors, and
their places in the queues give the fewest leaves that hold TARGET of them; the rule is the same at every size. The leaves'
vectors are reranked by exact inner products in double precision: the first leaves of a query (one per tree) give a score
that k + 1 of its vectors reach, and of all further leaves only vectors that reach it leave their task.

Largest inner product is turned into nearness by one more component, ``sqrt(M^2 - |x|^2)`` with the largest norm M, for
routing only. Equal vectors are one candidate that carries its smallest ids, as no query needs more of them.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotmill.llm.common import written

TREES = 12
LEAF = 256  # vectors expected per leaf
SAMPLE = 20_000  # vectors that the planes are fitted on
PROBES = 100  # sampled queries whose exact neighbours set the number of leaves
TARGET = 0.94  # share of these neighbours that the leaves have to hold
PER_TASK = 2_048  # queries that meet one leaf in one task


class Forest:
    """Split planes; children of node i are 2i + 1 and 2i + 2, leaves are numbered from 0 per tree."""

    def __init__(self, sample: np.ndarray, total: int, trees: int, leaf: int, seed: int):
        rng = np.random.default_rng(seed)
        self.depth = max(0, int(np.ceil(np.log2(max(1, total) / leaf))))
        nodes = (1 << self.depth) - 1
        self.planes = np.zeros((trees, nodes, sample.shape[1]), np.float32)
        self.offsets = np.zeros((trees, nodes), np.float32)
        for t in range(trees):
            groups = [np.arange(len(sample))]
            for i in range(nodes):
                group = groups[i]
                plane = rng.standard_normal(sample.shape[1])
                if len(group) > 1:
                    a, b = rng.choice(len(group), 2, replace=False)
                    gap = sample[group[a]] - sample[group[b]]
                    plane = gap if np.linalg.norm(gap) > 1e-9 else plane
                plane = plane / np.linalg.norm(plane)
                values = sample[group] @ plane
                self.planes[t, i], self.offsets[t, i] = plane, np.median(values) if len(group) else 0.0
                left = values <= self.offsets[t, i]
                groups += [group[left], group[~left]]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Signed distances, rows x trees x nodes; above 0 is the right child."""
        trees, nodes, width = self.planes.shape
        return (x @ self.planes.reshape(-1, width).T).reshape(len(x), trees, nodes) - self.offsets

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf per row and tree."""
        margins = self.margins(x)
        trees = margins.shape[1]
        node = np.zeros((len(x), trees), np.int64)
        rows, cols = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        for _ in range(self.depth):
            node = 2 * node + 1 + (margins[rows, cols, node] > 0)
        return node - (1 << self.depth) + 1

    def search(self, margins: np.ndarray, wanted: int) -> list[tuple[int, int]]:
        """The first ``wanted`` (tree, leaf) in the order of one queue over all trees, for one query."""
        first = (1 << self.depth) - 1
        queue = [(-np.inf, t, 0) for t in range(margins.shape[0])]
        out = []
        while queue and len(out) < wanted:
            cost, t, node = heapq.heappop(queue)
            row = margins[t]
            while node < first:
                m = row[node]
                near = 2 * node + 1 + (m > 0)
                heapq.heappush(queue, (max(cost, abs(m)), t, 4 * node + 3 - near))
                node = near
            out.append((t, node - first))
        return out


def _leaves_wanted(probes: list, classes: DataFrame, forest, extended, k: int) -> int:
    """The fewest leaves per query that hold TARGET of the exact neighbours of ``probes`` (rows of class c, vector v).

    All vectors are compared with the probes; a task keeps k nearest per probe, with their leaves, whatever its size.
    """
    ids, asked = np.array([r["c"] for r in probes]), np.array([r["v"] for r in probes])

    def nearest(frames):
        best = [[] for _ in ids]
        for frame in frames:
            for at in range(0, len(frame), 4096):
                part = frame.iloc[at:at + 4096]
                own, x = part["c"].to_numpy(), np.stack(part["v"])
                scores = asked @ x.T
                scores[ids[:, None] == own[None, :]] = -np.inf
                top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                used, where = np.unique(top, return_inverse=True)
                homes = forest.value.leaves(extended(x[used], False))[where.reshape(top.shape)]
                for i in range(len(ids)):
                    found = [(-scores[i, j], int(own[j]), homes[i, n].tolist()) for n, j in enumerate(top[i]) if scores[i, j] > -np.inf]
                    best[i] = sorted(best[i] + found)[:k]
        yield pd.DataFrame([(i, -s, c, h) for i, rows in enumerate(best) for s, c, h in rows], columns=["probe", "score", "c", "homes"])

    def places(table: pd.DataFrame) -> pd.DataFrame:
        i = int(table["probe"].iloc[0])
        table = table.sort_values(["score", "c"], ascending=[False, True])[:k]
        margins = forest.value.margins(extended(asked[i:i + 1], True))[0]
        order = {leaf: n for n, leaf in enumerate(forest.value.search(margins, margins.shape[0] << forest.value.depth), 1)}
        return pd.DataFrame({"place": [min(order[t, leaf] for t, leaf in enumerate(h)) for h in table["homes"]]})

    found = classes.select("c", "v").mapInPandas(nearest, "probe int, score double, c long, homes array<long>")
    found = sorted(r["place"] for r in found.groupBy("probe").applyInPandas(places, "place long").collect())  # k per probe
    return found[min(len(found), int(np.ceil(TARGET * len(found)))) - 1] if found else 1


def _valid(vector: Column) -> Column:
    """Not null, not zero, all components present and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, leaf: int = LEAF,
           seed: int = 17) -> DataFrame:
    """(query_id, rank, id_col, score): the k nearest found of every row where ``is_query`` holds, itself excluded.

    Ties go to the smaller id. Null ids and vectors that are null, zero, or hold null or non-finite components take no
    part, nor do vectors of another length than most (ties: the longer). Fewer than k candidates found give fewer
    rows. Ids are taken to be unique; of rows that repeat an id the vectors count as candidates of that id.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where(F.col("id").isNotNull()).where(_valid(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    if lengths is None:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    width = lengths["n"]
    rows = written(rows.where(F.size("v") == width), "rows")
    # k + 1 smallest ids of each distinct vector: first within slices of it, so that no hot vector meets in one task
    slice_ = Window.partitionBy("v", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    kept = rows.select("id", "v", F.row_number().over(slice_).alias("r")).where(f"r <= {k + 1}")
    kept = kept.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(f"r <= {k + 1}")
    classes = written(kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("c"), "v", "ids"), "classes")
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    total, most = classes.agg(F.count(F.lit(1)), F.max(norm(F.col("v")))).first()
    sample = np.array([r["v"] for r in classes.orderBy(F.xxhash64("c", F.lit(seed))).limit(SAMPLE).select("v").collect()])

    def extended(x: np.ndarray, query: bool) -> np.ndarray:
        x = x.astype(np.float64)
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, most**2 - (x**2).sum(axis=1)))
        return np.c_[x, more] / most

    forest = spark.sparkContext.broadcast(Forest(extended(sample, False), total, trees, leaf, seed))
    queries = written(rows.where("q").groupBy("v").agg(F.min("id").alias("q")), "queries")  # equal queries are searched once
    probes = queries.orderBy(F.xxhash64("q", F.lit(seed)), "q").limit(PROBES).select("v")
    probes = classes.join(F.broadcast(probes), "v").select("c", "v").orderBy("c").collect()
    least = int(np.ceil((k + 1) / max(1.0, total / (1 << forest.value.depth)))) + 1  # enough vectors for k neighbours
    n_leaves = max(trees, least, _leaves_wanted(probes, classes, forest, extended, k) if probes else 1)

    def route(frames):
        for frame in frames:
            for at in range(0, len(frame), 1024):
                part = frame.iloc[at:at + 1024]
                found = forest.value.leaves(extended(np.stack(part["v"]), False))
                for t in range(trees):
                    yield pd.DataFrame({"tree": t, "leaf": found[:, t], "c": part["c"].to_numpy(), "v": part["v"].to_numpy()})

    def walk(frames):
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at:at + 256]
                margins = forest.value.margins(extended(np.stack(part["v"]), True))
                found = [forest.value.search(m, n_leaves) for m in margins]
                reps = [len(f) for f in found]
                flat = [x for f in found for x in f]
                yield pd.DataFrame({"tree": [x[0] for x in flat], "leaf": [x[1] for x in flat], "turn": [n for r in reps for n in range(r)],
                                    "q": np.repeat(part["q"].to_numpy(), reps), "v": np.repeat(part["v"].to_numpy(), reps)})

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": [], "near": []})
        ids, x = left["c"].to_numpy(), np.stack(left["v"]).astype(np.float64)
        q, y = right["q"].to_numpy(), np.stack(right["v"]).astype(np.float64)
        least = right["least"].to_numpy() - 1e-9 * most * np.sqrt((y**2).sum(axis=1))  # products of other blocks may be rounded otherwise
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        out = []
        for at in range(0, len(q), 512):
            s = y[at:at + 512] @ x.T
            top = np.argsort(-s, axis=1, kind="stable")[:, :k + 1]
            out += [[{"c": int(ids[j]), "score": float(s[i, j])} for j in top[i] if s[i, j] >= least[at + i]] for i in range(len(s))]
        return pd.DataFrame({"q": q, "near": out})

    plain = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"  # as wide as the vectors came
    short = lambda df, c: df.select(c, F.col("v").cast(f"array<{plain}>").alias("v"))
    homes = short(classes, "c").mapInPandas(route, f"tree int, leaf long, c long, v array<{plain}>")
    visits = written(short(queries, "q").mapInPandas(walk, f"tree int, leaf long, turn int, q long, v array<{plain}>"), "visits")
    keys = ["tree", "leaf", "part"]

    def met(visits: DataFrame) -> DataFrame:
        """(q, c, score) of up to k + 1 vectors per visit, none below the visit's ``least``."""
        crowds = written(visits.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / PER_TASK).alias("parts")), "crowds")  # one row per leaf of the forest
        there = homes.join(crowds, ["tree", "leaf"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
        here = visits.join(crowds, ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("q"), F.col("parts"))).drop("parts")
        near = there.groupBy(*keys).cogroup(here.groupBy(*keys)).applyInPandas(rerank, "q long, near array<struct<c: long, score: double>>")
        return near.select("q", F.inline("near"))

    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    near = met(visits.where(f"turn < {trees}").withColumn("least", F.lit(float("-inf")))).groupBy("q", "c").agg(F.max("score").alias("score"))
    near = near.withColumn("r", F.row_number().over(nearest)).where(f"r <= {k + 1}").drop("r")
    if n_leaves > trees:
        near = written(near, "first")
        least = near.groupBy("q").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(f"n > {k}").select("q", "least")
        rest = visits.where(f"turn >= {trees}").join(least, "q", "left").fillna(float("-inf"), ["least"])
        near = near.unionByName(written(met(rest), "further")).groupBy("q", "c").agg(F.max("score").alias("score"))
        near = near.withColumn("r", F.row_number().over(nearest)).where(f"r <= {k + 1}")
    # exact scores in the order of the components, then the ids behind every class
    dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    pairs = near.select("q", "c").join(classes.select("c", F.col("v").alias("x"), "ids"), "c").join(queries.select("q", F.col("v").alias("y")), "q")
    found = written(pairs.select("q", "ids", dot.alias("score")).groupBy("q").agg(F.collect_list(F.struct("score", "ids")).alias("near")), "near")
    best = F.slice(F.array_sort(F.flatten(F.transform("near", lambda n: F.transform(n["ids"], lambda i: F.struct((-n["score"]).alias("s"), i.alias("id")))))), 1, k + 1)
    lists = found.select("q", best.alias("best")).join(queries, "q")
    asked = rows.where("q").select(F.col("id").alias("query_id"), "v")
    own = F.slice(F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, k)
    out = asked.join(lists.select("v", "best"), "v").select("query_id", F.posexplode(own).alias("pos", "b"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.id").alias(id_col), (-F.col("b.s")).alias("score"))
