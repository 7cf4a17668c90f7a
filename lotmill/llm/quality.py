"""Quality classifier: nearest-neighbour voting in a latent-semantic space of shape terms.

A bounded sample of labelled texts gives a term matrix; its leading singular directions (latent-semantic
analysis) make a short vector of every text. The labelled vectors are broadcast, every document is compared with
all of them by exact cosine products, block against block, and its nearest ones vote, weighted by similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.features import agreed, sample_ids, sample_texts, shape_terms

BITS = 11
SAMPLE = 8_000  # labelled texts learned, half of them per label where there are enough
DIMENSIONS = 32
NEIGHBOURS = 15
POWER = 8  # a neighbour's weight is its similarity to this power
BLOCK = 1_024


def _matrix(rows) -> np.ndarray:
    out = np.zeros((len(rows), 1 << BITS), np.float32)
    for i, (at, weight) in enumerate(rows):
        out[i, at] = weight
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float) -> dict:
    """Projection and labelled vectors."""
    x = _matrix(rows)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    values, vectors = np.linalg.eigh((x * idf).T @ (x * idf))
    projection = (idf[:, None] * vectors[:, np.argsort(-values)[:DIMENSIONS]]).astype(np.float32)
    return {"projection": projection, "vectors": _unit(x @ projection), "labels": labels.astype(np.float32), "prior": prior}


def vote(model: dict, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by similarity and corrected for the sample's
    balance; the prior where there is no neighbour (no words, or nothing learned)."""
    out = np.full(len(rows), model["prior"])
    if not len(model["vectors"]):
        return out
    share = float(model["labels"].mean())
    up = model["prior"] / share if 0 < share < 1 else 1.0
    down = (1 - model["prior"]) / (1 - share) if 0 < share < 1 else 1.0
    k = min(NEIGHBOURS, len(model["vectors"]))
    for at in range(0, len(rows), BLOCK):
        q = _unit(_matrix(rows[at:at + BLOCK]) @ model["projection"])
        cosine = q @ model["vectors"].T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** POWER
        label = model["labels"][near]
        yes, no = up * (weight * label).sum(axis=1), down * (weight * (1 - label)).sum(axis=1)
        out[at:at + BLOCK] = np.where(yes + no > 0, yes / np.maximum(yes + no, 1e-12), model["prior"])
    return np.clip(out, 0.0, 1.0)


def _terms(batches):
    for batch in batches:
        found = list(shape_terms(batch.column(1), BITS))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                                          pa.array([f[1] for f in found], pa.list_(pa.float32()))], names=["label", "terms", "weights"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 3) -> dict:
    """A model from at most SAMPLE labelled texts, in the order of a seeded hash of the id.

    Null labels and documents labelled both 0 and 1 are left out. An id that repeats counts once, with one of its texts.
    """
    known = agreed(labels, "quality")
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("quality"), F.lit(0))).first()
    ids = [sample_ids(known.where(f"quality = {c}"), "doc_id", SAMPLE // 2, seed).select("_id", F.lit(c).alias("_label")) for c in (0, 1)]
    rows = sample_texts(docs, ids[0].unionByName(ids[1]), id_col, text_col).select(F.col("_label").alias("label"), "text")
    rows = rows.mapInArrow(_terms, "label int, terms array<int>, weights array<float>").collect()
    rows.sort(key=lambda r: (r["label"], r["terms"], r["weights"]))  # a model does not depend on the order of partitions
    prior = (good + 1) / (n + 2)
    if not rows:
        return {"projection": np.zeros((1 << BITS, 1), np.float32), "vectors": np.zeros((0, 1), np.float32), "labels": np.zeros(0), "prior": prior}
    return fit([(np.array(r["terms"], np.int64), np.array(r["weights"], np.float32)) for r in rows], np.array([r["label"] for r in rows]), prior)


def scores(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row, from the whole text; null and empty texts get the prior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            rows, ids, done = [], batch.column(0), 0
            for found in shape_terms(batch.column(1), BITS):
                rows.append(found)
                if len(rows) == BLOCK or done + len(rows) == len(ids):
                    yield pa.RecordBatch.from_arrays([ids.slice(done, len(rows)), pa.array(vote(shared.value, rows), pa.float64())], names=["id", "score"])
                    done += len(rows)
                    rows = []

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, score double")
    return found.select(F.col("id").alias(id_col), "score")
