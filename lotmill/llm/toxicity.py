"""Toxicity by non-negative positive-unlabelled learning.

A linear model on hashed words is trained with numpy from confirmed toxic texts (P) and unlabelled texts (U). With the
class prior ``pi`` the risk is ``pi * E_P[l(z)] + max(0, E_U[l(-z)] - pi * E_P[l(-z)])``; where the second term falls below
zero, the step raises it again, which keeps a flexible model from fitting the unlabelled toxic texts as clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.features import agreed, letter_words, sample_ids, sample_texts

BITS = 18
POSITIVES = 4_000  # bounds of the training sample
UNLABELLED = 8_000
SCREEN = 2_000  # buckets kept, those with the clearest difference between P and U
STEPS = 250


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> dict[str, np.ndarray]:
    """Screened buckets, their weights and the intercept. Without P or U the model is the prior alone."""
    prior = float(np.clip(prior, 1e-4, 0.999))
    intercept = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return {"buckets": np.zeros(0, np.int64), "weights": np.zeros(0), "intercept": np.array(intercept)}
    p = np.bincount(np.concatenate([*positive, np.zeros(0, np.int32)]), minlength=1 << BITS) / len(positive)
    u = np.bincount(np.concatenate([*unlabelled, np.zeros(0, np.int32)]), minlength=1 << BITS) / len(unlabelled)
    pooled = (p * len(positive) + u * len(unlabelled)) / (len(positive) + len(unlabelled))
    z = np.abs(p - u) / np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9) * (1 / len(positive) + 1 / len(unlabelled)))
    buckets = np.sort(np.argsort(-z, kind="stable")[:SCREEN])
    buckets = buckets[z[buckets] > 5]
    where = np.full(1 << BITS, -1)
    where[buckets] = np.arange(len(buckets))

    def matrix(rows):
        out = np.zeros((len(rows), len(buckets)), np.float32)
        for i, r in enumerate(rows):
            at = where[r]
            out[i, at[at >= 0]] = 1
        return out

    xp, xu = matrix(positive), matrix(unlabelled)
    theta, m, v = np.zeros(len(buckets) + 1), np.zeros(len(buckets) + 1), np.zeros(len(buckets) + 1)
    theta[-1] = intercept
    for t in range(1, STEPS + 1):
        zp, zu = xp @ theta[:-1] + theta[-1], xu @ theta[:-1] + theta[-1]
        gap = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = _sigmoid(zp), _sigmoid(zu)  # derivative of l(-z)
        dp, du = -prior * gp / len(gp), gu / len(gu)
        if gap < 0:
            dp, du = -dp, -du
        else:
            dp = dp + prior * (gp - 1) / len(gp)
        grad = np.r_[xp.T @ dp + xu.T @ du + 1e-4 * theta[:-1], dp.sum() + du.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return {"buckets": buckets, "weights": theta[:-1], "intercept": np.array(theta[-1])}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 5) -> dict[str, np.ndarray]:
    """A model from at most POSITIVES confirmed toxic texts and UNLABELLED others; labels of 0 only set the prior.

    Null labels and documents labelled both 0 and 1 are left out. An id that repeats counts once, with one of its texts.
    """
    known = agreed(labels, "toxic")
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    sides = {True: sample_ids(known.where("toxic = 1"), "doc_id", POSITIVES, seed), False: sample_ids(docs, id_col, UNLABELLED, seed + 1)}

    def words(batches):
        for batch in batches:
            found = list(letter_words(batch.column(0), BITS))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["words"])

    lists = {}
    for side, ids in sides.items():
        found = sample_texts(docs, ids, id_col, text_col).select("text").mapInArrow(words, "words array<int>").collect()
        lists[side] = [np.array(w, np.int32) for w in sorted(r["words"] for r in found)]
    return fit(lists[True], lists[False], toxic / n if n else 0.05)


def scores(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row, from the whole text; null and empty texts get the score of a text without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weight = np.zeros(1 << BITS)
        weight[shared.value["buckets"]] = shared.value["weights"]
        for batch in batches:
            z = np.array([weight[w].sum() for w in letter_words(batch.column(1), BITS)]) + shared.value["intercept"]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_sigmoid(z), pa.float64())], names=["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, score double")
    return found.select(F.col("id").alias(id_col), "score")
