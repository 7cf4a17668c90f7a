"""Hashed term features of whole texts, made from Arrow batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.words import bytes_of, mix, slices, word_hashes

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[:128] = 32
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[97:123] = np.arange(97, 123)
_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[48:58], _SHAPES[65:91], _SHAPES[97:123], _SHAPES[128:] = ord("9"), ord("A"), ord("a"), ord("a")
_SHAPES[[9, 11, 12, 13]] = 32


def letter_words(texts: pa.Array, bits: int) -> Iterator[np.ndarray]:
    """For every text the sorted distinct buckets (2 ** bits) of its words of letters, A-Z lowered."""
    for part in slices(texts):
        data, offsets = bytes_of(part)
        hashes, rows = word_hashes(_LETTERS[data], offsets)
        cuts = np.searchsorted(rows, np.arange(len(offsets)))
        buckets = (hashes >> np.uint64(64 - bits)).astype(np.int32)
        for i in range(len(offsets) - 1):
            yield np.unique(buckets[cuts[i]:cuts[i + 1]])


def shape_terms(texts: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every text buckets and weights of its shape terms.

    Terms are the shapes of words (runs of capitals, letters, digits or one mark, each written once), pairs of
    neighbouring shapes, words that repeat the one before, and levels of variety, words per line and length.
    Weights are shares of the words, on a square-root scale.
    """
    size = 1 << bits
    for part in slices(texts):
        data, offsets = bytes_of(part)
        words, word_rows = word_hashes(data, offsets)
        shape = _SHAPES[data]
        keep = np.ones(len(shape), bool)
        keep[1:] = shape[1:] != shape[:-1]
        keep[offsets[:-1][offsets[:-1] < len(shape)]] = True
        moved = np.r_[0, np.cumsum(keep)]
        shapes, rows = word_hashes(shape[keep], moved[offsets])
        lines = np.r_[0, np.cumsum(data == 10)]
        cuts, word_cuts = np.searchsorted(rows, np.arange(len(offsets))), np.searchsorted(word_rows, np.arange(len(offsets)))
        for i in range(len(offsets) - 1):
            s, w = shapes[cuts[i]:cuts[i + 1]], words[word_cuts[i]:word_cuts[i + 1]]
            n = len(w)
            if not n:
                yield np.zeros(0, np.int32), np.zeros(0, np.float32)
                continue
            pairs = mix(s[:-1] * np.uint64(3) + s[1:])
            level = [np.uint64(round(8 * len(np.unique(w)) / n)), np.uint64(100 + min(40, round(2 * np.log2(n)))),
                     np.uint64(200 + min(40, round(2 * np.log2(n / (lines[offsets[i + 1]] - lines[offsets[i]] + 1) + 1))))]
            same = int((w[1:] == w[:-1]).sum())
            terms = np.r_[s, pairs, mix(np.array(level, np.uint64)), mix(np.array([300], np.uint64))]
            weights = np.r_[np.full(len(s) + len(pairs), 1 / n), [0.1] * 3, [same / n]]
            at, back = np.unique((terms >> np.uint64(64 - bits)).astype(np.int64) % size, return_inverse=True)
            yield at.astype(np.int32), np.sqrt(np.bincount(back, weights)).astype(np.float32)


def sample_ids(rows: DataFrame, id_col: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` distinct ids, the first ones by a seeded hash (a bounded, repeatable sample); column ``_id``."""
    ids = rows.select(F.col(id_col).alias("_id")).where("_id IS NOT NULL").distinct()
    return ids.orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(most)


def sample_texts(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns of ``ids`` (``_id`` and others, bounded by ``sample_ids``) with one ``text`` per id.

    Of several texts of an id the one of the smallest hash is taken, chosen map-side first, so that an id that
    repeats without end still gives one row. Columns of ``docs`` other than id and text are not looked at.
    """
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(ids.select("_id")), F.col("doc") == F.col("_id")).groupBy("_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return found.select("_id", F.col("t.text").alias("text")).join(F.broadcast(ids), "_id")


def agreed(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) once per document; null ids and labels, and documents with conflicting labels, are left out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias(label), F.max(label).alias("_most"))
    return known.where(F.col(label) == F.col("_most")).drop("_most")
