"""Ranked lexical search with hashed max-sketches.

A document's impact of a term is its weighted share in a score. The impacts fold into WIDTH coordinates, term by hash,
keeping the maximum of each. For an item the coordinates of its terms sum to an upper bound of the document's score,
looked up for a block of documents and a run of items at once. Documents are then scored exactly in the order of
falling bounds, until the next bound lies below the last of the item's best so far.

The text is read once: a written index keeps, per document, its number of terms and the counts of the terms that some
item of the batch holds; no other term can enter a score or a bound.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotmill.llm.common import written

WIDTH = 1024  # coordinates of a sketch
BLOCK = 1024  # documents whose sketches are held at once
BATCH_TERMS = 200_000  # terms of the items searched in one pass, about; one item at least
SLICE = 4 << 20  # bytes cut into terms at once
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # after lowering; bytes of 128 and more are those of the characters beyond ASCII
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """Terms of a text in runs of about SLICE bytes, a single term at least."""
    text = (text or b"").translate(_LOWER)
    at = 0
    while len(text) - at > SLICE:
        gap = _GAP.search(text, at + SLICE)
        end = gap.start() if gap else len(text)
        yield _TERM.findall(text, at, end)
        at = end
    yield _TERM.findall(text, at)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, terms): the distinct terms of each item; rows that share an id count as one item, items without terms go."""

    def run(batches):
        for batch in batches:
            found = [sorted({t for part in terms_of(x) for t in part}) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = rows.mapInArrow(run, f"item {kind}, terms array<binary>").select("item", F.explode("terms").alias("term")).distinct()
    return rows.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def build_index(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, n, terms, counts): number of terms, and places in ``vocabulary`` with their counts. One pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches):
        places = shared.value
        for batch in batches:
            sizes, ends, terms, counts = [], [0], [], []
            for text in batch.column(1).to_pylist():
                n, found = 0, Counter()
                for part in terms_of(text):
                    n += len(part)
                    found.update(part)
                here = [(places[t], c) for t, c in found.items() if t in places]
                terms += [p for p, _ in here]
                counts += [c for _, c in here]
                sizes.append(n)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["doc", "n", "terms", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc {kind}, n long, terms array<int>, counts array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, counts: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Share of each (term, document) in a score; ``sizes`` are the documents' numbers of terms."""
    if int(sizes.max(initial=0)) * n_docs * 50 < 1 << 62:
        m = 50 + (50 * sizes * n_docs) // n_terms
    else:
        m = np.array([50 + 50 * int(s) * n_docs // n_terms for s in sizes], np.int64)
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 20 * m))


class Searcher:
    """The best documents of each item among the documents seen so far."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, top: int, width: int):
        self.items, self.weights, self.n_docs, self.n_terms, self.top = items, weights, n_docs, n_terms, top
        self.width = width
        self.places = (np.arange(len(weights), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % width
        self.lookups = np.concatenate([self.places[t] for t in items]) if items else np.zeros(0, np.int64)
        self.begins = np.cumsum([0, *map(len, items)])
        self.best: list[list[tuple]] = [[] for _ in items]  # (score, id) from the best on
        self.floor = np.ones(len(items), np.int64)  # a bound below it cannot enter
        self.exact = 0  # scores computed

    def sketches(self, terms: np.ndarray, rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """Coordinatewise maxima, one column per document."""
        out = np.zeros((self.width, n), np.int64)
        np.maximum.at(out, (self.places[terms], rows), values)
        return out

    def add(self, ids: list, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> None:
        """One block of documents; terms, counts and rows (document of each) run in document order."""
        if len(terms) == 0:
            return
        values = impacts(self.weights[terms], counts, sizes[rows], self.n_docs, self.n_terms)
        sketch = self.sketches(terms, rows, values, len(ids))
        keys = rows * len(self.weights) + terms
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        run = max(1, (2 << 20) // len(ids))
        low = 0
        while low < len(self.items):
            high = max(low + 1, int(np.searchsorted(self.begins, self.begins[low] + run, "right")) - 1)
            found = sketch[self.lookups[self.begins[low]:self.begins[high]]]
            bounds = np.add.reduceat(found, self.begins[low:high] - self.begins[low], axis=0)
            for at in np.flatnonzero(bounds.max(axis=1) >= self.floor[low:high]):
                self._rescore(low + int(at), bounds[at], ids, keys, values)
            low = high

    def _rescore(self, item: int, bounds: np.ndarray, ids: list, keys: np.ndarray, values: np.ndarray) -> None:
        rows = np.flatnonzero(bounds >= self.floor[item])
        rows = rows[np.argsort(-bounds[rows], kind="stable")]
        terms, at, step = self.items[item], 0, self.top
        while at < len(rows) and bounds[rows[at]] >= self.floor[item]:
            some = rows[at:at + step]
            some = some[bounds[some] >= self.floor[item]]
            wanted = (some[:, None] * len(self.weights) + terms).ravel()
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            scores = np.where(keys[place] == wanted, values[place], 0).reshape(len(some), -1).sum(axis=1)
            self.exact += len(some)
            new = [(int(s), ids[r]) for s, r in zip(scores.tolist(), some.tolist()) if s >= self.floor[item]]
            if new:
                best = self.best[item] = sorted(self.best[item] + new, key=_order)[:self.top]
                if len(best) == self.top:
                    self.floor[item] = best[-1][0]
            at += step
            step *= 2


def _order(found: tuple) -> tuple:
    score, doc = found
    return (-score, doc is not None, doc if doc is not None else 0)


def _search(index: DataFrame, items: list[tuple], terms: dict[bytes, int], dfs: dict[int, int], n_docs: int, n_terms: int, top: int, width: int,
            item_kind: str, doc_kind: str) -> DataFrame:
    weights = np.array([weight(n_docs, dfs.get(i, 0)) for i in range(len(terms))], np.int64)
    shared = index.sparkSession.sparkContext.broadcast(([np.array([terms[t] for t in words], np.int64) for _, words in items], weights))

    def run(batches):
        searcher = Searcher(*shared.value, n_docs, n_terms, top, width)
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                lists = part.column(2)
                rows = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(lists.offsets)))
                searcher.add(part.column(0).to_pylist(), np.asarray(part.column(1)), np.asarray(lists.flatten()).astype(np.int64),
                             np.asarray(part.column(3).flatten()), rows)
        places, docs, scores = [], [], []
        for place, best in enumerate(searcher.best):
            places += [place] * len(best)
            docs += [d for _, d in best]
            scores += [s for s, _ in best]
        kind = index_schema
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(docs, kind), pa.array(scores, pa.int64())], names=["place", "doc", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    index_schema = to_arrow_type(index.schema["doc"].dataType)
    found = index.mapInArrow(run, f"place int, doc {doc_kind}, score long")
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc("doc"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = index.sparkSession.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], f"place int, item {item_kind}")
    return ranked.join(F.broadcast(names), "place").select("item", "rank", "doc", "score")  # a batch of items


def search(docs: DataFrame, items: DataFrame, top: int = 50, width: int = WIDTH, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
           batch_terms: int = BATCH_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0, equal scores by id (null first).

    Null and empty texts have no terms and are found by nothing; repeated documents are ranked one by one; items that share an
    id are one item with all their terms; items without terms have no row. Empty tables give no row. Only ids and texts are
    read, whatever the other columns are called. Items go in batches of about ``batch_terms`` terms, one pass each.
    """
    spark = docs.sparkSession
    item_kind, doc_kind = (df.schema[c].dataType.simpleString() for df, c in ((items, item_col), (docs, doc_col)))
    wanted = written(item_terms(items, item_col, text_col), "item_terms")
    total = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    parts = max(1, math.ceil(total / batch_terms))
    out = spark.createDataFrame([], f"item {item_kind}, rank int, doc {doc_kind}, score long")
    for part in range(parts if total else 0):
        batch = wanted.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).collect() if parts > 1 else wanted.collect()
        batch = [(r["item"], [bytes(t) for t in r["terms"]]) for r in batch]
        vocabulary = sorted({t for _, words in batch for t in words})
        index = written(build_index(docs, vocabulary, doc_col, text_col), "index")
        n_docs, n_terms = index.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_docs:
            break
        dfs = {r["term"]: r["count"] for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}  # of this batch's terms
        out = out.unionByName(_search(index, batch, {t: i for i, t in enumerate(vocabulary)}, dfs, n_docs, n_terms, top, width, item_kind, doc_kind))
    return out.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(doc_col), "score")


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d) GROUP BY 1, 2),
size AS (SELECT doc_id, len(ts) AS n FROM d),
whole AS (SELECT CAST(count(*) FILTER (n > 0) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM size),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), whole),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (SELECT q.item_id, tf.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nt)))) AS BIGINT) AS score
 FROM q JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (doc_id), whole GROUP BY 1, 2)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50"""
