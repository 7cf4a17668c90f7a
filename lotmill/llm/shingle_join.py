"""N-gram Jaccard join of whole texts: size-aware, with enumerated subsets for small sets and inverted lists for large ones.

Two documents are linked when ``100 * |A n B| >= percent * |A u B|`` for their sets of word shingles. Sets
of one content are collapsed first. Then, with a size boundary chosen by cost:

* **small sets** (both sizes up to the boundary): every subset of the size that a link of these two sizes
  needs is enumerated. Whoever shares one with a set of the smaller size is linked to it, so no pair is listed.
* **large sets** (at least one above it): the inverted lists of the rarest shingles are scanned. Sets order
  their shingles by (count level, hash); a linked pair shares one among the first ``n - ceil(percent * n / 100) + 1``
  of both. The count level comes from a table of fixed size counted over all documents; any order gives the
  same links, a good one gives short lists. Each list links its members to its first one; after these links
  are verified and joined to components, only members of *different* components are compared, with an exact
  lower bound on the symmetric difference (parity bitmaps), and what it leaves is verified on the full sets.

Nothing is capped: long lists are cut into blocks of bounded size that meet pairwise, and only where they hold
several components.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import components, dropped, small, without_ids, written
from lotmill.llm.words import shingle_sets, slices

BUCKETS = 1 << 20  # entries of the count table, whatever the input
PIECE = 1 << 14  # entries of it per row while it is added up
MAX_BOUNDARY = 20  # largest size considered for enumeration (C(20, 3) subsets)
BLOCK = 1024  # members or probes of a long list in one task at once
STAR_TURNS = 3  # rounds of stars around other leaders before long lists are compared block against block
SHORT_LIST = 64  # lists up to this length are compared by a plain join

_FEATURES = "id long, n long, low long, high long, prefix array<long>, small array<long>, bits binary"


def needed(a: int, b: int, percent: int) -> int:
    """Smallest overlap of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def _levels(docs: DataFrame, k: int) -> np.ndarray:
    """Logarithmic count level of every hash bucket, over all documents (1 MB, whatever the input)."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for s in shingle_sets(batch.column(0), k):
                np.add.at(total, (s & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        pieces = total.reshape(-1, PIECE)
        group = int(np.random.default_rng().integers(0, 1 << 30))
        if total.any():
            yield pa.RecordBatch.from_pydict({
                "piece": pa.array(range(len(pieces)), pa.int32()), "part": pa.array([group % 32] * len(pieces), pa.int32()),
                "counts": pa.array([p.tobytes() for p in pieces], pa.binary())})

    def add(table: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.int64) for x in table["counts"]], axis=0)
        return pd.DataFrame({"piece": table["piece"][:1].to_numpy(), "part": [0], "counts": [total.tobytes()]})

    schema = "piece int, part int, counts binary"
    rows = docs.select("text").mapInArrow(count, schema)
    rows = rows.groupBy("piece", "part").applyInPandas(add, schema).groupBy("piece").applyInPandas(add, schema)
    out = np.zeros((BUCKETS // PIECE, PIECE), np.uint8)
    for row in rows.collect():
        out[row["piece"]] = np.minimum(255, np.round(8 * np.log2(1.0 + np.frombuffer(row["counts"], np.int64))))
    return out.ravel()


def parity_bits(s: np.ndarray) -> bytes:
    """One bit per hash bucket: whether an odd number of members falls into it; 1 to 2 bits per member, 4 KB at most."""
    width = 256
    while width < len(s) and width < 1 << 15:
        width *= 2
    counts = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    return np.bitwise_xor.reduce(bits.reshape(-1, width), axis=0)


def parity_gap(one: bytes, other: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their parity bitmaps."""
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    width = min(len(a), len(b))
    return int(np.bitwise_count(_folded(a, width) ^ _folded(b, width)).sum())


def _parts(batches):
    """Ids and texts of batches (id, text) in runs of about two megabytes of text, so that results stay as small."""
    for batch in batches:
        at = 0
        for texts in slices(batch.column(1)):
            yield batch.column(0).slice(at, len(texts)), texts
            at += len(texts)


def _features(docs: DataFrame, k: int, percent: int, levels) -> DataFrame:
    """Size, content digest, prefix of rarest shingles, parity bitmap and, for small sizes, the whole set."""

    def rows(batches):
        level = levels.value
        for ids, texts in _parts(batches):
            out = []
            for s in shingle_sets(texts, k):
                n = len(s)
                first = n - (percent * n + 99) // 100 + 1 if n else 0
                order = np.lexsort((s, level[(s & np.uint64(BUCKETS - 1)).astype(np.int64)]))[:first]
                digest = xxhash.xxh3_128_intdigest(s.tobytes())
                out.append((n, (digest & (1 << 64) - 1) - (1 << 63), (digest >> 64) - (1 << 63), s[order].view(np.int64),
                            s.view(np.int64) if 0 < n <= MAX_BOUNDARY else None, parity_bits(s)))
            n, low, high, prefix, small, bits = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(n, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                pa.array(prefix, pa.list_(pa.int64())), pa.array(small, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                names=["id", "n", "low", "high", "prefix", "small", "bits"])

    return docs.mapInArrow(rows, _FEATURES)


def _subset_count(n: int, boundary: int, percent: int) -> int:
    return sum(comb(n, needed(n, b, percent)) for b in range(1, boundary + 1) if needed(n, b, percent) <= min(n, b))


def _boundary(sizes: DataFrame, lists: DataFrame, percent: int) -> int:
    """The size up to which enumerating subsets costs less than scanning the lists, from counts per size."""
    n_sets = {r["n"]: r["c"] for r in sizes.where(F.col("n").between(1, MAX_BOUNDARY)).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    scans = {r["n"]: r["c"] for r in lists.where(F.col("n") <= MAX_BOUNDARY).groupBy("n").agg(F.sum("m").alias("c")).collect()}
    cost = {x: sum(n_sets.get(n, 0) * _subset_count(n, x, percent) for n in range(1, x + 1)) + sum(c for n, c in scans.items() if n > x)
            for x in range(MAX_BOUNDARY + 1)}
    return min(cost, key=lambda x: (cost[x], x))


def _subset_links(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Links among sets of up to ``boundary`` members; each is a star around a set of the smaller size."""

    def subsets(frames):
        for frame in frames:
            out = []
            for i, n, members in frame.itertuples(index=False):
                hashes = np.asarray(members, np.int64).view(np.uint64)
                total = hashes.sum(dtype=np.uint64)
                for b in range(1, boundary + 1):
                    left = n - needed(n, b, percent)
                    if left < 0 or needed(n, b, percent) > b:
                        continue
                    drop = np.array(list(combinations(range(n), left)), np.int64).reshape(comb(n, left), left)
                    for key in (total - hashes[drop].sum(axis=1, dtype=np.uint64)).view(np.int64).tolist():
                        out.append((min(n, b), max(n, b), key, n, i))
            yield pd.DataFrame(out, columns=["a", "b", "key", "n", "id"])

    keys = sets.select("id", "n", "small").mapInPandas(subsets, "a long, b long, key long, n long, id long")
    first = keys.groupBy("a", "b", "key").agg(F.min(F.struct("n", "id")).alias("first"), F.count(F.lit(1)).alias("m"))
    first = first.where("m > 1 AND first.n = a").select("a", "b", "key", F.col("first.id").alias("lead"))
    return keys.join(first, ["a", "b", "key"]).where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()


def _near(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and parity bitmaps allow a link."""

    @F.pandas_udf("boolean")
    def close(x: pd.Series, y: pd.Series, most: pd.Series) -> pd.Series:
        return pd.Series([parity_gap(p, q) <= m for p, q, m in zip(x, y, most, strict=True)], dtype=bool)

    a = facts.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    b = facts.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    both = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    most = F.floor((F.col("na") + F.col("nb")) * (100 - percent) / (100 + percent) + 1e-9)
    return both.where(close("bits_a", "bits_b", most)).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs that are linked, as a written table, decided on the full sets, which are made anew for the documents in question."""

    def sets(batches):
        for ids, texts in _parts(batches):
            found = [s.view(np.int64) for s in shingle_sets(texts, k)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.list_(pa.int64()))], names=["id", "members"])

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = small(written(wanted, "verified_ids"))  # texts stay where they are while these are few
    full = written(docs.join(wanted, "id", "left_semi").select("id", "text").dropDuplicates(["id"]).mapInArrow(sets, "id long, members array<long>"), "sets")
    a = full.select(F.col("id").alias("a"), F.col("members").alias("sa"))
    b = full.select(F.col("id").alias("b"), F.col("members").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(a, "a").join(b, "b").withColumn("o", both)
    linked = written(joined.where((100 + percent) * F.col("o") >= percent * (F.size("sa") + F.size("sb"))).select("a", "b"), "linked")
    dropped(full, wanted)
    return linked


def _long_list_pairs(lists: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components inside long lists that sizes and bitmaps allow, block against block.

    A pair is given by the smallest of the long lists that it shares, and so once.
    """

    def compare(table: pd.DataFrame) -> pd.DataFrame:
        probes, members = table[table["probe"]], table[~table["probe"]]
        out = []
        if len(probes) and len(members):
            width = min(len(x) for x in table["bits"])
            packed = np.stack([_folded(np.frombuffer(x, np.uint8), width) for x in members["bits"]])
            ids, sizes, labels, keys = (members[c].to_numpy() for c in ("id", "n", "label", "keys"))
            here = table["key"].iloc[0]
            for i, n, label, bits, mine in zip(probes["id"], probes["n"], probes["label"], probes["bits"], probes["keys"], strict=True):
                ok = (labels != label) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n))
                if ok.any():
                    at = np.flatnonzero(ok)
                    gap = np.bitwise_count(packed[at] ^ _folded(np.frombuffer(bits, np.uint8), width)).sum(axis=1)
                    near = at[gap * (100 + percent) <= (sizes[at] + n) * (100 - percent)]
                    out += [(min(i, ids[j]), max(i, ids[j])) for j in near if np.intersect1d(mine, keys[j])[0] == here]
        return pd.DataFrame(out, columns=["a", "b"])

    salt = lambda blocks: F.pmod(F.xxhash64("id"), F.greatest(F.ceil(blocks / BLOCK), F.lit(1)))
    all_of = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(blocks / BLOCK), F.lit(1)) - 1))
    shared = lists.groupBy("id").agg(F.collect_list("key").alias("keys"))  # no more than the set's prefix
    rows = lists.join(facts.select("id", "bits"), "id").join(shared, "id")
    columns = ["key", "id", "n", "label", "bits", "keys"]
    members = rows.select(*columns, salt(F.col("m")).alias("block"), all_of(F.col("odd")).alias("turn"), F.lit(False).alias("probe"))
    probes = rows.where("label <> main").select(*columns, all_of(F.col("m")).alias("block"), salt(F.col("odd")).alias("turn"), F.lit(True).alias("probe"))
    return members.unionByName(probes).groupBy("key", "block", "turn").applyInPandas(compare, "a long, b long").distinct()


def _mixed(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the lists that hold several components: with ``label``, the list's smallest (``main``) and the number of others."""
    labelled = lists.join(labels.withColumnRenamed("component", "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("main"), F.max("label").alias("top"))
    labelled = labelled.join(mixed.where("main <> top").select("key", "main"), "key")
    odd = labelled.where("label <> main").groupBy("key").agg(F.count(F.lit(1)).alias("odd"))
    return written(labelled.join(odd, "key"), "mixed")


def linked_by_lists(lists: DataFrame, facts: DataFrame, docs: DataFrame, k: int, percent: int, more: DataFrame | None = None, boundary: int = 0) -> DataFrame:
    """Components (id, component) of all linked pairs that share a list of ``lists(key, id, n, m, lead)``.

    ``m`` is the length of the list and ``lead`` its smallest id; ``facts(id, n, bits)`` and ``docs(id, text)`` describe
    the members. ``more`` holds links (a, b) known beforehand; pairs of sets up to ``boundary`` are left to them.
    """
    pairs = lists.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    stars = written(_near(pairs, facts, percent), "stars")
    links = _verified(stars, docs, k, percent)
    dropped(stars)
    if more is not None:
        linked, links = links, written(links.unionByName(more), "links")
        dropped(linked)
    labels = components(links)

    labelled = _mixed(lists, labels)
    for turn in range(STAR_TURNS):  # other leaders, one per list, for long lists that still hold several components
        long = labelled.where(f"m > {SHORT_LIST}")
        if long.isEmpty():
            break
        other = long.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", "key", F.lit(turn)).alias("h"), "id", "label")).alias("o"))
        pairs = long.join(other, "key").where("label <> o.label").select(F.least("id", "o.id").alias("a"), F.greatest("id", "o.id").alias("b")).distinct()
        stars = written(_near(pairs, facts, percent), "stars")
        linked = _verified(stars, docs, k, percent)
        last, links = links, written(links.unionByName(linked), "links")
        dropped(stars, linked, last, labels, labelled)
        labels = components(links)
        labelled = _mixed(lists, labels)
    short = labelled.where(f"m <= {SHORT_LIST}").select("key", "id", "n", "label")
    other = short.select("key", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("label").alias("label_b"))
    close = 100 * F.least("n", "nb") >= percent * F.greatest("n", "nb")
    pairs = short.join(other, "key").where((F.col("id") < F.col("b")) & (F.col("label") != F.col("label_b")) & close)
    pairs = pairs.where(f"greatest(n, nb) > {boundary}").select(F.col("id").alias("a"), "b").distinct()
    rest = _near(pairs, facts, percent).unionByName(_long_list_pairs(labelled.where(f"m > {SHORT_LIST}"), facts, percent)).distinct()
    rest = written(rest, "rest")
    dropped(labelled)
    linked = _verified(rest, docs, k, percent)
    dropped(rest)
    if linked.isEmpty():
        dropped(links, linked)
        return labels
    found = components(links.unionByName(linked))
    dropped(labels, links, linked)
    return found


def jaccard_classes(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, n_shingles, component_id) per row of ``docs``; columns ``id_col``, ``n_shingles``, ``component_id``.

    Words are runs of other characters than blanks, A-Z lowered; a text of fewer than ``k`` words is one
    shingle; null and empty texts have none, are linked with nothing and are their own component. Rows
    with a null id are left out. Rows that repeat an id and text are one set; they come back once per row. An id
    with several texts may stand for any of them in a comparison. Further columns are ignored. Shingles are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL")
    levels = spark.sparkContext.broadcast(_levels(docs, k))
    facts = written(_features(docs, k, percent, levels), "facts")
    names = written(facts.select("id", "n", "low", "high"), "names")  # the wide rows go before the sets are compared
    reps = written(names.where("n > 0").groupBy("low", "high").agg(F.min("id").alias("rep"), F.min("n").alias("n")), "reps")
    copies = names.select("id", "low", "high").join(reps, ["low", "high"]).where("id <> rep").select("id")
    chosen = without_ids(facts.where("n > 0"), "id", copies)  # wide rows stay where they are while the copies are few

    # counts combine map-side; the join back is a plain one, so that adaptive execution splits a hot shingle
    entries = chosen.select("id", F.explode("prefix").alias("key"))
    heads = entries.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("lead")).where("m > 1")
    heads = small(written(heads, "heads"))
    lists = written(entries.join(heads, "key"), "lists")
    small_sets = reps.where(f"n <= {MAX_BOUNDARY}").select(F.col("rep").alias("id"))
    wanted = small(written(lists.select("id").union(small_sets).distinct(), "listed"))
    chosen = written(chosen.select("id", "n", "small", "bits").join(wanted, "id", "left_semi").dropDuplicates(["id"]), "chosen")
    dropped(facts, heads, wanted)
    lists, listed = written(lists.join(small(chosen.select("id", "n")), "id"), "sized"), lists
    dropped(listed)
    boundary = _boundary(reps, lists, percent)
    more = _subset_links(chosen.where(f"n <= {boundary}"), boundary, percent)
    found = linked_by_lists(lists, chosen.select("id", "n", "bits"), docs, k, percent, more, boundary)
    dropped(lists, chosen)
    named = reps.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("low", "high", F.coalesce("component", "rep").alias("component"))
    out = names.join(named, ["low", "high"], "left")
    out = written(out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")), "classes")
    dropped(names, reps, found)
    return out
