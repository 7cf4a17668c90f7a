"""Substring deduplication by paragraph MinHash banding.

Paragraphs are lines of ``min_words`` words or more and, if ``span`` is given, stretches of fixed length around anchor
words: the words whose shingle hash is the smallest of some run of words. Anchors depend on the words around them only, so
any ``span`` words that two texts share, wherever they lie in their lines, hold a whole stretch that both texts cut alike.
Stretches only find passages: their hits are joined and extended over all equal words around them.

Paragraphs get MinHash values of their word shingles. For lines, bands are tuned for recall: the fewest bands of ``ROWS``
values that find a pair at the similarity threshold with probability RECALL. A stretch has one band: equal ones collide
for certain, and of its 17 shingles a changed word takes up to five, so that stretches with one are hardly ever similar and further
bands find nothing more. Passages that differ in some words are found by their words between the changes. At similarity 0.8 no more than one of
nine of the N shingles is lost, in blocks of five, so some 40 N / (N + 45) + 4 words in a row are equal: with SPAN = 30
near copies of 88 words or more are found for certain, and shorter ones where the changes leave 30 words in a row.
Equal paragraphs are collapsed first; paragraphs that collide in a band are verified by exact Jaccard similarity and
joined to components. Of every component the first occurrence stays and all others are to be removed.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotmill.llm.common import dropped, small, written
from lotmill.llm.shingle_join import linked_by_lists, parity_bits
from lotmill.llm.words import bytes_of, mix, shingle_hashes, shingle_sets, slices, word_hashes, word_spans

MIN_WORDS = 20
REACH = 10  # words of a stretch on each side of its anchor
SPAN = 30  # words shared in a row that are found for certain
ROWS = 3
RECALL = 0.999

_PARAGRAPHS = "doc long, para int, start int, length int, words int, low long, high long, bands array<long>"
_SIDE = pa.schema([("doc", pa.int64()), ("tid", pa.int64()), ("word", pa.int32()), ("right", pa.bool_()), ("held", pa.binary()), ("chars", pa.list_(pa.int32()))])
_NO_STRETCH = {"tid": "long", "word": "int", "size": "int", "gap": "long"}  # columns that lines have no value in


def bands_for(similarity: float, rows: int = ROWS, recall: float = RECALL) -> int:
    """Fewest bands that give the recall for pairs at the threshold."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))) if similarity < 1 else 1


def band_keys(hashes: np.ndarray, cuts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys of consecutive shingle runs; run i covers ``cuts[i]`` up to ``cuts[i + 1]``, none is empty."""
    rng = np.random.default_rng(71)
    keys = np.zeros((len(cuts) - 1, bands), np.uint64)
    for b in range(bands):
        for _ in range(rows):
            a, c = rng.integers(1, 1 << 62, 2, dtype=np.uint64)
            values = np.minimum.reduceat((hashes ^ c) * (a * np.uint64(2) + np.uint64(1)), cuts[:-1])
            keys[:, b] = mix(keys[:, b] * np.uint64(3) + values)
        keys[:, b] = mix(keys[:, b] + np.uint64(b))
    return keys


def _paragraphs(docs: DataFrame, k: int, bands: int, min_words: int) -> DataFrame:
    """Place, size, content digest and band keys of every paragraph of enough words; start and length in characters."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch.column(1)):
                at = 0 if part.offset == batch.column(1).offset else part.offset - batch.column(1).offset
                ids = batch.column(0).slice(at, len(part))
                data, offsets = bytes_of(part)
                ends = np.union1d(np.flatnonzero(data == 10), offsets[1:])
                starts = np.r_[0, ends[:-1] + (data[np.minimum(ends[:-1], max(0, len(data) - 1))] == 10)].astype(np.int64) if len(data) else np.zeros(0, np.int64)
                bounds = np.r_[0, ends].astype(np.int64)
                hashes, at_line = word_hashes(data, bounds)
                count = np.bincount(at_line, minlength=len(ends))
                good = np.flatnonzero(count >= min_words)
                if not len(good):
                    continue
                chosen = count[at_line] >= min_words
                grams, owner = shingle_hashes(hashes[chosen], at_line[chosen], k)
                cuts = np.r_[np.searchsorted(owner, good), len(owner)]
                keys = band_keys(grams, cuts, bands, ROWS)
                word_cuts = np.searchsorted(at_line, np.r_[good, len(ends)])
                row = np.searchsorted(offsets, starts[good], "right") - 1
                chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]  # characters before each byte
                out = []
                first_of = np.searchsorted(starts, offsets[row])
                for i, g in enumerate(good):
                    digest = xxhash.xxh3_128_intdigest(hashes[word_cuts[i]:word_cuts[i] + count[g]].tobytes())
                    out.append(((digest & (1 << 64) - 1) - (1 << 63), (digest >> 64) - (1 << 63)))
                start = chars[starts[good]] - chars[offsets[row]]
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(row)), pa.array(good - first_of, pa.int32()), pa.array(start, pa.int32()),
                    pa.array(chars[ends[good]] - chars[starts[good]], pa.int32()), pa.array(count[good], pa.int32()),
                    pa.array([d[0] for d in out], pa.int64()), pa.array([d[1] for d in out], pa.int64()),
                    pa.array(list(keys.view(np.int64)), pa.list_(pa.int64()))],
                    names=["doc", "para", "start", "length", "words", "low", "high", "bands"])

    return docs.mapInArrow(rows, _PARAGRAPHS)


def _extremes(values: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) of every ``width`` values in a row, by doubling; the last ``width - 1`` places are not filled."""
    out, done = values.copy(), 1
    while done < width:
        step = min(done, width - done)
        out[:-step] = of(out[:-step], out[step:])
        done += step
    return out


def anchors(grams: np.ndarray, rows: np.ndarray, reach: int, span: int) -> np.ndarray:
    """Places whose gram is the smallest of some ``span - 2 * reach`` places, all at least ``reach`` words inside their row."""
    n, width = len(grams), span - 2 * reach
    if n < span:
        return np.zeros(0, np.int64)
    lowest = _extremes(grams, width, np.minimum)
    at = np.arange(n)
    first, last = at - reach, np.minimum(at + width + reach - 1, n - 1)
    inside = (first >= 0) & (at + width + reach <= n) & (rows[np.maximum(first, 0)] == rows[last])
    lowest[~inside] = 0
    padded = np.r_[np.zeros(width - 1, np.uint64), lowest]
    chosen = (_extremes(padded, width, np.maximum)[:n] == grams) & (grams > 0)
    chosen[1:] &= ~(chosen[:-1] & (grams[1:] == grams[:-1]))  # of a run of equal grams only the first
    return np.flatnonzero(chosen)


def _gaps(hashes: np.ndarray, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words between each stretch and the one before it in its row, and their hash; -1 where there is none or they overlap."""
    size, low = np.full(len(at), -1, np.int64), np.zeros(len(at), np.uint64)
    near = np.flatnonzero((row[at[1:]] == row[at[:-1]]) & (at[1:] - at[:-1] > 2 * REACH)) + 1
    size[near] = at[near] - at[near - 1] - 2 * REACH - 1
    for i in range(int(size.max(initial=0))):
        here = np.flatnonzero(size > i)
        low[here] = mix(low[here] * np.uint64(3) + hashes[at[here] - REACH - 1 - i])
    return size, low


def _stretches(docs: DataFrame, k: int, span: int) -> DataFrame:
    """Place, size, content hash and band key (which follows from the content, too) of the stretch around every anchor; texts of fewer than ``span`` words have none."""

    def rows(batches):
        for batch in batches:
            done = 0
            for part in slices(batch.column(1)):
                ids = batch.column(0).slice(done, len(part))
                done += len(part)
                data, offsets = bytes_of(part)
                hashes, row = word_hashes(data, offsets)
                n = len(hashes)
                grams = mix(hashes)
                for i in range(1, min(k, n)):  # as in shingle_hashes, but without an end at the row
                    grams[:n - i] = mix(grams[:n - i] * np.uint64(3) + hashes[i:])
                at = anchors(grams, row, REACH, span)
                if not len(at):
                    continue
                low = np.zeros(len(at), np.uint64)
                for i in range(-REACH, REACH + 1):
                    low = mix(low * np.uint64(3) + hashes[at + i])
                per = 2 * REACH + 2 - k
                held = grams[(at - REACH)[:, None] + np.arange(per)].ravel()
                key = band_keys(held, np.arange(0, len(held) + 1, per), 1, ROWS)[:, 0]
                starts, stops = word_spans(data, offsets)
                chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                begin, home = chars[starts[at - REACH]], chars[offsets[row[at]]]
                word = at - REACH - np.searchsorted(row, row[at])
                size, gap = _gaps(hashes, row, at)
                gap ^= size.view(np.uint64)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(row[at])), pa.array(begin - home, pa.int32()), pa.array(chars[stops[at + REACH]] - begin, pa.int32()),
                    pa.array(low.view(np.int64)), pa.array(key.view(np.int64)), batch.column(2).slice(done - len(part), len(part)).take(pa.array(row[at])),
                    pa.array(word, pa.int32()), pa.array(size, pa.int32()), pa.array(gap.view(np.int64))],
                    names=["doc", "start", "length", "low", "key", "tid", "word", "size", "gap"])

    return docs.mapInArrow(rows, "doc long, start int, length int, low long, key long, tid long, word int, size int, gap long")


def _repeated_stretches(docs: DataFrame, k: int, span: int) -> tuple[DataFrame, list[DataFrame]]:
    """Stretches whose band key occurs at two places apart, in the columns of ``_paragraphs``, and the written tables they are read from."""
    all_ = _stretches(docs, k, span)  # most occur once; they are cut twice and never written
    keys = written(all_.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key"), "keys")  # narrow rows first
    again = written(all_.join(small(keys), "key", "left_semi"), "again")
    dropped(keys)
    places = again.groupBy("key").agg(F.min("doc").alias("d0"), F.max("doc").alias("d1"), F.min(F.col("start") + F.col("length")).alias("end"), F.max("start").alias("last"))
    once = places.where("d0 = d1 AND end > last").select("key")
    once = written(once, "once")
    found = again.join(small(once), "key", "left_anti")
    found = found.select("doc", F.lit(-1).alias("para"), "start", "length", F.lit(2 * REACH + 1).alias("words"), "low", F.col("key").alias("high"), F.array("key").alias("bands"),
                         "tid", "word", "size", "gap")
    return found, [again, once]


def _sides(docs: DataFrame, ends: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` word hashes from each of ``ends(doc, tid, word, right)`` outwards, nearest first, and the character
    where the text up to that word begins or ends; entry 0 of ``chars`` belongs to no extension."""

    def rows(batches):
        for batch in batches:
            done = 0
            for part in slices(batch.column(2)):
                data, offsets = bytes_of(part)
                hashes, row = word_hashes(data, offsets)
                starts, stops = word_spans(data, offsets)
                chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                cuts = np.searchsorted(row, np.arange(len(part) + 1))
                out = []
                for i in range(len(part)):
                    doc, tid, wanted = (batch.column(c)[done + i].as_py() for c in (0, 1, 3))
                    home, first, last = chars[offsets[i]], cuts[i], cuts[i + 1]
                    for end in wanted:
                        w, right = first + end["word"], end["right"]
                        if right:  # w is the first word after the stretch
                            held, places = hashes[w:min(w + most, last)], chars[stops[w - 1:min(w + most, last)]]
                        else:  # w is the first word of the stretch
                            low = max(first, w - most)
                            held, places = hashes[low:w][::-1], chars[starts[low:w + 1]][::-1]
                        out.append((doc, tid, end["word"], right, held.tobytes(), (places - home).tolist()))
                done += len(part)
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(_SIDE.names, o, strict=True)) for o in out], schema=_SIDE)

    ends = written(ends.groupBy("doc", "tid").agg(F.collect_set(F.struct("word", "right")).alias("wanted")), "ends")  # no more than two per word
    texts = docs.join(small(ends.select("doc", "tid")), ["doc", "tid"], "left_semi").select("doc", "tid", "text").dropDuplicates(["doc", "tid"])
    joined = texts.join(ends, ["doc", "tid"]).select("doc", "tid", "text", "wanted")
    sides = written(joined.mapInArrow(rows, "doc long, tid long, word int, right boolean, held binary, chars array<int>"), "sides")
    dropped(ends)
    return sides


def _equal_words(one: pd.Series, other: pd.Series) -> pd.Series:
    """How many 64-bit hashes two strings of them have in common from their begin."""
    out = []
    for x, y in zip(one, other, strict=True):
        n = min(len(x), len(y)) // 8
        differ = np.flatnonzero(np.frombuffer(x, np.uint64, n) != np.frombuffer(y, np.uint64, n))
        out.append(int(differ[0]) if len(differ) else n)
    return pd.Series(out, dtype="int32")


def _whole(docs: DataFrame, hits: DataFrame, span: int) -> DataFrame:
    """Whole passages of ``hits``: stretches and, as ``lead``, their first occurrences.

    Neighbouring hits of a document and a first occurrence at one distance are joined where the words between them are
    equal in both; the ends are extended over equal words. More than ``span`` equal words would hold a further stretch.
    """
    equal_words = F.pandas_udf(_equal_words, "int")
    pair = ["doc", "tid", "l_doc", "l_tid", "shift"]
    hits = hits.select("doc", "tid", "word", "words", "size", "gap", F.col("lead.doc").alias("l_doc"), F.col("lead.tid").alias("l_tid"), (F.col("word") - F.col("lead.word")).alias("shift"),
                       ((F.col("gap") == F.col("lead.gap")) & (F.col("size") == F.col("lead.size"))).alias("same_gap")).distinct()
    order = Window.partitionBy(*pair).orderBy("word")  # no more than one document has
    before = F.lag(F.col("word") + F.col("words")).over(order)
    joined = F.coalesce((before >= F.col("word")) | (F.col("same_gap") & (before + F.col("size") == F.col("word"))), F.lit(False))
    runs = hits.withColumn("run", (~joined).cast("int")).withColumn("run", F.sum("run").over(order))
    runs = runs.groupBy(*pair, "run").agg(F.min("word").alias("w0"), F.max(F.col("word") + F.col("words")).alias("w1"))
    runs = stored = written(runs.withColumn("l0", F.col("w0") - F.col("shift")).withColumn("l1", F.col("w1") - F.col("shift")), "runs")
    ends = None
    for doc, tid, word, right in [("doc", "tid", "w0", False), ("doc", "tid", "w1", True), ("l_doc", "l_tid", "l0", False), ("l_doc", "l_tid", "l1", True)]:
        some = runs.select(F.col(doc).alias("doc"), F.col(tid).alias("tid"), F.col(word).alias("word"), F.lit(right).alias("right"))
        ends = some if ends is None else ends.unionByName(some)
    sides = _sides(docs, ends.distinct(), span)
    # inside one document the copy must not run into its first occurrence
    room = F.when((F.col("doc") == F.col("l_doc")) & (F.col("tid") == F.col("l_tid")), F.greatest(F.lit(0), F.col("shift") - (F.col("w1") - F.col("w0")))).otherwise(2 * span)
    runs = runs.withColumn("room", room.cast("int"))
    at = lambda side, n: F.element_at(f"{side}.chars", F.col(n) + 1)
    # the words of an end are wide rows: one end is done and written before those of the other one are moved
    for right, word, l_word, added, place, l_place in [(True, "w1", "l1", "more", "end", "l_end"), (False, "w0", "l0", "less", "start", "l_start")]:
        side = sides.where(F.col("right") == right)
        ours = side.select("doc", "tid", F.col("word").alias(word), F.struct("held", "chars").alias("ours"))
        theirs = side.select(F.col("doc").alias("l_doc"), F.col("tid").alias("l_tid"), F.col("word").alias(l_word), F.struct("held", "chars").alias("theirs"))
        both = runs.join(ours, ["doc", "tid", word]).join(theirs, ["l_doc", "l_tid", l_word])
        both = both.withColumn(added, F.least(equal_words("ours.held", "theirs.held"), "room")).withColumn("room", F.col("room") - F.col(added))
        runs = written(both.select("*", at("ours", added).alias(place), at("theirs", added).alias(l_place)).drop("ours", "theirs"), "extended")
        dropped(stored)
        stored = runs
    dropped(sides)
    found = runs.select("doc", "l_doc", "l_tid", "start", "end", (F.col("w1") - F.col("w0") + F.col("less") + F.col("more")).alias("words"), "l_start", "l_end")
    # stretches at the ends may be cut alike in some of the copies only; the first occurrence of all names the place
    best = found.groupBy("doc", "start", "end").agg(F.min(F.struct("l_doc", "l_start", "l_end", "l_tid", "words")).alias("b"))
    places = written(best.select("doc", "start", "end", "b.*"), "places")
    dropped(stored)
    return places


def _once(paras: DataFrame, docs: DataFrame) -> DataFrame:
    """``paras`` without repeated rows, which only documents have that come in several rows; the others are not moved."""
    several = written(docs.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), "several")
    paras = paras.select("doc", "start", "length", "words", "low", "high", *_NO_STRETCH)
    if several.isEmpty():
        return paras
    several = small(several)
    return paras.join(several, "doc", "left_anti").unionByName(paras.join(several, "doc", "left_semi").distinct())


def repeated_passages(docs: DataFrame, k: int = 5, similarity: float = 0.8, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                      span: int | None = None) -> DataFrame:
    """Every paragraph that repeats: one row (id, start, length, n_words, class_doc, class_start, n_in_class, removed).

    ``start`` and ``length`` count characters; the class is named by its first occurrence (smallest id, then start),
    which alone has ``removed`` false. Members that overlap inside a document are one occurrence, and ``n_in_class``
    counts occurrences. Repeats inside one document count. Null ids, null or empty texts and paragraphs
    of fewer than ``min_words`` words take no part; further columns are ignored; rows that repeat an id and text
    give their paragraphs once. Words are runs of other characters than blanks, A-Z lowered.

    With ``span`` (30 or more), passages across and inside lines are reported, too: any ``span`` words that repeat word
    for word hold at least one stretch of 21 words, and its hits are joined and extended over all equal words around them. Such a
    passage is what a place shares with the first occurrence; its class are the places that share one from the same
    first word on, and its first occurrence is given as long as the longest of them. Passages and lines may overlap. Words beyond it
    that later places share with each other only are reported where they hold a stretch of their own.
    """
    if span is not None and span < 3 * REACH:
        raise ValueError(f"span has to be at least {3 * REACH}")
    percent = round(100 * similarity)
    bands = bands_for(similarity)
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    docs = docs.withColumn("tid", F.xxhash64("text"))
    paras = _paragraphs(docs, k, bands, min_words).select("*", *[F.lit(None).cast(t).alias(c) for c, t in _NO_STRETCH.items()])
    again, tables = (None, []) if span is None else _repeated_stretches(docs, k, span)
    paras = written(paras if span is None else paras.unionByName(again), "paragraphs")
    dropped(*tables)
    first = F.min(F.struct("doc", "start", "length")).alias("first")
    reps = paras.groupBy("low", "high").agg(first, F.count(F.lit(1)).alias("rows"), F.min(F.struct("doc", "start", "bands")).alias("b"))
    reps = written(reps.select(F.monotonically_increasing_id().alias("id"), "low", "high", "first", "rows", F.col("b.bands").alias("bands")), "reps")
    entries = reps.select("id", F.explode("bands").alias("key"))
    heads = entries.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("lead")).where("m > 1")
    lists = written(entries.join(heads, "key"), "lists")

    wanted = reps.join(lists.select("id").distinct(), "id", "left_semi").select("id", F.col("first.doc").alias("doc"), F.col("first.start").alias("start"), F.col("first.length").alias("length"))
    wanted = written(wanted.groupBy("doc").agg(F.collect_list(F.struct("id", "start", "length")).alias("parts")), "wanted")
    near_docs = docs.drop("tid").join(small(wanted.select("doc")), "doc", "left_semi")  # other texts are not moved
    texts = near_docs.join(wanted, "doc").select(F.explode("parts").alias("p"), "text")
    texts = texts.select("p.id", F.substring("text", F.col("p.start") + 1, F.col("p.length")).alias("text")).dropDuplicates(["id"])
    texts = written(texts, "texts")
    dropped(wanted)

    def describe(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), k))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([parity_bits(s) for s in sets], pa.binary())], names=["id", "n", "bits"])

    facts = written(texts.mapInArrow(describe, "id long, n long, bits binary"), "facts")
    lists, listed = written(lists.join(facts.select("id", "n"), "id").select("key", "id", "n", "m", "lead"), "sized"), lists
    dropped(listed)
    found = linked_by_lists(lists, facts, texts, k, percent)
    dropped(lists, facts, texts)

    named = written(reps.join(found, "id", "left").select("low", "high", "rows", F.coalesce("component", "id").alias("class")), "named")
    dropped(reps, found)
    multiple = named.groupBy("class").agg(F.sum("rows").alias("rows")).where("rows > 1").select("class")  # a class of one row repeats nothing
    placed = _once(paras, docs).join(named.drop("rows").join(multiple, "class"), ["low", "high"])
    placed = stored = written(placed, "placed")
    dropped(paras, named)
    order = Window.partitionBy("class", "doc").orderBy("start", "length")  # no more than one document has
    before = F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("apart", (before.isNull() | (F.col("start") >= before)).cast("long"))
    placed = placed.withColumn("turn", F.sum("apart").over(order))
    lead = F.min(F.struct("doc", "start", "length", *_NO_STRETCH)).alias("lead")
    groups = placed.groupBy("class").agg(lead, F.sum("apart").alias("n_in_class")).where("n_in_class > 1")
    out = placed.join(groups, "class")
    removed = (F.col("doc") != F.col("lead.doc")) | (F.col("turn") > 1)
    final = [F.col("doc").alias(id_col), "start", "length", F.col("words").alias("n_words"), "class_doc", "class_start", "n_in_class", "removed"]
    out = out.withColumn("removed", removed).withColumn("class_doc", F.col("lead.doc")).withColumn("class_start", F.col("lead.start"))
    if span is None:
        return out.select(*final)
    out = written(out, "out")
    dropped(stored)
    as_is = out.where("lead.word IS NULL OR word IS NULL").select(*final)  # classes of lines, and what they share with stretches
    lined = out.where("lead.word IS NULL OR word IS NULL").select("class").distinct()
    kept = out.where("word IS NOT NULL AND lead.word IS NOT NULL AND NOT removed").join(lined, "class", "left_semi").select(*final)
    whole = _whole(docs, out.where("word IS NOT NULL AND lead.word IS NOT NULL AND removed"), span)
    first = whole.groupBy("l_doc", "l_tid", "l_start").agg(F.max("l_end").alias("l_end"), F.max("words").alias("l_words"), (F.count(F.lit(1)) + 1).alias("n_in_class"))
    named = whole.join(first.select("l_doc", "l_tid", "l_start", "n_in_class"), ["l_doc", "l_tid", "l_start"])
    named = named.select(F.col("doc").alias(id_col), "start", (F.col("end") - F.col("start")).alias("length"), F.col("words").alias("n_words"), F.col("l_doc").alias("class_doc"),
                         F.col("l_start").alias("class_start"), "n_in_class", F.lit(True).alias("removed"))
    leads = first.select(F.col("l_doc").alias(id_col), F.col("l_start").alias("start"), (F.col("l_end") - F.col("l_start")).alias("length"), F.col("l_words").alias("n_words"),
                         F.col("l_doc").alias("class_doc"), F.col("l_start").alias("class_start"), "n_in_class", F.lit(False).alias("removed"))
    return as_is.unionByName(kept).unionByName(named).unionByName(leads)


def without_passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed passages, which may overlap, cut out of their texts; all other columns stay."""
    cuts = found.where("removed").groupBy(F.col(id_col).alias("_cut_id")).agg(F.sort_array(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("length").cast("int").alias("length")))).alias("_cuts"))
    joined = docs.select(F.struct("*").alias("_row")).join(cuts, F.col("_row").getField(id_col) == F.col("_cut_id"), "left")
    text = F.col("_row").getField(text_col)
    begin = F.lit(0)
    kept = F.aggregate("_cuts", F.struct(F.lit("").alias("out"), begin.alias("at")),
                       lambda acc, c: F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.greatest(c["start"] - acc["at"], F.lit(0)))).alias("out"),
                                              F.greatest(acc["at"], c["start"] + c["length"]).alias("at")),
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    new = F.when(F.col("_cuts").isNull(), text).otherwise(kept)
    return joined.select(*[new.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])
