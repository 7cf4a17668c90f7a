"""Benchmark decontamination with DataFrame functions only.

1. *Windows.* Item-sized stretches of a document, placed so that a shingle shared with an item lies where the
   item has it. A window with any similarity to an item shares a shingle with it, so nothing that could be
   similar goes unseen, and documents without a shared shingle end here.
2. *SimHash.* Windows and items get 64-bit fingerprints of their weighted shingles.
3. *Multi-index.* The fingerprint is cut into ``BLOCKS`` blocks. Two fingerprints within ``radius`` agree in some
   block up to ``radius // BLOCKS`` bits, so items are indexed under every block value within that distance and
   an equality join finds all windows within the radius.
4. *Verification.* Weighted Jaccard of the shingles, each weighing as often as it occurs, decides.

Words are runs of letters and digits, lower-cased. Items of fewer than ``k`` words count as one shingle.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import small, written

BLOCKS = 8
RADIUS = 23  # at similarity 0.8 two fingerprints differ in 9.7 bits on average, standard deviation 2.9


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(words_: Column, k: int) -> Column:
    """Hashes of the runs of ``k`` words, in order; none if there are fewer.

    The words are bound by an outer ``transform``: a filter that is pushed into this expression would
    otherwise carry the splitting of the text into the inner loop.
    """

    def of(w: Column) -> Column:
        run = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])
        return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), run)).otherwise(F.array().cast("array<bigint>"))

    return F.transform(F.array(words_), of)[0]


def simhash(hashes: str) -> Column:
    """64-bit fingerprint of an array column: a bit is set where more than half of the hashes (with repeats) have it."""
    return F.expr(f"""aggregate(transform(sequence(0, 63), b ->
        if(2 * aggregate({hashes}, 0L, (n, h) -> n + (shiftrightunsigned(h, b) & 1L)) > size({hashes}), shiftleft(1L, b), 0L)),
        0L, (whole, bit) -> whole | bit)""")


def block_values(print_: Column) -> Column:
    """Structs (no, value) of the blocks of a fingerprint."""
    width = 64 // BLOCKS
    return F.array(*[F.struct(F.lit(i).alias("no"), F.shiftrightunsigned(print_, i * width).bitwiseAND(F.lit((1 << width) - 1)).alias("value")) for i in range(BLOCKS)])


def neighbours(value: Column, radius: int) -> Column:
    """All block values within the share of ``radius`` that the pigeonhole principle leaves to one block."""
    width = 64 // BLOCKS
    masks = [sum(1 << b for b in bits) for d in range(min(width, radius // BLOCKS) + 1) for bits in combinations(range(width), d)]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))


def leaks(docs: DataFrame, items: DataFrame, k: int = 5, similarity: float = 0.8, radius: int = RADIUS, id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs (id, item) where some window reaches ``similarity``: best window per pair (ties: first one).

    Columns: ``id_col``, ``item_col``, start_word, n_words, hamming, similarity. Null ids, null or empty texts and
    items take no part; further columns are ignored; repeated rows give one pair. A document shorter than
    an item has one window, the whole text.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    bench = items.select(F.col(item_col).alias("item"), words(F.col(item_text).cast("string")).alias("w")).where("item IS NOT NULL AND size(w) > 0").dropDuplicates()
    bench = written(bench.select("item", F.size("w").alias("len"), F.least(F.size("w"), F.lit(k)).alias("k"), "w"), "items")
    lengths = sorted(r["k"] for r in bench.select("k").distinct().collect())  # at most k values
    found = []
    for n in lengths:
        one = bench.where(F.col("k") == n).select("item", "len", shingles(F.col("w"), n).alias("s"))
        found.append(_leaks(docs, one, n, similarity, radius))
    if not found:
        out = docs.select("id", F.lit(None).cast(bench.schema["item"].dataType).alias("item"), F.lit(0).alias("start"), F.lit(0).alias("n"),
                          F.lit(0).alias("hamming"), F.lit(0.0).alias("similarity")).limit(0)
    else:
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
    best = out.groupBy("id", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n", "hamming")).alias("best"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("best.before")).alias("start_word"), F.col("best.n").alias("n_words"),
                       F.col("best.hamming").alias("hamming"), F.col("best.similarity").alias("similarity"))


def _leaks(docs: DataFrame, bench: DataFrame, k: int, similarity: float, radius: int) -> DataFrame:
    grams = written(bench.select("len", F.posexplode("s").alias("q", "h")).distinct(), "grams")
    # the runs side by side and exploded: hashing and look-up then stay in generated code
    runs = F.arrays_zip(*[F.slice("w", i + 1, F.size("w")).alias(f"w{i}") if i else F.col("w").alias("w0") for i in range(k)])
    seen = docs.select("id", words(F.col("text")).alias("w")).select("id", (F.size("w") - k + 1).alias("total"), F.posexplode_outer(runs).alias("p", "run"))
    seen = seen.where("p < total").select("id", "total", "p", F.xxhash64(*[F.col("run").getField(f"w{i}") for i in range(k)]).alias("h"))
    start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("total") - F.col("len") + k - 1))
    windows = seen.join(small(grams), "h").select("id", "len", start.alias("start")).distinct()
    by_doc = written(windows.groupBy("id").agg(F.collect_list(F.struct("len", "start")).alias("wins")), "windows")
    cut = docs.join(small(by_doc), "id").select("id", shingles(words(F.col("text")), k).alias("s"), F.explode("wins").alias("win"))
    cut = cut.select("id", "win.len", "win.start", F.slice(F.col("s"), F.col("win.start") + 1, F.col("win.len") - k + 1).alias("s"))
    cut = written(cut.select("id", "len", "start", "s", simhash("s").alias("print")).dropDuplicates(["id", "len", "start", "print"]), "prints")

    index = bench.select("item", "len", "s", simhash("s").alias("item_print"))
    index = written(index.select("*", F.explode(block_values(F.col("item_print"))).alias("b"))
                    .select("item", "len", "item_print", "b.no", F.explode(neighbours(F.col("b.value"), radius)).alias("value")).distinct(), "index")
    probes = cut.select("id", "len", "start", "print", F.explode(block_values(F.col("print"))).alias("b")).select("id", "len", "start", "print", "b.no", "b.value")
    gap = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = probes.join(small(index), ["len", "no", "value"]).where(gap <= radius).select("id", "len", "start", "print", "item", gap.alias("hamming")).distinct()

    ours = cut.select("id", "len", "start", "print", F.size("s").alias("n"), F.explode("s").alias("h")).groupBy("id", "len", "start", "print", "n", "h").agg(F.count(F.lit(1)).alias("times"))
    theirs = bench.select("item", F.size("s").alias("m"), F.explode("s").alias("h")).groupBy("item", "m", "h").agg(F.count(F.lit(1)).alias("item_times"))
    both = near.join(ours, ["id", "len", "start", "print"]).join(theirs, ["item", "h"])
    shared = both.groupBy("id", "item", "len", "start", "hamming", "n", "m").agg(F.sum(F.least("times", "item_times")).alias("shared"))
    score = F.col("shared") / (F.col("n") + F.col("m") - F.col("shared"))
    return shared.withColumn("similarity", score).where(F.col("similarity") >= similarity).select(
        "id", "item", "start", (F.col("n") + k - 1).alias("n"), "hamming", "similarity")
