"""Phrase collocations by marginalising the longest windows.

Every word occurrence starts one window of up to five words, padded with nulls where its piece of text ends. Only these
windows are counted; ROLLUP over their word columns then sums them to all shorter phrases: the phrases that begin at
a place are the prefixes of its window. The lead columns are shifted copies of a piece's own word array, so no word is
shuffled to find its successors.

A phrase can be frequent only if all its runs of two and three words are. Such runs are counted first by a hash of
fixed range (several runs may share a count, so a count below the limit proves that all of them are rare): pairs, then
the triples whose pairs may be frequent. Windows are padded from the first rare run on. That changes no count of a
frequent phrase and keeps most windows to one word. The maps of frequent counts have a largest size that does not depend
on the data; where nearly all counts are frequent they only save less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotmill.llm.common import written

WORDS = 5
COUNTS = 1 << 24, 1 << 28  # least and largest hash range; a map of frequent counts has at most 1/64 as many rows of two numbers
_ENDS = r"[.,;:!?\x0A-\x0D]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pieces(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, words): the pieces of all texts that have a word; null texts have none, a null language is ``und``."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.explode(F.split(F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER), _ENDS)).alias("piece"))
    rows = rows.select("lang", F.expr(r"trim(BOTH ' \t' FROM piece)").alias("piece")).where("piece <> ''")
    return rows.select("lang", F.split("piece", r"[ \t]+").alias("words"))


def _leads(rows: DataFrame, n: int) -> DataFrame:
    """One row per word occurrence with its next words as columns w1 to w<n>, null beyond the end of the piece."""
    shifted = [F.col("words")] + [F.slice("words", k, F.size("words")) for k in range(2, n + 1)]
    rows = rows.select("lang", F.explode(F.arrays_zip(*[c.alias(f"w{k}") for k, c in enumerate(shifted, 1)])).alias("w"))
    return rows.select("lang", *[F.col("w")[f"w{k}"].alias(f"w{k}") for k in range(1, n + 1)])


def hash_range(docs: DataFrame, text_col: str = "text") -> int:
    """A count for about sixteen words of text, as a power of two within COUNTS."""
    letters = docs.agg(F.sum(F.length(F.col(text_col).cast("string")))).first()[0] or 0
    return min(max(1 << (letters // 96).bit_length(), COUNTS[0]), COUNTS[1])


def _place(words: list[str], counts: int) -> Column:
    return F.pmod(F.xxhash64("lang", *words), F.lit(counts)).cast("int")


def _looked_up(rows: DataFrame, frequent: DataFrame, place: str, how: str) -> DataFrame:
    """Adds the bits of the block of ``place``; a null place has none."""
    named = F.broadcast(frequent.select(F.col("block").alias(f"{place}_block"), F.col("bits").alias(f"{place}_bits")))
    return rows.join(named, F.expr(f"{place} div 64") == F.col(f"{place}_block"), how)


def _is_set(place: str) -> Column:
    return F.coalesce(F.expr(f"shiftright({place}_bits, {place} % 64) & 1") == 1, F.lit(False))


def frequent_runs(rows: DataFrame, least: int, counts: int, pairs: DataFrame | None = None) -> DataFrame:
    """(block, bits): 64 hash counts a row, a bit set where the count reaches ``least``; at most counts / 64 rows.

    Counts pairs of words or, given the map of the pairs, triples whose two pairs may be frequent.
    """
    words = ["w1", "w2"] if pairs is None else ["w1", "w2", "w3"]
    runs = _leads(rows, len(words)).where(f"{words[-1]} IS NOT NULL")
    if pairs is not None:
        for i in (0, 1):
            runs = _looked_up(runs.withColumn(f"p{i}", _place(words[i:i + 2], counts)), pairs, f"p{i}", "inner").where(_is_set(f"p{i}"))
    found = runs.groupBy(_place(words, counts).alias("place")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return found.groupBy(F.expr("cast(place div 64 AS int)").alias("block")).agg(F.expr("bit_or(shiftleft(1L, place % 64))").alias("bits"))


def windows(rows: DataFrame, pairs: DataFrame, triples: DataFrame, counts: int, n: int = WORDS) -> DataFrame:
    """(lang, w1 to w<n>): one padded window per word occurrence, cut at the first run that is proven rare."""
    out = _leads(rows, n)
    for k in range(2, n + 1):
        run = [f"w{i}" for i in range(max(1, k - 2), k + 1)]
        known = F.col(run[-1]).isNotNull() & F.col(run[-2]).isNotNull()  # null from an earlier cut on
        out = _looked_up(out.withColumn(f"p{k}", F.when(known, _place(run, counts))), pairs if k == 2 else triples, f"p{k}", "left")
        out = out.withColumn(f"w{k}", F.when(_is_set(f"p{k}"), F.col(f"w{k}")))
    return out.select("lang", *[f"w{k}" for k in range(1, n + 1)])


def phrase_counts(rows: DataFrame, least: int, counts: int, n: int = WORDS) -> DataFrame:
    """(lang, words, f): all phrases of up to ``n`` words with f >= ``least``, and per language the total as the empty phrase."""
    pairs = written(frequent_runs(rows, least, counts), "frequent_pairs")
    triples = written(frequent_runs(rows, least, counts, pairs), "frequent_triples")
    columns = [f"w{k}" for k in range(1, n + 1)]
    longest = windows(rows, pairs, triples, counts, n).groupBy("lang", *columns).agg(F.count(F.lit(1)).alias("c"))
    summed = longest.rollup("lang", *columns).agg(F.sum("c").alias("f"), F.grouping_id().alias("g"))
    # level k keeps k word columns: its last n - k bits are set; a null in the k-th column there is padding, not a phrase
    level = F.lit(n) - F.bit_count("g")
    padded = F.array_position(F.array(*[F.when(F.col(c).isNull(), 1).otherwise(0) for c in columns]), 1)
    kept = summed.where(F.col("g") < (1 << n)).withColumn("level", level).where(
        (F.col("level") == 0) | ((F.col("f") >= least) & ((padded == 0) | (padded > F.col("level")))))
    return kept.select("lang", F.slice(F.array(*columns), F.lit(1), F.col("level")).alias("words"), "f")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, counts: int | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Empty tables and texts without words give no row; repeated documents count as often; a null language is ``und``; equal
    scores are ordered by count, then phrase. ``counts`` (a multiple of 64) is the hash range; it changes the work, not the rows. Other columns are ignored, whatever their names.
    """
    found = written(phrase_counts(pieces(docs, text_col, lang_col), least, counts or hash_range(docs, text_col)), "phrases")
    totals = found.where("size(words) = 0").select("lang", F.col("f").alias("n"))
    known = found.where("size(words) > 0").select("lang", F.array_join("words", " ").alias("phrase"), "f", "words")
    candidates = known.where("size(words) > 1")

    # a phrase goes where one that holds it is as frequent (100 * f(longer) >= 100 * a)
    inner = candidates.where("size(words) > 2").select("lang", "f", F.explode(F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))")).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("inside"))
    alone = candidates.join(inner, ["lang", "phrase"], "left").where("inside IS NULL OR 100 * inside < 100 * f")

    cuts = alone.select("lang", "phrase", F.col("f").alias("a"), F.posexplode(F.expr(
        "transform(sequence(1, size(words) - 1), k -> struct(array_join(slice(words, 1, k), ' ') AS first, array_join(slice(words, k + 1, size(words)), ' ') AS rest))")))
    cuts = cuts.select("lang", "phrase", "a", (F.col("pos") + 1).alias("k"), "col.first", "col.rest")
    part = lambda name, as_name: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(as_name))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    wide = lambda c: f"cast({c} AS decimal(19,0))"
    cuts = cuts.withColumn("score", F.expr(f"(1000 * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.select("lang", "phrase", "a", "n", "b.score", "b.l", "b.r").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(t, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, ws[i:i + m - 1] AS words, count(*) AS f FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(ws) GROUP BY 1, 2 HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY 1),
inner_of AS (SELECT lang, words[i:i + m - 1] AS words, max(f) AS f FROM (SELECT lang, words, f, m, unnest(range(1, len(words) - m + 2)) AS i FROM g, (SELECT unnest(range(2, 5)) AS m) WHERE m < len(words)) GROUP BY 1, 2),
alone AS (SELECT g.lang, g.words, g.f FROM g LEFT JOIN inner_of i ON g.lang = i.lang AND g.words = i.words WHERE len(g.words) > 1 AND (i.f IS NULL OR 100 * i.f < 100 * g.f)),
cut AS (SELECT lang, words, f, unnest(range(1, len(words))) AS k FROM alone),
scored AS (SELECT c.lang, c.words, c.k, c.f AS a, x.f AS l, y.f AS r, n.n, CAST((1000::HUGEINT * c.f * n.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
 FROM cut c JOIN g x ON x.lang = c.lang AND x.words = c.words[1:c.k] JOIN g y ON y.lang = c.lang AND y.words = c.words[c.k + 1:] JOIN n ON n.lang = c.lang),
best AS (SELECT *, array_to_string(words, ' ') AS phrase FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) WHERE rank <= 2000"""
