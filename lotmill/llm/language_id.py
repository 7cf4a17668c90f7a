"""Language identification by cross-parsing entropy with suffix automata.

A bounded sample of labelled texts per language is turned into a suffix automaton. A text is cut greedily into
the longest phrases that occur in the sample; a text of the sample's language needs few. The phrase count is
normalised to bits per symbol, ``phrases * log2(sample length) / symbols``, and the language with the fewest wins.

Symbols are lower-cased letters; every run of other characters is one blank. Parsing starts anew every ``PIECE``
symbols, so that long texts are parsed side by side.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_CHARS = 16_000  # letters learned per language
SHARE = SAMPLE_CHARS // 8  # characters taken of one text
SAMPLE_TEXTS = 64  # texts looked at per language at first; eight times as many while they hold too few letters
PIECE = 8_192
BATCH = 4 << 20  # characters parsed side by side

PREDICTION = "lang_pred string, score double, bits double"


@functools.cache
def _fold_table() -> tuple[np.ndarray, np.ndarray]:
    """Code point -> lower-cased code point, and -> is it a letter."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    lower = np.arange(len(letter), dtype=np.uint32)
    at = np.flatnonzero(letter)
    lower[at] = [ord(x) if len(x := chr(c).lower()) == 1 else c for c in at]
    return lower, letter


def symbols(text: str | None, tables) -> np.ndarray:
    """Lower-cased letters of a text with one 32 for each run of other characters between them."""
    lower, letter = tables
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    is_letter = letter[codes]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    out = np.where(is_letter, lower[codes], 32)[keep]
    return out if len(out) and is_letter.any() else out[:0]


class SuffixAutomaton:
    """Suffix automaton of a symbol sequence; ``next[state]`` maps a symbol to a state, state 0 is the start."""

    def __init__(self, sequence):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in sequence:
            new = len(length)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(length)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = link[new] = copy
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = link[p]
            last = new


class Parser:
    """Phrase counts of many texts against all languages at once, one table look-up per symbol and language."""

    def __init__(self, samples: dict[str, str]):
        self.tables = _fold_table()
        learned = {lang: symbols(text, self.tables) for lang, text in sorted(samples.items())}
        learned = {lang: s for lang, s in learned.items() if len(s)}
        self.langs = list(learned)
        self.bits = np.array([np.log2(len(s) + 1.0) for s in learned.values()])
        alphabet = np.unique(np.concatenate([*learned.values(), np.array([32], np.uint32)]))
        width = len(alphabet) + 1  # the last symbol stands for all unknown ones
        self.code = np.full(0x110000, width - 1, np.int32)
        self.code[alphabet] = np.arange(width - 1)
        steps, self.start, offset = [], [], 0
        for s in learned.values():
            automaton = SuffixAutomaton(self.code[s].tolist())
            root = np.full(width, offset * width * 4 + 2, np.int64)  # an unseen symbol is a phrase of its own
            for c, state in automaton.next[0].items():
                root[c] = (offset + state) * width * 4 + 1
            rows = np.tile(root, (len(automaton.next), 1))
            rows[0] -= rows[0] & 3  # nothing has been matched yet, so no phrase ends here
            rows[0, root & 3 == 2] += 1
            for state, known in enumerate(automaton.next):
                rows[state, list(known)] = (np.fromiter(known.values(), np.int64, len(known)) + offset) * width * 4
            steps.append(rows.ravel())
            self.start.append(offset * width)
            offset += len(automaton.next)
        self.step = np.concatenate(steps) if steps else np.zeros(0, np.int64)  # next row start * 4 + phrases ended
        if len(self.step) * 4 < 1 << 31:
            self.step = self.step.astype(np.int32)
        self.start = np.array(self.start, self.step.dtype)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrase counts, texts x languages; the open phrase at the end of a piece counts as one."""
        cuts = [(i, at) for i, s in enumerate(texts) for at in range(0, len(s), PIECE)]
        sizes = np.array([min(PIECE, len(texts[i]) - at) for i, at in cuts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        flat = self.code[np.concatenate([texts[cuts[j][0]][cuts[j][1]:cuts[j][1] + PIECE] for j in order])] if len(cuts) else np.zeros(0, np.int32)
        begin = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
        state = np.repeat(self.start[:, None], len(cuts), axis=1)
        count = np.ones((len(self.langs), len(cuts)), np.int64)
        live = len(cuts)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            while sizes[live - 1] <= t:
                live -= 1
            step = self.step[state[:, :live] + flat[begin[:live] + t]]
            count[:, :live] += step & 3
            state[:, :live] = step >> 2
        count -= state == self.start[:, None]
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        np.add.at(out, np.array([cuts[j][0] for j in order], np.int64), count.T)
        return out

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        rows = [("und", 0.0, None)] * len(texts)
        at = 0
        while at < len(texts):
            parts, taken = [], 0
            while at + len(parts) < len(texts) and (taken == 0 or taken + len(texts[at + len(parts)] or "") <= BATCH):
                parts.append(symbols(texts[at + len(parts)], self.tables))
                taken += max(1, len(texts[at + len(parts) - 1] or ""))
            if self.langs:
                bits = self.phrases(parts) * self.bits / np.maximum(1, [len(p) for p in parts])[:, None]
                for i, (row, part) in enumerate(zip(bits, parts, strict=True)):
                    if len(part):
                        best = int(np.argmin(row))
                        second = np.delete(row, best).min() if len(row) > 1 else np.inf
                        rows[at + i] = (self.langs[best], float(1 - row[best] / (row[best] + second)) if second < np.inf else 1.0, float(row[best]))
            at += len(parts)
        return pd.DataFrame(rows, columns=["lang_pred", "score", "bits"])


_parsers: dict[int, Parser] = {}


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", seed: int = 7) -> dict[str, str]:
    """A text sample per language of ``labelled``, from texts of any length: the SHARE characters from the first letter on of
    one text after the other, in the order of a seeded hash of the id, until SAMPLE_CHARS letters are reached.
    Equal pieces count once. Rows with a null language, id or text, or without a letter, are not used. The result grows with
    the number of languages only."""
    spark = labelled.sparkSession
    piece = F.regexp_extract(text_col, rf"(?s)\p{{L}}.{{0,{SHARE - 1}}}", 0)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"), piece.alias("piece")).where("piece <> ''")
    rows = rows.withColumn("p", F.xxhash64("piece"))
    letters = F.length(F.regexp_replace("piece", r"\P{L}+", ""))
    pieces = rows.select("lang", "p", "h", letters.alias("n")).groupBy("lang", "p").agg(F.min("h").alias("h"), F.min("n").alias("n"))
    order = Window.partitionBy("lang").orderBy("h", "p")
    most = SAMPLE_TEXTS
    while True:  # every piece has a letter, so SAMPLE_CHARS of them are always enough
        first = pieces.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most)
        first = first.withColumn("upto", F.sum("n").over(order)).where(F.col("upto") - F.col("n") < SAMPLE_CHARS)
        chosen = first.select("lang", "p", "h", "r", "upto").collect()
        if most >= SAMPLE_CHARS or not any(c["r"] == most and c["upto"] < SAMPLE_CHARS for c in chosen):
            break
        most = min(8 * most, SAMPLE_CHARS)
    if not chosen:
        return {}
    wanted = spark.createDataFrame([(c["lang"], c["p"]) for c in chosen], rows.select("lang", "p").schema)
    found = rows.join(F.broadcast(wanted), ["lang", "p"]).groupBy("lang", "p").agg(F.min("piece").alias("piece")).collect()  # a bounded sample
    place = {(c["lang"], c["p"]): (c["h"], c["p"]) for c in chosen}
    texts: dict[str, str] = {}
    for row in sorted(found, key=lambda r: place[r["lang"], r["p"]]):
        texts[row["lang"]] = texts.get(row["lang"], "") + " " + row["piece"]
    return texts


def predicted(spark, samples: dict[str, str], text: Column) -> Column:
    """Struct (lang_pred, score, bits) of a text column.

    ``und``, score 0 and null bits where the text is null or has no letter, or nothing was learned; equal
    entropies go to the language that sorts first. The score is the runner-up's share of both entropies
    (0.5 for a tie), 1 if only one language was learned. Marked as not deterministic, so that a filter on the result
    is not pushed below it, which would parse every text a second time.
    """
    shared = spark.sparkContext.broadcast(samples)
    key = hash(tuple(sorted(samples.items())))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if key not in _parsers:
            _parsers.clear()
            _parsers[key] = Parser(shared.value)
        for batch in batches:
            yield _parsers[key].predict(batch.where(batch.notna(), None).tolist())

    return F.pandas_udf(run, PREDICTION).asNondeterministic()(text)


def identify(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, bits) for every row; rows that repeat come back as often, other columns are ignored."""
    found = docs.select(F.col(id_col).alias("_id"), predicted(docs.sparkSession, samples, F.col(text_col)).alias("_p"))
    return found.select(F.col("_id").alias(id_col), "_p.lang_pred", "_p.score", "_p.bits")
