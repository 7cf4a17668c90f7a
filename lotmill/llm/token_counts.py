"""Token counts of a unigram tokenizer without producing the tokens.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each character; dynamic programming carries
the best score and its number of pieces. Rules of the tokenizer: a blank becomes U+2581 and one is put in front;
among equal scores the longest last piece wins; a character without a piece of its own is unknown, with the lowest
score minus 10, and counts as its UTF-8 bytes where the vocabulary has all of them (byte fallback), else as one
token, neighbouring ones fused.

No piece runs across the beginning of a run of blanks, so a text is counted stretch by stretch, and equal
stretches of a batch are counted once.
"""

from __future__ import annotations

import re
from collections import Counter

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
CACHE = 1_000_000  # stretches remembered per Python worker, about 100 MB
_STRETCH = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[tuple[str, float]], bool]:
    """Pieces with their scores, and whether the vocabulary has all 256 byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain], sum(map(model.is_byte, ids)) == 256


class Counter1:
    """Piece counts of stretches under one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - 10.0
        self.byte_fallback = byte_fallback
        crossing = [p for p, _ in pieces if BLANK in p.lstrip(BLANK)]
        self.whole = bool(crossing)  # such a vocabulary allows no cutting
        self.cache: dict[str, int] = {}

    def count(self, stretch: str) -> int:
        n = len(stretch)
        best: list[float] = [0.0] + [float("-inf")] * n
        pieces = [0] * (n + 1)
        open_unknown = [False] * (n + 1)
        known_at = 0
        single, unknown = self.single, self.unknown

        def fill(upto: int) -> None:
            """Ends before ``upto`` are settled: characters without a piece of their own can also be unknown."""
            nonlocal known_at
            while known_at < upto:
                c = stretch[known_at]
                end = known_at + 1
                if c not in single and best[known_at] + unknown > best[end]:
                    best[end] = best[known_at] + unknown
                    if self.byte_fallback:
                        pieces[end] = pieces[known_at] + len(c.encode("utf-8", "replace"))
                    else:
                        pieces[end] = pieces[known_at] + (not open_unknown[known_at])
                        open_unknown[end] = True
                known_at = end

        for last, (size, score) in self.automaton.iter(stretch):
            if known_at < last:
                fill(last)
            start = last + 1 - size
            total = best[start] + score
            if total > best[last + 1]:
                best[last + 1] = total
                pieces[last + 1] = pieces[start] + 1
        fill(n)
        return pieces[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        text = BLANK + text.replace(" ", BLANK)
        stretches = [text] if self.whole else _STRETCH.findall(text)
        total = 0
        for stretch, times in Counter(stretches).items() if len(stretches) > 64 else ((s, 1) for s in stretches):
            n = self.cache.get(stretch)
            if n is None:
                n = self.count(stretch)
                if len(stretch) < 64:
                    if len(self.cache) >= CACHE:
                        self.cache.clear()
                    self.cache[stretch] = n
            total += n * times
        return total


_counters: dict[int, Counter1] = {}


def token_counts(docs: DataFrame, vocabulary: tuple[list[tuple[str, float]], bool], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) per row, of the whole text. Null and empty texts count 0; repeated rows come back as often; other columns
    are ignored. Unknown characters that meet across two stretches count apart."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    key = hash((tuple(vocabulary[0]), vocabulary[1]))

    def run(batches):
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter1(*shared.value)
        counter = _counters[key]
        for batch in batches:
            found = [counter.text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["id", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_tokens long")
    return found.select(F.col("id").alias(id_col), "n_tokens")
