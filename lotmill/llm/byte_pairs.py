"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a match of the splitting pattern exactly one vocabulary token can be the last one of its
encoding: the token t ending there for which the prefix before t ends in a token u, and the bytes of u and t encode
to (u, t) again. The table of these last tokens is filled from left to right; the encoding of any prefix is read
from it backwards. So an append only continues the table, and after an edit it is filled on until as many entries as
the longest token has bytes agree with the old ones, from where on the rest agrees, too.

Two rules of the merging tokenizer carry over: a match that is itself a vocabulary entry is that one token, and
entries that merging their bytes never yields occur in no other way.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 600_000  # matches of up to 64 characters remembered per Python worker, about 130 MB
PAIRS = 2_000_000  # judged token pairs remembered per Python worker
LOOKAHEAD = 3  # characters after a match that the splitting pattern may look at
SLICE = 4 << 20  # bytes of text worked on at once, one text at least


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64 of the bytes, a blank, the id)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Prefix tables of byte strings under one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: token for token, i in ranks.items()}
        self.split = regex.compile(pattern)
        self.longest = max(map(len, ranks), default=1)
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        if ranks:
            self.automaton.make_automaton()
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self.packed = _Packed(self)

    def merged(self, data: bytes, stop: int = 1) -> list[int]:
        """The merging tokenizer itself, for the few bytes of one or two tokens: always the lowest rank, leftmost first;
        ends with no pair in the vocabulary or with ``stop`` parts."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > stop:
            ranked = [self.ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            low = min((r for r in ranked if r >= 0), default=-1)
            if low < 0:
                break
            at = ranked.index(low)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks.get(p, -1) for p in parts]

    def _made_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens that ``token`` is merged from (-1, -1 for a byte); None if merging its bytes never yields it."""
        if token not in self._parts:
            data = self.tokens[token]
            if len(data) == 1:
                parts = (-1, -1)
            else:
                two = self.merged(data, 2)
                parts = tuple(two) if len(two) == 2 and min(two) >= 0 else None
            self._parts[token] = parts
        return self._parts[token]

    def _follows(self, pair: tuple[int, int]) -> bool:
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        known = self._pairs[pair] = self._undone(*pair)
        return known

    def _undone(self, x: int, y: int) -> bool:
        """Whether the bytes of two tokens merge to the same two again.

        Merges are undone from the last one back. Where a part has a higher rank than what it is merged into, merges do not run
        in the order of the ranks, so the bytes are merged instead.
        """
        before, token, limit = x, y, 1 << 62
        while True:
            across = self.ranks.get(self.tokens[x] + self.tokens[y])
            if across is not None and across < limit:
                return False
            left, right = self._made_of(x), self._made_of(y)
            if left is None or right is None:
                return False
            if max(left) > x or max(right) > y:
                return self.merged(self.tokens[before] + self.tokens[token]) == [before, token]
            if left == (-1, -1) == right:
                return True
            if right == (-1, -1) or left != (-1, -1) and x > y:  # the left one was merged later
                limit, x = x, left[1]
            else:  # at equal ranks the left one was merged first, and a pair across both before the right one
                limit, y = y + 1, right[0]

    def extend(self, last: list[int], data: bytes, until: Callable[[int], bool] | None = None) -> list[int]:
        """Appends to ``last`` (entry i: last token of the first i bytes, entry 0: -1) up to all of ``data``, or until ``until``
        holds for a filled length."""
        done, pairs = len(last) - 1, self._pairs
        text = data.decode("latin-1")
        for end, (size, token) in self.automaton.iter(text, max(0, done + 1 - self.longest)) if done < len(text) else ():
            at = end + 1
            if at <= done or at < size:
                continue
            if at > done + 1:
                break
            if at == size:
                valid = self._made_of(token) is not None
            else:
                key = (last[at - size], token)
                valid = pairs.get(key)
                if valid is None:
                    valid = self._follows(key)
            if valid:
                last.append(token)
                done = at
                if until is not None and until(at):
                    return last
        if done < len(data):
            raise ValueError(f"no vocabulary token ends at byte {done + 1} of a match")
        return last

    def table(self, data: bytes) -> list[int]:
        return self.extend([-1], data)

    def read(self, last: list[int], data: bytes) -> list[int]:
        """The ids of ``data``, backwards through its table."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        ids, at = [], len(data)
        while at:
            ids.append(last[at])
            at -= len(self.tokens[last[at]])
        return ids[::-1]

    def edited(self, last: list[int], data: bytes, start: int, stop: int, new: bytes) -> tuple[list[int], bytes, int]:
        """Table and bytes after ``data[start:stop]`` became ``new``, and the number of entries filled anew."""
        after = data[:start] + new + data[stop:]
        out, moved, same = last[:start + 1], len(new) - (stop - start), 0

        def settled(at: int) -> bool:
            nonlocal same
            old = at - moved
            same = same + 1 if old > stop and at > start + len(new) and last[old] == out[at] else 0
            return same >= self.longest

        self.extend(out, after, settled)
        filled = len(out) - 1 - start
        return out + last[len(out) - moved:], after, filled

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; matches are encoded one by one."""
        return b"".join(map(self.packed.__getitem__, self.split.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Packed(dict):
    """Match -> packed ids; short ones are remembered."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, match: str) -> bytes:
        data = match.encode("utf-8", "replace")
        known = self.encoder.ranks.get(data)
        ids = [known] if known is not None else self.encoder.read(self.encoder.table(data), data)
        packed = np.array(ids, "<u4").tobytes()
        if len(match) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[match] = packed
        return packed


class EncodedText:
    """A text with its matches and their prefix tables; ``replace`` and ``append`` work near the edit only."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.ends: list[int] = []  # of the matches, in characters
        self.datas: list[bytes] = []
        self.tables: list[list[int]] = []
        self.filled = 0  # table entries computed by the last call
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Characters ``start`` to ``stop`` become ``new``. Matches that end LOOKAHEAD characters before the edit stay; splitting
        goes on until a match behind the edit ends where one ended before."""
        text, moved = self.text[:start] + new + self.text[stop:], len(new) - (stop - start)
        kept = bisect.bisect_right(self.ends, start - LOOKAHEAD)
        at = self.ends[kept - 1] if kept else 0
        old = {e: i for i, e in enumerate(self.ends) if e >= stop}
        ends, datas, tables, self.filled = [], [], [], 0
        rest = len(self.ends)
        if kept == len(self.ends) and at == len(self.text) == start and not new:
            return
        # the match that begins where an old one began, and ends before or behind the edit, reuses that one's table
        for found in self.encoder.split.finditer(text, at):
            data = found.group().encode("utf-8", "replace")
            ends.append(found.end())
            datas.append(data)
            tables.append(self._table(found, data, kept, start, stop, new, at))
            if found.end() >= start + len(new) and found.end() - moved in old:
                rest = old[found.end() - moved] + 1
                break
        self.ends = self.ends[:kept] + ends + [e + moved for e in self.ends[rest:]]
        self.datas = self.datas[:kept] + datas + self.datas[rest:]
        self.tables = self.tables[:kept] + tables + self.tables[rest:]
        self.text = text

    def _table(self, found, data: bytes, kept: int, start: int, stop: int, new: str, at: int) -> list[int]:
        encoder = self.encoder
        begin = found.start()
        if begin <= start:  # its old table holds up to the edit
            i = bisect.bisect_right(self.ends, begin)
            if i < len(self.ends) and (self.ends[i - 1] if i else 0) == begin:
                head = self.text[begin:min(start, self.ends[i], found.end())].encode("utf-8", "replace")
                old = self.datas[i]
                if old[:len(head)] == head == data[:len(head)]:
                    tail = 0
                    while tail < min(len(old), len(data)) - len(head) and old[-1 - tail] == data[-1 - tail]:
                        tail += 1
                    out, _, filled = encoder.edited(self.tables[i], old, len(head), len(old) - tail, data[len(head):len(data) - tail])
                    self.filled += filled
                    return out
        self.filled += len(data)
        return encoder.table(data)

    def ids(self) -> list[int]:
        return [i for table, data in zip(self.tables, self.datas) for i in self.encoder.read(table, data)]


_encoders: dict[int, Encoder] = {}


def _encoder(key: int, shared) -> Encoder:
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(*shared.value)
    return _encoders[key]


def _shared(df: DataFrame, ranks: dict[bytes, int], pattern: str):
    """Vocabulary for the tasks; its size is that of the rank file, whatever the data."""
    key = hash((pattern, frozenset(ranks.items())))
    return key, df.sparkSession.sparkContext.broadcast((ranks, pattern))


def _runs(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` (binary) holds about SLICE bytes, one row at least."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        run = (np.cumsum(sizes, dtype=np.int64) - sizes) // SLICE
        cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
        for low, high in zip(cuts, cuts[1:]):
            yield batch.slice(low, high - low)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids) per row, of the whole text; ``ids`` packs them as little-endian unsigned 32-bit integers.

    Null and empty texts have no tokens; repeated rows come back as often; other columns are ignored; text that looks like a
    special token is plain text; bytes that are no UTF-8 count as U+FFFD. A map over the rows, without a shuffle.
    """
    key, shared = _shared(docs, ranks, pattern)

    def run(batches):
        encoder = _encoder(key, shared)
        for batch in _runs(batches, 1):
            texts = (b"" if t is None else t for t in batch.column(1).to_pylist())
            ids = [encoder.encode(t.decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())], names=["id", "n_tokens", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary").select(F.col("id").alias(id_col), "n_tokens", "ids")


def decode(encoded: DataFrame, ranks: dict[bytes, int], pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the bytes that the packed ids stand for (null stays null); a column called ``out_col`` is replaced."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    key, shared = _shared(encoded, ranks, pattern)
    encoded = encoded.drop(out_col)
    place = encoded.columns.index(ids_col)

    def run(batches):
        encoder = _encoder(key, shared)
        for batch in _runs(batches, place):
            out = [None if i is None else encoder.decode(i) for i in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, out_col])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(out_col, BinaryType())]))


def encode_edits(edits: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, n_filled) per row after characters ``start`` to ``stop`` of the text became ``new``.

    ``edits`` has a text and a list ``edits`` of (start, stop, new), done in that order; ``n_filled`` counts the table entries
    that the edits cost. Null texts and null lists count as empty, null in a field as 0 or as no text; places outside the
    text are moved to its ends.
    """
    key, shared = _shared(edits, ranks, pattern)

    def run(batches):
        encoder = _encoder(key, shared)
        for batch in _runs(batches, 1):
            rows = []
            for text, steps in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                state, cost = EncodedText(encoder, (text or b"").decode("utf-8", "replace")), 0
                for step in steps or ():
                    step = step or {"start": 0, "stop": 0, "new": ""}
                    start = min(max(step["start"] or 0, 0), len(state.text))
                    state.replace(start, min(max(step["stop"] or 0, start), len(state.text)), step["new"] or "")
                    cost += state.filled
                ids = np.array(state.ids(), "<u4")
                rows.append((len(ids), ids.tobytes(), cost))
            counts, packed, costs = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()), pa.array(costs, pa.int64())],
                                             names=["id", "n_tokens", "ids", "n_filled"])

    kind = edits.schema[id_col].dataType.simpleString()
    rows = edits.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"),
                        F.col("edits").cast("array<struct<start:int,stop:int,new:string>>").alias("edits"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary, n_filled long").select(F.col("id").alias(id_col), "n_tokens", "ids", "n_filled")
