"""Word and shingle hashes of whole texts, computed on the bytes of an Arrow batch with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes hashed at once; texts and words may be longer
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_random = np.random.default_rng(20240229)
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= CHUNK:
        if 0 not in _cache:
            _cache[0] = _powers(_BASE, CHUNK + 1), _powers(_INVERSE, CHUNK + 1)
        return _cache[0]
    return _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word (run of bytes other than blanks 9-13 and 32) and the byte after it."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank = _SPACE[data]
    first = ~blank
    first[1:] &= blank[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edges] |= ~blank[edges]
    starts = np.flatnonzero(first)
    last = ~blank
    last[:-1] &= blank[1:]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] |= ~blank[ends]
    return starts, np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (A-Z lowered) and its row."""
    starts, stops = word_spans(data, offsets)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(stops, starts[at] + CHUNK, "right")))
        low, high = starts[at], stops[end - 1]
        up, down = _tables(int(high - low))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_VALUE[data[low:high]] * down[:high - low], out=sums[1:])
        s, e = starts[at:end] - low, stops[at:end] - low
        out[at:end] = mix((sums[e] - sums[s]) * up[s] + (e - s).astype(np.uint64))
        at = end
    return out, np.searchsorted(offsets, starts, "right") - 1


def shingle_hashes(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside a row and their rows; a row of fewer words is one run."""
    n = len(words)
    if n == 0:
        return words, rows
    h = mix(words)
    run = np.ones(n, np.int64)
    for i in range(1, min(k, n)):
        h[:n - i] = np.where(rows[i:] == rows[:n - i], mix(h[:n - i] * _U(3) + words[i:]), h[:n - i])
        run[:n - i] += rows[i:] == rows[:n - i]
    begins = np.r_[True, rows[1:] != rows[:-1]]
    keep = (run == k) | begins
    return h[keep], rows[keep]


def slices(texts: pa.Array, most: int = 2 << 20) -> Iterator[pa.Array]:
    """The array in runs of about ``most`` bytes, so that the memory used follows neither rows nor batch size."""
    _, offsets = bytes_of(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield texts.slice(at, end - at)
        at = end


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For every text the sorted distinct hashes of its shingles."""
    for part in slices(texts):
        _, offsets = data_offsets = bytes_of(part)
        hashes, rows = shingle_hashes(*word_hashes(*data_offsets), k)
        cuts = np.searchsorted(rows, np.arange(len(offsets)))
        for i in range(len(offsets) - 1):
            yield np.unique(hashes[cuts[i]:cuts[i + 1]])
