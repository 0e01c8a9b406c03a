"""Words of whole Arrow batches, hashed without a loop over texts.

Words are maximal runs of bytes other than the six ASCII white-space bytes, A-Z lower-cased; that is the
same as runs of characters, as UTF-8 uses these bytes for nothing else. A word's hash is a polynomial in
random values of its bytes, modulo 2^64, then mixed; hashes stand for words wherever they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(64, np.uint64)
with np.errstate(over="ignore"):
    for _i in range(1, 64):
        _powers[_i] = _powers[_i - 1] * np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        more = np.full(n - len(_powers), np.uint64(0xD6E8FEB86659FD93))
        _powers = np.concatenate([_powers, _powers[-1] * np.multiply.accumulate(more)])
    return _powers


def slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of texts with about ``most`` bytes; a longer text is a run of its own."""
    texts = texts.cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    _, offset_buffer, data = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, n + 1 + texts.offset)[texts.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words of each text) of a run of texts."""
    solid = ~_SPACE[raw]
    at = np.flatnonzero(solid)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1] + 1
    starts_of_texts = np.searchsorted(at, offsets[:-1])
    first[starts_of_texts[starts_of_texts < len(at)]] = True
    begin = np.flatnonzero(first)
    place = np.arange(len(at)) - np.repeat(begin, np.diff(begin, append=len(at)))
    table = _power_table(int(place.max()) + 1)
    value = np.add.reduceat(_VALUE[raw[at]] * table[place], begin)
    counts = np.diff(np.searchsorted(at[begin], offsets))
    return mixed(value), counts


def shingles(raw: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, ascending within each text; how many each text has).

    A text with fewer than n words, but some, has its whole sequence as one shingle.
    """
    hashes, counts = words(raw, offsets)
    begin = np.cumsum(counts) - counts
    per = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    total = int(per.sum())
    if not total:
        return np.zeros(0, np.uint64), per
    doc = np.repeat(np.arange(len(counts)), per)
    at = np.arange(total) - np.repeat(np.cumsum(per) - per, per) + np.repeat(begin, per)
    value = np.zeros(total, np.uint64)
    length = np.minimum(counts, n)[doc]
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    factors = np.multiply.accumulate(np.full(n, _STEP))
    for k in range(n):
        value += np.where(k < length, padded[at + k], np.uint64(0)) * factors[k]
    value = mixed(value + length.astype(np.uint64))
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    keep = np.ones(total, bool)
    keep[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[keep], np.bincount(doc[keep], minlength=len(counts))
