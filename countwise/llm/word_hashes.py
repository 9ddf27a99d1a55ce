"""64-bit hashes of the words of Arrow text columns, without Python strings.

A word is a run of bytes other than blank and 0x09-0x0D.  Its hash is a
polynomial over randomly drawn byte values, computed from prefix sums over the
column's buffer and then mixed; runs of words are hashed alike.  Different
words or runs share a hash with a chance of about 2^-58.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 & ~7 | 3  # odd, and 3 modulo 8: neighbouring powers differ in low bits
_RUN_BASE = 0xD6E8FEB86659FD93 & ~7 | 3
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
#: Bytes hashed at once; a longer word is hashed alone.
BLOCK = 1 << 18


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                self.up, self.down = (
                    np.cumprod(np.append(np.uint64(1), np.full(size, b, np.uint64)), dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_BYTES, _RUNS = _Powers(_BASE), _Powers(_RUN_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    own = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return own, at - at[0]


def word_spans(data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, end) of every word; a text's end ends its word."""
    word = ~_SPACE[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    inner = texts[(texts > 0) & (texts < len(data))]
    opens[inner] = word[inner]
    closes[inner - 1] = word[inner - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """Hash of the bytes of each span; spans ascend and do not overlap."""
    hashes = np.empty(len(starts), np.uint64)
    k = 0
    with np.errstate(over="ignore"):
        while k < len(starts):
            lo = starts[k]
            j = max(k + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
            part = data[lo:ends[j - 1]]
            up, down = _BYTES.to(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[_FOLD[part] if fold_case else part] * up, out=sums[1:])
            s, e = starts[k:j] - lo, ends[k:j] - lo
            hashes[k:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            k = j
    return hashes


def column_words(column: pa.Array, fold_case: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, n + 1 word offsets of the texts) of a string column."""
    data, texts = text_buffer(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    starts, ends = word_spans(data, texts)
    return span_hashes(data, starts, ends, fold_case), np.searchsorted(starts, texts)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each place; len(words) - length + 1 values."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        up, down = _RUNS.to(len(words))
        sums = np.append(np.uint64(0), np.cumsum(words * up, dtype=np.uint64))
        return mix((sums[length:] - sums[:n]) * down[:n])


def places(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, number per text) of all runs of ``length`` words inside one text."""
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    ends = np.cumsum(counts)
    return np.repeat(offsets[:-1] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0), counts
