"""Whole-text encoding with the ``tokenizers`` library, cached per word.

Both vocabularies split a text into pre-tokens that never reach across
certain white space, so the ids of a text are the ids of its units in order.
A unit's ids always come from the library; they are kept under the unit's
64-bit hash, because the same units recur.  A text for which the split is not
provably safe is encoded whole by the library.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from countwise.llm.word_hashes import mix, span_hashes, text_buffer, word_spans

#: Cached units beyond which a worker forgets them all.
CACHE_UNITS = 1 << 20
#: Bytes of text handled at once in a task.
SLICE_BYTES = 1 << 21
#: Units given to the library in one call, and what stands between them.
JOINED = 1000
_BAR, _FEED = "|", "\n"
#: How a unit follows what is before it.
_FIRST, _AFTER_BLANK, _AFTER_FEED = 0, 1, 2
#: First bytes of white space beyond ASCII, and the bytes that follow them.
_WIDE = {0xC2: [(0x85,), (0xA0,)], 0xE1: [(0x9A, 0x80)],
         0xE2: [(0x80, x) for x in [*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF]] + [(0x81, 0x9F)], 0xE3: [(0x80, 0x80)]}
_WIDE_FIRST = np.zeros(256, bool)
_WIDE_FIRST[list(_WIDE)] = True
_ODD = np.zeros(256, bool)  # white space other than blank and line feed
_ODD[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True


class _Slots:
    """Row numbers by 64-bit key: open addressing in arrays, for whole arrays of keys at once."""

    def __init__(self):
        self.table = np.full(1 << 17, -1, np.int32)
        self.keys = np.zeros(1 << 15, np.uint64)
        self.n = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        mask = np.uint64(len(self.table) - 1)
        at = keys & mask
        rows = self.table[at]
        open_ = np.flatnonzero((self.keys[rows] != keys) & (rows >= 0))
        while len(open_):
            at[open_] = (at[open_] + np.uint64(1)) & mask
            rows[open_] = self.table[at[open_]]
            open_ = open_[rows[open_] >= 0]
            open_ = open_[self.keys[rows[open_]] != keys[open_]]
        return rows

    def add(self, keys: np.ndarray) -> None:
        """Give new, distinct keys the next rows."""
        first, self.n = self.n, self.n + len(keys)
        self.keys = grown(self.keys, self.n)
        self.keys[first:self.n] = keys
        if 2 * self.n > len(self.table):
            self.table = np.full(1 << (4 * self.n - 1).bit_length(), -1, np.int32)
            first, keys = 0, self.keys[:self.n]
        mask = np.uint64(len(self.table) - 1)
        rows, at = np.arange(first, first + len(keys), dtype=np.int32), keys & mask
        while len(rows):
            free = self.table[at] < 0
            self.table[at[free]] = rows[free]
            lost = self.table[at] != rows
            rows, at = rows[lost], (at[lost] + np.uint64(1)) & mask


def grown(values: np.ndarray, n: int) -> np.ndarray:
    """``values``, or a copy with room for n and half as many more."""
    if n <= len(values):
        return values
    more = np.zeros(n + n // 2, values.dtype)
    more[:len(values)] = values
    return more


class Encoder:
    """Encodes texts with one tokenizer file.

    ``kind`` is ``"byte"`` (byte-level BPE: a blank belongs to the word after
    it, a line feed stands alone) or ``"word"`` (white space is dropped, letters
    are lowered).
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        if kind not in ("byte", "word"):
            raise ValueError(f"unknown kind of tokenizer: {kind}")
        self.tokenizer = Tokenizer.from_file(path)
        #: Texts that hold one are encoded whole: the library cuts them there first.
        self.markers = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = kind
        self.mark = _FEED if kind == "byte" else _BAR
        (self.mark_id,) = self._library([self.mark])[0]
        self._start()

    def _start(self) -> None:
        self.slots = _Slots()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 15, np.int64)
        self.sizes = np.zeros(1 << 15, np.int32)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _spelled(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units in a row, and how many each one has.

        Units go to the library joined by a mark whose id none of them has and
        which, with its neighbours, always becomes a pre-token of its own.
        """
        joint = " | " if self.kind == "word" else _FEED
        parts, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(units), JOINED):
            some = units[k:k + JOINED]
            ids = np.array(self._library([joint.join(some)])[0], np.uint32)
            mark = np.flatnonzero(ids == self.mark_id)
            if len(mark) == len(some) - 1:
                parts.append(np.delete(ids, mark))
                sizes.append(np.diff(np.concatenate([[-1], mark, [len(ids)]])) - 1)
            else:  # a unit has the mark in it
                alone = self._library(some)
                parts += [np.array(x, np.uint32) for x in alone]
                sizes.append(np.fromiter(map(len, alone), np.int64, len(alone)))
        return np.concatenate(parts), np.concatenate(sizes)

    def _learn(self, keys: np.ndarray, units: list[str], after_feed: np.ndarray) -> None:
        # Units with the mark in them come last, so few calls hold one.
        hold = np.array([_BAR in u for u in units]) if self.kind == "word" else np.zeros(len(units), bool)
        order = np.argsort(hold, kind="stable")
        keys, units, after_feed = keys[order], [units[i] for i in order.tolist()], after_feed[order]
        ids, sizes = self._spelled(units)
        if after_feed.any():
            ids = np.insert(ids, (np.cumsum(sizes) - sizes)[after_feed], self.mark_id)
            sizes = sizes + after_feed
        first = self.slots.n
        self.slots.add(keys)
        self.ids, self.starts, self.sizes = (
            grown(self.ids, self.used + len(ids)), grown(self.starts, self.slots.n), grown(self.sizes, self.slots.n))
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[first:self.slots.n] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:self.slots.n] = sizes
        self.used += len(ids)

    def _whole(self, data: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Which texts must be encoded whole: with an added token in them, odd white space, several in a row, or some at an end."""
        odd = np.zeros(len(texts) - 1, bool)
        raw = data.tobytes()
        for marker in self.markers:
            at = raw.find(marker)
            while at >= 0:
                # A match across two texts only sends the first one to the library.
                k = int(np.searchsorted(texts, at, "right")) - 1
                odd[k] = True
                at = raw.find(marker, at + 1)
        if self.kind == "word":
            return odd
        space = (data == 0x20) | (data == 0x0A)
        bad = _ODD[data]
        bad[1:] |= space[1:] & space[:-1]
        full = texts[:-1][texts[:-1] < texts[1:]]
        bad[full] |= space[full]
        ends = texts[1:][texts[:-1] < texts[1:]] - 1
        bad[ends] |= space[ends]
        for at in np.flatnonzero(_WIDE_FIRST[data]).tolist():
            rest = data[at + 1:at + 3].tobytes()
            if any(rest.startswith(bytes(x)) for x in _WIDE[int(data[at])]):
                bad[at] = True
        odd[np.searchsorted(texts, np.flatnonzero(bad), "right") - 1] = True
        return odd

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, n + 1 offsets) of a string column; null counts as empty."""
        data, texts = text_buffer(column)
        parts, sizes, k = [], [np.zeros(1, np.int64)], 0
        while k < len(texts) - 1:
            j = max(k + 1, int(np.searchsorted(texts, texts[k] + SLICE_BYTES, "right")) - 1)
            ids, own = self._encode_slice(data[texts[k]:texts[j]], texts[k:j + 1] - texts[k])
            parts.append(ids)
            sizes.append(own)
            k = j
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.cumsum(np.concatenate(sizes))

    def _encode_slice(self, data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        whole = self._whole(data, texts)
        starts, ends = word_spans(data, texts)
        of = np.searchsorted(texts, starts, "right") - 1
        if whole.any():
            keep = ~whole[of]
            starts, ends, of = starts[keep], ends[keep], of[keep]
        keys = span_hashes(data, starts, ends, fold_case=self.kind == "word")
        if self.kind == "byte":
            before = np.where(starts == texts[of], _FIRST, np.where(data[starts - 1] == 0x0A, _AFTER_FEED, _AFTER_BLANK))
            with np.errstate(over="ignore"):
                keys = mix(keys + before.astype(np.uint64))
        if self.slots.n > CACHE_UNITS:
            self._start()
        rows = self.slots.find(keys)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            at = missing[where]
            raw = data.tobytes()
            units = [raw[s:e].decode() for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            feed = np.zeros(len(at), bool)
            if self.kind == "byte":
                units = [" " + u if b == _AFTER_BLANK else u for u, b in zip(units, before[at].tolist())]
                feed = before[at] == _AFTER_FEED
            self._learn(new, units, feed)
            rows[missing] = self.slots.find(keys[missing])
        sizes = self.sizes[rows]
        stops = np.cumsum(sizes, dtype=np.int64)
        total = int(stops[-1]) if len(stops) else 0
        ids = self.ids[np.repeat(self.starts[rows] - (stops - sizes), sizes) + np.arange(total)]
        own = np.bincount(of, sizes, n).astype(np.int64)
        if whole.any():
            raw = data.tobytes()
            cuts = np.split(ids, np.cumsum(own)[:-1])
            for k in np.flatnonzero(whole).tolist():
                cuts[k] = np.array(self._library([raw[texts[k]:texts[k + 1]].decode()])[0], np.uint32)
                own[k] = len(cuts[k])
            ids = np.concatenate(cuts)
        return ids, own


def slices(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that a task holds the ids of few texts at once."""
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


@lru_cache(maxsize=4)
def encoder(path: str, kind: str) -> Encoder:
    """One encoder per Python worker, kept between batches and tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, kind)
