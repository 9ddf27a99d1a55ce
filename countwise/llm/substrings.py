"""Substring dedup with fixed-block anchors (operator 10).

A window is ``window`` consecutive words of a text.  Words covered by a window
that also starts anywhere else in the collection are removed.

Every window holds exactly one block of (window + 1) / 2 words that starts at a
multiple of that length.  These non-overlapping blocks are indexed and probed
by every rolling run of the same length; a block met nowhere else rules out
all windows around it.  Windows around the blocks that were met are hashed
whole and counted the same way, and runs of repeated windows make up the
maximal exact repeats.

Texts are dealt to chunks.  A chunk sends each distinct hash once to the
bucket of its range of values, packed with its neighbours, so a passage that
millions of texts share arrives once per chunk; buckets answer with the hashes
that other chunks hold as well.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countwise.llm.frames import pick
from countwise.llm.word_hashes import column_words, places, run_hashes

WINDOW_WORDS = 35
#: Bytes of text per chunk, and words per bucket, on average.
CHUNK_BYTES = 1 << 21
BUCKET_WORDS = 1 << 20
#: Bytes of text per word assumed when the number of buckets is chosen.
WORD_BYTES = 6

_MESSAGE = "bucket INT, chunk INT, n_owned INT, low BINARY, high BINARY"
_ANSWER = "chunk INT, low BINARY, high BINARY"
_MESSAGE_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("n_owned", pa.int32()), ("low", pa.binary()), ("high", pa.binary())])
_ANSWER_ARROW = pa.schema([("chunk", pa.int32()), ("low", pa.binary()), ("high", pa.binary())])


def _pack(values: np.ndarray, high_bytes: int) -> tuple[bytes, bytes]:
    """The low 32 bits, and ``high_bytes`` more, of 64-bit values."""
    high = (values >> np.uint64(32)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :high_bytes]
    return values.astype("<u4").tobytes(), high.tobytes()


def _unpack(low: bytes, high: bytes) -> np.ndarray:
    values = np.frombuffer(low, "<u4").astype(np.uint64)
    if len(values):
        part = np.frombuffer(high, np.uint8).reshape(len(values), -1)
        for k in range(part.shape[1]):
            values |= part[:, k].astype(np.uint64) << np.uint64(32 + 8 * k)
    return values


def _among(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted ``found``."""
    if not len(found):
        return np.zeros(len(values), bool)
    at = np.searchsorted(found, values)
    at[at == len(found)] = 0
    return found[at] == values


class _Round:
    """One exchange of hashes: how they are cut to size and dealt to buckets."""

    def __init__(self, buckets: int, high_bytes: int):
        self.buckets, self.high_bytes = buckets, high_bytes
        self.mask = np.uint64((1 << (32 + 8 * high_bytes)) - 1)

    def cut(self, hashes: np.ndarray) -> np.ndarray:
        """The part of each hash that is sent."""
        return hashes & self.mask

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(40)) % np.uint64(self.buckets)).astype(np.int64)

    def messages(self, chunk: int, owned: np.ndarray, others: np.ndarray) -> pa.Table:
        """A row per bucket: the distinct hashes the chunk asks about, then those it only shows."""
        owned = np.unique(owned)
        others = np.unique(others)
        others = others[~_among(others, owned)]
        rows: dict[int, list[np.ndarray]] = {}
        for k, values in enumerate((owned, others)):
            at = self.bucket(values)
            order = np.argsort(at, kind="stable")
            cuts = np.flatnonzero(np.diff(at[order])) + 1
            for part in np.split(order, cuts) if len(order) else []:
                rows.setdefault(int(at[part[0]]), [values[:0], values[:0]])[k] = self.cut(values[part])
        packed = [(b, chunk, len(o), *_pack(np.concatenate([o, x]), self.high_bytes)) for b, (o, x) in rows.items()]
        columns = list(zip(*packed)) if packed else [[]] * 5
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _MESSAGE_ARROW)], schema=_MESSAGE_ARROW)

    def meet(self, key: tuple, rows: pa.Table) -> pa.Table:
        """Answer each chunk with those of its asked hashes that another chunk holds."""
        owned, chunks, parts = rows["n_owned"].to_pylist(), rows["chunk"].to_pylist(), []
        for low, high in zip(rows["low"], rows["high"]):
            parts.append(_unpack(low.as_buffer(), high.as_buffer()))
        every = np.sort(np.concatenate(parts))
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        answers = []
        for n, chunk, part in zip(owned, chunks, parts):
            hit = part[:n][_among(part[:n], shared)]
            if len(hit):
                answers.append((chunk, *_pack(hit, self.high_bytes)))
        columns = list(zip(*answers)) if answers else [[]] * 3
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ANSWER_ARROW)], schema=_ANSWER_ARROW)

    def answered(self, rows: pa.Table) -> np.ndarray:
        parts = [_unpack(low.as_buffer(), high.as_buffer()) for low, high in zip(rows["low"], rows["high"])]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


class _Repeats:
    """The work of a chunk, step by step; each step starts from the texts."""

    def __init__(self, window: int, blocks: _Round, windows: _Round):
        self.window, self.block = window, (window + 1) // 2
        self.blocks, self.windows = blocks, windows

    def _read(self, texts: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word hashes, text offsets, places of rolling runs, which of them are blocks)."""
        words, offsets = column_words(texts["text"])
        at, counts = places(offsets, self.block)
        long_enough = np.repeat(np.diff(offsets) >= self.window, counts)
        at, inside = at[long_enough], (at - np.repeat(offsets[:-1], counts))[long_enough]
        return words, offsets, at, inside % self.block == 0

    def probe(self, key: tuple, texts: pa.Table) -> pa.Table:
        words, _, at, owned = self._read(texts)
        hashes = run_hashes(words, self.block)[at] if len(at) else words[:0]
        return self.blocks.messages(int(key[0].as_py()), hashes[owned], hashes[~owned])

    def _candidates(self, texts: pa.Table, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text offsets, places, hashes) of the windows whose block is met elsewhere."""
        words, offsets, at, owned = self._read(texts)
        if not len(at):
            return offsets, at, words[:0]
        hashes = run_hashes(words, self.block)[at]
        mine = hashes[owned]
        ordered = np.sort(hashes)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        met = _among(self.blocks.cut(mine), self.blocks.answered(answers)) | _among(mine, twice)
        hit = np.zeros(len(words) + self.block, bool)
        hit[at[owned]] = met
        starts, counts = places(offsets, self.window)
        first = np.repeat(offsets[:-1], counts)
        block_at = first + -(-(starts - first) // self.block) * self.block
        starts = starts[hit[block_at]]
        return offsets, starts, run_hashes(words, self.window)[starts]

    def show(self, key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return self.windows.messages(0, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        _, _, hashes = self._candidates(texts, answers)
        values, counts = np.unique(hashes, return_counts=True)
        return self.windows.messages(int(texts["chunk"][0].as_py()), values[counts == 1], values[counts > 1])

    def cover(self, texts: pa.Table, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """(text offsets, removed words)."""
        blocks = answers.filter(pc.equal(answers["step"], 1))
        windows = answers.filter(pc.equal(answers["step"], 2))
        offsets, starts, hashes = self._candidates(texts, blocks)
        ordered = np.sort(hashes)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        again = starts[_among(hashes, twice) | _among(hashes, self.windows.answered(windows))]
        edges = np.zeros(int(offsets[-1]) + 1, np.int64)
        np.add.at(edges, again, 1)
        np.add.at(edges, again + self.window, -1)
        return offsets, np.cumsum(edges)[:-1] > 0

    def remove(self, key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
        offsets, gone = self.cover(texts, answers)
        kept = []
        for text, lo, hi in zip(texts["text"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            words = (text or "").encode().split()
            own = gone[lo:hi]
            kept.append(b" ".join([w for w, g in zip(words, own.tolist()) if not g] if own.any() else words))
        removed = np.append(0, np.cumsum(gone))[offsets]
        return pa.table([
            texts["doc_id"], pa.array(np.diff(offsets)), pa.array(np.diff(removed)), pa.array(kept, pa.binary()).cast(pa.string()),
        ], schema=schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text for every row of ``docs`` (doc_id, text).

    Words are runs of other characters than blank and 0x09-0x0D, compared as
    they are; kept words are joined by one blank.  All windows are judged on
    the input.  A null, empty or short text loses nothing; repeated rows are
    texts of their own and so repeat each other; null ids stay null.  Other
    columns are ignored.
    """
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(n_bytes / CHUNK_BYTES))
    buckets = max(1, math.ceil(n_bytes / WORD_BYTES / BUCKET_WORDS))
    steps = _Repeats(window, _Round(buckets, 1), _Round(buckets, 4))

    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    texts = chunked.groupBy("chunk")
    asked = texts.applyInArrow(lambda key, t: steps.probe(key, t), _MESSAGE)
    met = asked.groupBy("bucket").applyInArrow(lambda key, t: steps.blocks.meet(key, t), _ANSWER)
    shown = texts.cogroup(met.groupBy("chunk")).applyInArrow(lambda key, t, a: steps.show(key, t, a), _MESSAGE)
    again = shown.groupBy("bucket").applyInArrow(lambda key, t: steps.windows.meet(key, t), _ANSWER)
    answers = met.withColumn("step", F.lit(1)).union(again.withColumn("step", F.lit(2)))
    return texts.cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda key, t, a: steps.remove(key, t, a), "doc_id BIGINT, n_words BIGINT, n_removed BIGINT, kept_text STRING")
