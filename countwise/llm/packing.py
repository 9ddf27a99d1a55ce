"""Best-fit packing by the sum of squares (operator 4).

Documents are encoded, cut into pieces of at most ``capacity`` tokens and
placed in sequences, long pieces first.  A piece goes to the open sequence for
which the sum over all residual gaps of (open sequences with that gap) squared
becomes smallest; ties go to the smaller remaining gap, and a new sequence is
opened when none has room.  Keeping the counts level keeps a partner at hand
for every length.

Pieces are dealt to groups by hash and each group packs its own share; the
number of groups follows the number of documents, so a task's share stays the
same at any size.  Each group leaves a few sequences part-filled.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countwise.llm.frames import pick
from countwise.llm.tokenizing import encoder, slices

CAPACITY = 1024
#: Pieces per packing group on average.
GROUP_PIECES = 32_768
TAKEN = np.iinfo(np.int64).max
PIECE = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Piece lengths of a document of n tokens: full ones, after a shorter first one if any is left."""
    rest = n % capacity
    return [rest] * (rest > 0) + [capacity] * (n // capacity)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each piece, offset in it) for pieces taken in the given order."""
    counts = np.zeros(capacity + 1, np.int64)  # open bins by residual gap
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    gap_of: list[int] = []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, s in enumerate(lengths.tolist()):
        if s == capacity:
            bins[i], offsets[i] = len(gap_of), 0
            gap_of.append(0)
            continue
        # Change of the sum if an open bin of gap g >= s takes the piece, by g - s.
        change = 2 * (counts[:capacity - s + 1] - counts[s:] + 1)
        change[0] = 1 - 2 * counts[s]
        change[counts[s:] == 0] = TAKEN
        left = int(change.argmin())
        if change[left] == TAKEN:  # nothing open has room
            left = capacity - s
        g = left + s
        if g == capacity:
            b = len(gap_of)
            gap_of.append(g)
        else:
            b = open_bins[g].pop()
            counts[g] -= 1
        bins[i], offsets[i] = b, capacity - g
        gap_of[b] = left
        if left:
            open_bins[left].append(b)
            counts[left] += 1
    return bins, offsets


def _pieces(tokenizer: str, kind: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            flat, offsets = encoder(tokenizer, kind).encode(batch.column(1))
            rows: list[tuple] = []
            for doc, lo, hi in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                x, start = np.append(flat[lo:hi], np.uint32(end_id)).astype("<u4"), 0
                for piece, n in enumerate(cut_lengths(len(x), capacity)):
                    own = x[start:start + n]
                    rows.append((doc, piece, start, n, zlib.crc32(own.tobytes()), own.tolist() if with_ids else None))
                    start += n
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            columns = list(zip(*rows)) or [()] * 6
            n = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:n], kinds)], names[:n])

    return run


def pieces(docs: DataFrame, tokenizer: str, kind: str = "byte", end_id: int = 2,
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every document of ``docs`` (doc_id, text); null text counts as empty."""
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.mapInArrow(_pieces(tokenizer, kind, end_id, capacity, with_ids),
                           PIECE + (", ids ARRAY<INT>" if with_ids else ""))


def _place(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "deal", "doc_id", "piece", "ids_crc32"], ascending=[False] + [True] * 4, kind="stable")
        rows["bin"], rows["offset"] = sum_of_squares(rows["length"].to_numpy(), capacity)
        rows["bin"] += int(key[0]) << 40
        return rows.drop(columns=["deal", "group"])

    return run


def pack(parts: DataFrame, n_pieces: int, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to the rows of ``pieces``; other columns stay.

    Every row is placed, repeated rows and null ids too; an empty table stays
    empty.  A sequence is filled without gaps from offset 0.
    """
    groups = max(1, math.ceil(n_pieces / GROUP_PIECES))
    deal = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    dealt = parts.withColumn("deal", deal).withColumn("group", F.pmod("deal", F.lit(groups)).cast("int"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    placed = dealt.groupBy("group").applyInPandas(_place(capacity), schema + ", bin BIGINT, offset BIGINT")
    return placed.withColumnRenamed("bin", "sequence_id")


def pack_documents(docs: DataFrame, tokenizer: str, kind: str = "byte", end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    size = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n_bytes")).first()
    # A token takes a byte at least: no more pieces than these.
    return pack(pieces(docs, tokenizer, kind, end_id, capacity), size.n + size.n_bytes // capacity, capacity)


def assemble(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from packed pieces with their ids: sequence_id, ids (at most ``capacity``)."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(own, lambda x: x["ids"])).alias("ids"))
