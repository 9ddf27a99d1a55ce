"""Token-ID output in directly addressable codes (operator 2).

The ids of all documents, in ascending ``doc_id`` order, are stored in
segments.  A segment splits each id into 8-bit chunks: level 0 holds the low
chunk of every id, level k the next chunk of those ids that go on.  Each level
has a bitmap with one bit per entry (does the id go on?) and a rank directory
(set bits before every 512th entry), so the token at any place is found by a
few lookups, without decoding its neighbours.

The file format is Parquet with one segment per row (columns of ``SEGMENT``);
Spark's writer commits it, so it works on any store and survives lost
executors.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countwise.llm.frames import pick
from countwise.llm.tokenizing import encoder, slices

CHUNK_BITS = 8
RANK_EVERY = 512
#: A segment is closed once it has so many tokens; a document is never split.
SEGMENT_TOKENS = 1 << 20

SEGMENT = (
    "part INT, seq INT, start BIGINT, n_tokens BIGINT, doc_id ARRAY<BIGINT>, doc_tokens ARRAY<BIGINT>, "
    "chunks ARRAY<BINARY>, bitmaps ARRAY<BINARY>, ranks ARRAY<BINARY>"
)
_ARROW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_id", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ("chunks", pa.list_(pa.binary())), ("bitmaps", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
])


def encode_codes(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """(chunks, bitmaps, ranks) of the levels of ``ids`` (unsigned, up to 32 bits)."""
    chunks, bitmaps, ranks = [], [], []
    rest = np.asarray(ids, np.uint32)
    while True:
        goes_on = rest >> CHUNK_BITS
        more = goes_on > 0
        before = np.append(0, np.cumsum(more))[:-1][::RANK_EVERY]
        chunks.append((rest & 0xFF).astype(np.uint8).tobytes())
        bitmaps.append(np.packbits(more, bitorder="little").tobytes())
        ranks.append(before.astype("<u4").tobytes())
        rest = goes_on[more]
        if not len(rest):
            return chunks, bitmaps, ranks


def decode_codes(chunks: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment, in order."""
    above = np.zeros(0, np.uint32)
    for chunk, bitmap in zip(reversed(chunks), reversed(bitmaps)):
        low = np.frombuffer(chunk, np.uint8).astype(np.uint32)
        more = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(low), bitorder="little").astype(bool)
        low[more] |= above << CHUNK_BITS
        above = low
    return above


def access(chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes], i: int) -> int:
    """The id at place ``i`` of a segment, by one lookup per level."""
    value = 0
    for level, (chunk, bitmap, rank) in enumerate(zip(chunks, bitmaps, ranks)):
        value |= chunk[i] << (CHUNK_BITS * level)
        if not bitmap[i >> 3] >> (i & 7) & 1:
            break
        block = i // RANK_EVERY
        inside = int.from_bytes(bitmap[block * RANK_EVERY // 8:i // 8 + 1], "little") & ((1 << (i - block * RANK_EVERY)) - 1)
        i = int.from_bytes(rank[4 * block:4 * block + 4], "little") + inside.bit_count()
    return value


def _segments(tokenizer: str, kind: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, start, held, docs, ids
            row = dict(part=part, seq=seq, start=start, n_tokens=held, doc_id=docs, doc_tokens=[len(x) for x in ids])
            row["chunks"], row["bitmaps"], row["ranks"] = encode_codes(np.concatenate(ids))
            seq, start, held, docs, ids = seq + 1, start + held, 0, [], []
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in chain.from_iterable(map(slices, batches)):
            flat, offsets = encoder(tokenizer, kind).encode(batch.column(1))
            for doc, lo, hi in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                docs.append(doc)
                ids.append(np.append(flat[lo:hi], np.uint32(end_id)))
                held += hi - lo + 1
                if held >= SEGMENT_TOKENS:
                    yield flush()
        if docs:
            yield flush()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, kind: str = "word", end_id: int = 1) -> None:
    """Encode ``docs`` (doc_id, text) and write the ids to ``path``.

    Ascending ``doc_id`` (null first, ties by a hash of the text; every row is
    a document, repeated rows too); a null or empty text has only ``end_id``.
    Other columns are ignored; an empty table gives an empty folder of the
    format.  Rows are dealt out by ranges of that order, so each task writes
    one run of it, and many rows without an id are still spread.
    """
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    order = ["doc_id", F.xxhash64("text")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
         .mapInArrow(_segments(tokenizer, kind, end_id), SEGMENT)
         .write.parquet(path))


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_codes(row["chunks"], row["bitmaps"]).astype("<u4")
            sizes = np.array(row["doc_tokens"], np.int64)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([row["part"]] * len(sizes), pa.int32()),
                "doc_id": pa.array(row["doc_id"], pa.int64()),
                "inside": pa.array(row["start"] + ends - sizes),
                "n_tokens": pa.array(sizes),
                "ids_crc32": pa.array([zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends, sizes)], pa.int64()),
            })


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    Every id is decoded from the files.  The driver sees one total per file
    part (as many as the writer had tasks), never one per document.
    """
    files = spark.read.schema(SEGMENT).parquet(path)
    totals = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, bases = 0, []
    for part, n in totals:
        bases.append((part, before))
        before += n
    base = spark.createDataFrame(bases, "part INT, before BIGINT")
    rows = files.select("part", "start", "doc_id", "doc_tokens", "chunks", "bitmaps").mapInArrow(
        _decoded, "part INT, doc_id BIGINT, inside BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
    return rows.join(base, "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_at(spark: SparkSession, path: str, place: int) -> int | None:
    """The id at ``place`` of the whole sequence, from one segment's codes."""
    files = spark.read.schema(SEGMENT).parquet(path)
    for part, n in sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        if place < n:
            row = files.filter((F.col("part") == part) & (F.col("start") <= place)
                               & (F.col("start") + F.col("n_tokens") > place)).first()
            return access(row["chunks"], row["bitmaps"], row["ranks"], place - row["start"])
        place -= n
    return None
