"""Token counts with overlap resynchronisation for huge documents (operator 12).

1. A text of at most ``chunk`` characters is counted as a whole, by the library
   or from the ids that it gave for the text's units before.
2. A longer one is cut into chunks that overlap the one before them.  The
   chunks of a document are rows of their own, dealt over all tasks, and each
   is encoded with offsets.
3. Neighbouring chunks are spliced at a common boundary of pre-tokens inside
   their overlap.  A pre-token is decided from its first character and what
   follows, never from what stands before; so where both chunks begin a
   pre-token, the later one goes on as the whole text would.  The earlier one's
   boundary is the whole text's if its end is far enough away: nothing looks
   further ahead than the longest added token and three characters.
4. A document with a pair of neighbours that have no such boundary is encoded
   again with four times the overlap, and longer chunks to match, until all its
   chunks are spliced; at the latest it is one chunk.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countwise.llm.frames import pick, stored
from countwise.llm.tokenizing import encoder, slices

#: Characters of a chunk, without its overlap, and of the overlap.
CHUNK = 32_768
OVERLAP = 1_024
WIDEN = 4
#: Texts counted at once.
SLICE_ROWS = 1024
#: Tokens beyond which a document is over the limit.
LIMIT = 512
#: How far the pre-tokens of a byte-level file look ahead: a contraction, or
#: the last of several blanks and what follows it.
LOOK_AHEAD = 3


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """The library's tokenizer and the characters at a chunk's end whose boundaries prove nothing."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(path, encoding="utf-8") as f:
        parts = json.load(f)
    splitter = parts["pre_tokenizer"] or {}
    if parts["normalizer"] or splitter.get("type") != "ByteLevel" or not splitter.get("use_regex", True) or splitter.get("add_prefix_space"):
        raise ValueError(f"chunks can only be spliced for byte-level files without a normalizer: {path}")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in parts["added_tokens"]):
        raise ValueError(f"chunks cannot be spliced next to added tokens that take in their neighbours: {path}")
    parts["post_processor"] = None  # it would only trim the offsets
    longest = max((len(t["content"]) for t in parts["added_tokens"]), default=0)
    return Tokenizer.from_str(json.dumps(parts)), longest + LOOK_AHEAD + 1


def _count_short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, SLICE_ROWS):
                _, ends = encoder(path, "byte").encode(some.column(2))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(np.diff(ends), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                last = max(0, (len(text) - 1) // chunk)
                for k in range(last + 1):
                    piece = text[max(0, k * chunk - overlap):(k + 1) * chunk]
                    yield pa.RecordBatch.from_pydict(
                        {"h1": [batch.column(0)[i].as_py()], "h2": [batch.column(1)[i].as_py()], "k": [k], "last": [k == last], "piece": [piece]},
                        schema=pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("k", pa.int64()), ("last", pa.bool_()), ("piece", pa.string())]))

    return run


def boundaries(tokenizer, piece: str) -> tuple[list[int], list[int], int]:
    """(first characters of the pre-tokens, tokens before each, all tokens)."""
    encoding = tokenizer.encode(piece, add_special_tokens=False)
    words, offsets = encoding.word_ids, encoding.offsets
    first = [i for i in range(len(words)) if i == 0 or words[i] != words[i - 1]]
    return [offsets[i][0] for i in first], first, len(words)


_SIDE = "ARRAY<STRUCT<at: BIGINT, before: BIGINT>>"
_SIDE_TYPE = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))


def _encode(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, margin = _tokenizer(path)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                k, last, piece = (one.column(c)[0].as_py() for c in (2, 3, 4))
                first = max(0, k * chunk - overlap)
                at, before, n = boundaries(tokenizer, piece)
                places = [{"at": first + a, "before": b} for a, b in zip(at, before)]
                end = (k + 1) * chunk
                head = [p for p in places if p["at"] < k * chunk] if k else []
                tail = [] if last else [p for p in places if end - overlap <= p["at"] <= end - margin]
                yield pa.RecordBatch.from_arrays(
                    [one.column(0), one.column(1), one.column(2), one.column(3), pa.array([n], pa.int64()), pa.array([head], _SIDE_TYPE), pa.array([tail], _SIDE_TYPE)],
                    ["h1", "h2", "k", "last", "n", "head", "tail"])

    return run


def _spliced(encoded: DataFrame) -> DataFrame:
    """(h1, h2, n_tokens) of every document; n_tokens is null where two neighbours have no common boundary.

    With q the common boundary of chunks k and k + 1, the document has all
    tokens of its last chunk, and for each pair of neighbours those before q in
    k less those before q in k + 1.
    """
    tails = encoded.filter(~F.col("last")).select("h1", "h2", "k", "tail")
    heads = encoded.filter("k > 0").select("h1", "h2", (F.col("k") - 1).alias("k"), "head")
    place = F.array_max(F.array_intersect("tail.at", "head.at"))

    def before(side: str):
        return F.element_at(F.map_from_entries(side), F.col("place"))

    pairs = (tails.join(heads, ["h1", "h2", "k"]).withColumn("place", place)
             .select("h1", "h2", F.when(F.col("place").isNotNull(), before("tail") - before("head")).alias("n")))
    parts = pairs.union(encoded.filter("last").select("h1", "h2", "n"))
    return parts.groupBy("h1", "h2").agg(F.when(F.count("*") == F.count("n"), F.sum("n")).alias("n_tokens"))


def _count_long(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(h1, h2, n_tokens) of the texts (h1, h2, text); equal texts are encoded once."""
    done = None
    while True:
        pieces = texts.mapInArrow(_cut(chunk, overlap), "h1 BIGINT, h2 BIGINT, k BIGINT, last BOOLEAN, piece STRING")
        pieces = pieces.groupBy("h1", "h2", "k", "last").agg(F.first("piece").alias("piece"))
        encoded = stored(pieces.mapInArrow(
            _encode(path, chunk, overlap), f"h1 BIGINT, h2 BIGINT, k BIGINT, last BOOLEAN, n BIGINT, head {_SIDE}, tail {_SIDE}"), "token-chunks")
        counts = stored(_spliced(encoded), "token-counts")
        ready, open_ = counts.filter("n_tokens IS NOT NULL"), counts.filter("n_tokens IS NULL")
        done = ready if done is None else done.union(ready)
        if open_.isEmpty():
            return done
        overlap *= WIDEN
        chunk = max(chunk, WIDEN * overlap)
        texts = texts.join(open_.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "text")


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text).

    ``path`` is a byte-level file of the tokenizers library.  Strings of added
    tokens inside a text count as the library's default has them.  A null text
    counts as empty: no byte, no token.  Rows are counted one by one, also
    those with a null or repeated doc_id.  Other columns are ignored.
    """
    _, margin = _tokenizer(path)
    if overlap <= margin or chunk < 2 * overlap:
        raise ValueError(f"an overlap must be longer than {margin} characters, and a chunk than two overlaps")
    rows = pick(docs, doc_id="doc_id", text="text").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    long = F.coalesce(F.char_length("text"), F.lit(0)) > chunk
    kind = dict(rows.dtypes)["doc_id"]
    counted = rows.filter(~long).select("doc_id", "n_bytes", "text").mapInArrow(
        _count_short(path), f"doc_id {kind}, n_bytes BIGINT, n_tokens BIGINT")
    huge = rows.filter(long).select("doc_id", "n_bytes", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("text"), "text").alias("h2"), "text")
    if not huge.isEmpty():
        counts = _count_long(huge.select("h1", "h2", "text"), path, chunk, overlap)
        counted = counted.union(huge.select("doc_id", "n_bytes", "h1", "h2").join(counts, ["h1", "h2"]).select("doc_id", "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
