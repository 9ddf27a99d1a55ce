"""Ranked lexical search over bit-sliced Bloom signatures (operator 11).

1. Index, one pass over all documents: documents of about the same size make up
   a block.  A document's signature has an entry for each of its terms and each
   level of occurrences that the term reaches; slice b of a block is the bitmap
   of the documents whose signature has bit b.  The pass also counts terms and
   the documents that hold each one.
2. Upper bounds: the bitmaps of an entry's slices, joined by AND, are the
   documents that may hold the term so often; none that does is missing.  The
   next level caps its occurrences.  A query's weighted sum over such terms
   bounds a document's score from above.
3. The documents of the highest bounds are scored exactly from their texts; the
   last of an item's best scores is its threshold.
4. All documents whose bound reaches the threshold are scored exactly, and the
   best of them are the answer.  There is no limit on their number.

Terms are compared by 64-bit hashes; two of n terms share one with a chance of
about n^2 / 2^65.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from countwise.llm.frames import pick, stored
from countwise.llm.word_hashes import mix, span_hashes, text_buffer

TOP = 20
#: Bits of a signature per entry at least, and slices that an entry sets.
BITS = 12
PROBES = 3
#: Documents and bytes of a block.
BLOCK_DOCS = 4096
BLOCK_BYTES = 1 << 21
#: Bytes of text handled at once, and distinct terms counted before they are handed on.
SLICE_BYTES = 1 << 20
COUNTED = 1 << 18
#: Items and terms searched for in one go.
QUERY_ITEMS = 512
QUERY_TERMS = 1 << 16
#: Terms of an index block looked up at once.
LOOKED_UP = 2048
#: Terms in more items than this are summed as a matrix product.
SHARED = 8
#: Documents by bound, for each of an item's places, whose scores give the threshold.
FIRST = 2
#: (document, items) rows that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 17
#: Occurrences from which a term has the next entry: 1, 2, 3, 4, 6, 8, 12, ..
LEVELS = np.array([1] + sorted([1 << k for k in range(1, 31)] + [3 << k for k in range(30)]), np.int64)

_TERM = np.zeros(256, bool)
_TERM[0x80:] = _TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = True


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every term, number of its text) of a string column."""
    data, texts = text_buffer(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    term = _TERM[data]
    opens, closes = term.copy(), term.copy()
    opens[1:] &= ~term[:-1]
    closes[:-1] &= ~term[1:]
    inner = texts[(texts > 0) & (texts < len(data))]
    opens[inner], closes[inner - 1] = term[inner], term[inner - 1]
    starts = np.flatnonzero(opens)
    return span_hashes(data, starts, np.flatnonzero(closes) + 1, fold_case=True), np.searchsorted(texts, starts, "right") - 1


def _counted(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences), in order of text."""
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1]))) if len(hashes) else np.zeros(0, np.int64)
    return texts[new], hashes[new], np.diff(np.append(new, len(hashes)))


def _slots(terms: np.ndarray, level: np.ndarray | int, width: int) -> np.ndarray:
    """The slices of the terms' entries of a level: PROBES rows."""
    with np.errstate(over="ignore"):
        h = mix(terms + np.asarray(level).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    return np.array([(low + np.uint64(i) * high) % np.uint64(width) for i in range(PROBES)], np.int64)


class _Block:
    """Documents of one size class that wait for their block to be full."""

    def __init__(self, entries: int):
        self.width = BITS * entries
        self.room = max(8, min(BLOCK_DOCS, BLOCK_BYTES * 8 // self.width // 8 * 8))
        self.ids, self.sizes, self.parts = [], [], []

    def add(self, doc_id: int | None, size: int, terms: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((terms, np.searchsorted(LEVELS, counts, "right")))
        self.ids.append(doc_id)
        self.sizes.append(size)

    def slices(self) -> bytes:
        bits = np.zeros((self.width, -(-len(self.ids) // 8) * 8), bool)
        for column, (terms, levels) in enumerate(self.parts):
            ends = np.cumsum(levels)
            level = np.arange(int(ends[-1])) - np.repeat(ends - levels, levels)
            bits[_slots(np.repeat(terms, levels), level, self.width), column] = True
        return np.packbits(bits, axis=1).tobytes()


_INDEX = pa.schema([("width", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("slices", pa.binary()),
                    ("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def _block_row(block: _Block) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"width": [block.width], "doc_ids": [block.ids], "sizes": [block.sizes], "slices": [block.slices()], "terms": [None], "counts": [None]}, schema=_INDEX)


def _counts_row(terms: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"width": [None], "doc_ids": [None], "sizes": [None], "slices": [None],
                                       "terms": [terms.view(np.int64)], "counts": [counts]}, schema=_INDEX)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    terms, where = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
    return terms, np.bincount(where, np.concatenate([c for _, c in parts]), len(terms)).astype(np.int64)


def _text_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about SLICE_BYTES of text, one text at least."""
    ends = text_buffer(batch.column(column))[1][1:]
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        j = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield batch.slice(at, j - at)
        at = j


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, _Block] = {}
    seen, waiting = [], 0
    for batch in batches:
        for some in _text_slices(batch, 1):
            text, term, count = _counted(*terms_of(some.column(1)))
            ids = some.column(0).to_pylist()
            ends = np.searchsorted(text, np.arange(len(ids) + 1))
            for i, (lo, hi) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                if lo == hi:
                    continue
                entries = int(np.searchsorted(LEVELS, count[lo:hi], "right").sum())
                size = 1 << max(5, (entries - 1).bit_length())
                block = blocks.setdefault(size, _Block(size))
                block.add(ids[i], int(count[lo:hi].sum()), term[lo:hi].copy(), count[lo:hi].copy())
                if len(block.ids) == block.room:
                    yield _block_row(blocks.pop(size))
            seen.append(np.unique(term, return_counts=True))
            waiting += len(seen[-1][0])
            if waiting > COUNTED:
                seen = [_merged(seen)]
                waiting = len(seen[0][0])
                if waiting > COUNTED // 2:
                    yield _counts_row(*seen[0])
                    seen, waiting = [], 0
    for block in blocks.values():
        yield _block_row(block)
    if waiting:
        yield _counts_row(*_merged(seen))


@dataclass
class Query:
    """Some items' terms, without those that no document holds."""

    terms: np.ndarray  # sorted hashes
    weights: np.ndarray
    item: np.ndarray  # (item, term, repeats), in order of term
    term: np.ndarray
    repeats: np.ndarray
    n_items: int
    n_docs: int
    n_terms: int

    def damping(self, sizes: np.ndarray) -> np.ndarray:
        """12 times the m of documents with so many terms."""
        if not len(sizes) or int(sizes.max()) * 25 * self.n_docs < 1 << 62:
            return 12 * (75 + 25 * sizes * self.n_docs // self.n_terms)
        return np.array([12 * (75 + 25 * n * self.n_docs // self.n_terms) for n in sizes.tolist()], np.int64)


def _part(count: np.ndarray, damping: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * count // (1000 * count + damping)


def upper_bounds(query: Query, width: int, sizes: np.ndarray, slices: bytes) -> np.ndarray:
    """For each item (row) and document of a block no less than the score."""
    n = len(sizes)
    rows = np.frombuffer(slices, np.uint8).reshape(width, -1)
    damping = query.damping(sizes)
    first, last = (np.searchsorted(query.term, np.arange(len(query.terms)), side) for side in ("left", "right"))
    shared = last - first > SHARED
    out = np.zeros(query.n_items * n)
    for at in range(0, len(query.terms), LOOKED_UP):
        part = slice(at, at + LOOKED_UP)
        found = np.bitwise_and.reduce(rows[_slots(query.terms[part], 0, width)])
        term, doc = np.nonzero(np.unpackbits(found, axis=1, count=n))
        term += at
        level, left = np.zeros(len(term), np.int64), np.arange(len(term))
        for k in range(1, len(LEVELS)):
            slots = _slots(query.terms[term[left]], k, width)
            left = left[(rows[slots, doc[left] >> 3] >> (7 - (doc[left] & 7)).astype(np.uint8) & 1).all(axis=0)]
            if not len(left):
                break
            level[left] = k
        most = np.minimum(np.append(LEVELS[1:], LEVELS[-1] << 1)[level] - 1, sizes[doc])
        value = (query.weights[term] * _part(most, damping[doc])).astype(np.float64)
        few = np.flatnonzero(~shared[term])
        times = (last - first)[term[few]]
        entry = np.repeat(first[term[few]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        out += np.bincount(query.item[entry] * n + np.repeat(doc[few], times), np.repeat(value[few], times) * query.repeats[entry], len(out))
        common = np.flatnonzero(shared[part]) + at
        if len(common):
            many = np.flatnonzero(shared[term])
            values = np.zeros((len(common), n))
            values[np.searchsorted(common, term[many]), doc[many]] = value[many]
            own = np.isin(query.term, common)
            asked = np.zeros((query.n_items, len(common)))
            asked[query.item[own], np.searchsorted(common, query.term[own])] = query.repeats[own]
            out += (asked @ values).ravel()
    return out.reshape(query.n_items, n) * (1 + 1e-9)  # sums of doubles may have been rounded down


_PAIRS = pa.schema([("q", pa.int32()), ("doc_id", pa.int64()), ("bound", pa.float64())])


def _bounded(query: Query, count: int | None, thresholds: np.ndarray | None):
    """(q, doc_id, bound): of each block the ``count`` highest, or all that reach the item's threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                width, ids, sizes, slices = (batch.column(c)[i] for c in range(4))
                bounds = upper_bounds(query, width.as_py(), np.array(sizes.as_py(), np.int64), slices.as_py())
                if thresholds is not None:
                    keep = bounds >= thresholds[:, None]
                else:
                    keep = bounds > 0
                    if bounds.shape[1] > count:
                        keep &= bounds >= -np.partition(-bounds, count - 1, axis=1)[:, count - 1:count]
                q, doc = np.nonzero(keep)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), ids.values.take(pa.array(doc)), pa.array(bounds[q, doc])], schema=_PAIRS)

    return run


_SCORES = pa.schema([("q", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _scored(query: Query):
    """(q, doc_id, score) of rows (doc_id, text, items)."""
    start = np.searchsorted(np.sort(query.item), np.arange(query.n_items + 1))
    by_item = np.argsort(query.item, kind="stable")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _text_slices(batch, 1):
                hashes, texts = terms_of(some.column(1))
                damping = query.damping(np.bincount(texts, minlength=some.num_rows))
                place = np.minimum(np.searchsorted(query.terms, hashes), len(query.terms) - 1)
                hit = query.terms[place] == hashes
                text, term, count = _counted(place[hit].astype(np.uint64), texts[hit])
                value = query.weights[term.astype(np.int64)] * _part(count, damping[text])
                ends = np.searchsorted(text, np.arange(some.num_rows + 1))
                out, dense = [], np.zeros(len(query.terms), np.int64)
                for i, items in enumerate(some.column(2).to_pylist()):
                    own = term[ends[i]:ends[i + 1]].astype(np.int64)
                    dense[own] = value[ends[i]:ends[i + 1]]
                    for q in items:
                        entries = by_item[start[q]:start[q + 1]]
                        out.append((q, i, int((query.repeats[entries] * dense[query.term[entries]]).sum())))
                    dense[own] = 0
                q, row, score = (np.array(x, np.int64) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 3
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), some.column(0).take(pa.array(row)), pa.array(score)], schema=_SCORES)

    return run


def _exact(docs: DataFrame, pairs: DataFrame, query: Query) -> DataFrame:
    """(q, doc_id, score) of every row of ``docs`` for the items that ``pairs`` (q, doc_id) names with its doc_id."""
    wanted = stored(pairs.groupBy(F.col("doc_id").alias("named")).agg(F.collect_set("q").alias("items")), "search-candidates")
    few = wanted.count() <= BROADCAST_ROWS
    met = docs.join(F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("named")))
    return met.select("doc_id", "text", "items").mapInArrow(_scored(query), "q INT, doc_id BIGINT, score BIGINT")


def _ranked(scores: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.filter("score > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _query(terms: np.ndarray, items: np.ndarray, index: DataFrame, n_items: int, totals: Row) -> Query | None:
    """The query of some items' terms; None if no document holds any."""
    spark = index.sparkSession
    asked = spark.createDataFrame(pa.table({"term": np.unique(terms).view(np.int64)}))  # at most QUERY_TERMS and an item's
    held = index.filter("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("x.terms", "x.counts")
    held = held.join(F.broadcast(asked), F.col("terms") == F.col("term")).groupBy("term").agg(F.sum("counts").alias("df")).toPandas()
    if held.empty:
        return None
    known, df = held["term"].to_numpy().view(np.uint64), held["df"].to_numpy()
    order = np.argsort(known)
    known, df = known[order], df[order]
    weights = np.array([math.floor(1000 * math.log((2 * totals.n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    place = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    hit = known[place] == terms
    entry, repeats = np.unique(np.stack([place[hit], items[hit]]), axis=1, return_counts=True)
    return Query(known, weights, entry[1], entry[0], repeats, n_items, totals.n_docs, totals.n_terms)


def _item_blocks(items: DataFrame) -> Iterator[list[Row]]:
    """The items in order, some at a time."""
    some, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        some.append(row)
        size += len(row.text or "") // 2
        if len(some) >= QUERY_ITEMS or size >= QUERY_TERMS:
            yield some
            some, size = [], 0
    if some:
        yield some


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` rows of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    A null or empty text, or one without terms, finds nothing, is found by
    nothing and counts in no statistic.  Each row is a document, or an item, of
    its own, also with a repeated or null id; a null doc_id comes after equal
    scores.  Empty tables give no rows.  Other columns are ignored.
    """
    docs = pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("bigint"), "text")
    items = pick(items, item_id="item_id", text="text").select(F.col("item_id").cast("bigint"), "text")
    spark = docs.sparkSession
    index = stored(docs.mapInArrow(
        _index, "width BIGINT, doc_ids ARRAY<BIGINT>, sizes ARRAY<BIGINT>, slices BINARY, terms ARRAY<BIGINT>, counts ARRAY<BIGINT>"), "search-index")
    blocks = index.filter("slices IS NOT NULL").select("width", "doc_ids", "sizes", "slices")
    totals = blocks.agg(F.sum(F.size("doc_ids")).alias("n_docs"),
                        F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda s, x: s + x)).alias("n_terms")).first()
    found = spark.createDataFrame([], "item_id BIGINT, rank INT, doc_id BIGINT, score BIGINT")
    if not totals.n_docs:
        return found
    for some in _item_blocks(items):
        query = _query(*terms_of(pa.array([r.text for r in some], pa.large_string())), index, len(some), totals)
        if query is None:
            continue
        high = blocks.mapInArrow(_bounded(query, FIRST * top, None), "q INT, doc_id BIGINT, bound DOUBLE")
        order = Window.partitionBy("q").orderBy(F.desc("bound"), "doc_id")
        high = high.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= FIRST * top)
        known = _ranked(_exact(docs, high, query), top).filter(F.col("rank") == top).select("q", "score").collect()
        thresholds = np.ones(len(some))
        for row in known:
            thresholds[row.q] = row.score
        pairs = blocks.mapInArrow(_bounded(query, None, thresholds), "q INT, doc_id BIGINT, bound DOUBLE")
        names = spark.createDataFrame([(q, r.item_id) for q, r in enumerate(some)], "q INT, item_id BIGINT")
        ranked = _ranked(_exact(docs, pairs, query), top).join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")
        found = found.union(stored(ranked, "search-found"))
    return found
