"""MinHash near-duplicates by a signature-coordinate inverted join (operator 6).

1. Each text becomes its set of five-word shingles and a MinHash signature;
   equal sets are one class, represented by its smallest doc_id.
2. Representatives are posted under every (coordinate, value) of their
   signature.  The match threshold is the largest one that two sets just
   similar enough miss with a chance of at most ``MISS``.
3. Values met once can match nothing and are skipped; of the rest, rarest
   first, only a prefix must be posted: texts with as many values in common as
   the threshold share one of their first (values - threshold + 1).
4. Each list is first compared with its smallest member.  Only lists that
   still hold several groups are then merged pair by pair, between groups.
   Texts that collide often enough, directly or by way of others, make up a
   group of candidates.
5. Within a group all full sets are compared with the pivot, its smallest
   member.  Those linked with it are in one component already; only the others
   are compared with all, in tiles, and the links become components.  A task
   returns a spanning forest of its links, not the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countwise.llm.components import components, local_roots
from countwise.llm.frames import pick, sized, stored
from countwise.llm.word_hashes import column_words, mix, run_hashes

SHINGLE_WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
COORDINATES = 48
#: Chance that a pair of exactly the least similarity is missed.
MISS = 1e-6
#: Texts handled at once in a task.
SLICE_ROWS = 256
#: Candidates per tile, rows per group of tiles, and shingles counted at once.
TILE = 256
BUCKET_ROWS = 2048
COLUMNS = 8192
#: Rows of a partition of signatures, which are posted value by value.
CARD_ROWS = 1 << 13
#: Members of groups whose ids are broadcast to pick their texts; more are joined by a shuffle.
BROADCAST_MEMBERS = 1 << 17

_RNG = np.random.default_rng(6)
_FACTORS = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_COORDINATE_MASK = np.uint64(63)


def match_threshold(percent: int) -> int:
    """The least number of equal coordinates that a candidate pair must have."""
    p, t, tail = percent / 100, 0, (1 - percent / 100) ** COORDINATES
    while tail <= MISS and t < COORDINATES:
        t += 1
        tail += math.comb(COORDINATES, t) * p ** t * (1 - p) ** (COORDINATES - t)
    return max(1, t)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words, offsets = column_words(texts, fold_case=True)
    runs = run_hashes(words, SHINGLE_WORDS)
    out = []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if hi - lo >= SHINGLE_WORDS:
            out.append(np.unique(runs[lo:hi - SHINGLE_WORDS + 1]))
        elif hi > lo:
            out.append(run_hashes(words[lo:hi], hi - lo) ^ np.uint64(hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row per non-empty set: its least value under each coordinate's
    permutation, marked with the coordinate in the lowest bits."""
    flat = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets])[:-1]
    out = np.empty((len(sets), COORDINATES), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(COORDINATES):
            out[:, k] = np.minimum.reduceat(flat * _FACTORS[k] + _SHIFTS[k], first) & ~_COORDINATE_MASK | np.uint64(k)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            some = batch.slice(at, SLICE_ROWS)
            sets = shingle_sets(some.column(1))
            sizes = np.array([len(s) for s in sets], np.int64)
            full = [s for s in sets if len(s)]
            values = signatures(full).view(np.int64).ravel() if full else np.zeros(0, np.int64)
            with np.errstate(over="ignore"):
                keys = [np.array([mix(s ^ np.uint64(c)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for c in (1, 2)]
            offsets = np.append(0, np.cumsum((sizes > 0) * COORDINATES)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(sizes), pa.array(keys[0]), pa.array(keys[1]), pa.ListArray.from_arrays(offsets, values)],
                ["doc_id", "n_shingles", "key1", "key2", "tokens"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            some = batch.slice(at, SLICE_ROWS)
            sets = [s.tobytes() for s in shingle_sets(some.column(1))]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])


def shared_counts(x: list[np.ndarray], y: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of distinct sets, as a matrix; y None: among x."""
    every = x if y is None else x + y
    sizes = [len(s) for s in every]
    values, column, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    again = np.flatnonzero(times > 1)
    place = np.full(len(values), -1, np.int64)
    place[again] = np.arange(len(again))
    column = place[column]
    row, column = row[column >= 0], column[column >= 0]
    own, other = slice(None, len(x)), slice(None) if y is None else slice(len(x), None)
    out = np.zeros((len(x), len(x) if y is None else len(y)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, len(again), COLUMNS):
        lo, hi = np.searchsorted(column, (first, first + COLUMNS))
        part = np.zeros((len(sizes), min(COLUMNS, len(again) - first)), np.float32)
        part[row[lo:hi], column[lo:hi] - first] = 1
        out += part[own] @ part[other].T
    return out.astype(np.int64)


def _links_of(rows: list[dict], percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between two tiles of a group (or within one)."""
    low, high = rows[0]["low"], rows[0]["high"]
    if low == high:
        left = right = rows
    else:
        left, right = ([r for r in rows if r["tile"] == t] for t in (low, high))
    if not left or not right or len(rows) < 2:
        return
    x, y = ([np.frombuffer(r["shingles"], np.uint64) for r in side] for side in (left, right))
    common = shared_counts(x, None if low == high else y)
    sizes = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])
    i, j = np.nonzero(100 * common >= percent * (sizes - common))
    names = np.array([r["rep"] for r in (left if low == high else left + right)], np.int64)
    roots = local_roots(len(names), i, j if low == high else j + len(left))
    for k in np.flatnonzero(roots != np.arange(len(names))):
        yield int(names[roots[k]]), int(names[k])


def _compare(percent: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        groups: dict[tuple, list[dict]] = {}
        for r in table.to_pylist():
            groups.setdefault((r["cluster"], r["low"], r["high"]), []).append(r)
        found = [link for rows in groups.values() for link in _links_of(rows, percent)]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _like_pivot(percent: int):
    """Marks the members (rep, cluster, shingles, pivot) whose set is linked with their group's pivot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = []
            for own, other in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (own, other))
                n = 0
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    n = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                joined.append(100 * n >= percent * (len(x) + len(y) - n))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(joined, pa.bool_())], ["rep", "cluster", "joined"])

    return run


def _colliding(pairs: DataFrame, cards: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) that agree on at least ``matches`` coordinates."""
    x, y = (cards.select(F.col("rep").alias(s), F.col("tokens").alias("t" + s)) for s in "ab")
    return pairs.join(y, "b").join(x, "a").filter(F.size(F.array_intersect("ta", "tb")) >= matches).select("a", "b")


def _candidate_groups(classes: DataFrame, matches: int) -> DataFrame:
    """(node, component) of the texts that collide with others, but the smallest of each group."""
    n = classes.count()
    posted = classes.select("rep", F.explode("tokens").alias("token"))
    met = stored(sized(posted.groupBy("token").agg(F.count("*").alias("n_met")).filter("n_met > 1"), COORDINATES * n // 2), "minhash-values")
    own = posted.join(met, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n_met", "token"))).alias("own"))
    # Values that are met once match nothing: collisions are counted over the others.
    cards = stored(sized(own.filter(F.size("own") >= matches).select("rep", F.col("own.token").alias("tokens")), n, CARD_ROWS), "minhash-cards")
    n = cards.count()
    postings = cards.select("rep", F.explode(F.slice("tokens", F.lit(1), F.size("tokens") - (matches - 1))).alias("token"))
    n_postings = (COORDINATES - matches + 1) * n

    heads = stored(sized(postings.groupBy("token").agg(F.min("rep").alias("a")), n_postings), "minhash-heads")
    star = postings.join(heads, "token").filter("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    label = stored(sized(components(_colliding(star, cards, matches)), n), "minhash-labels")
    placed = postings.join(label, postings["rep"] == label["node"], "left").select(
        "rep", "token", F.coalesce("component", "rep").alias("label"))
    mixed = placed.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("token")
    rest = stored(sized(placed.join(mixed, "token", "left_semi").join(cards, "rep"), n_postings), "minhash-rest")
    x, y = (rest.select("token", *[F.col(c).alias(c + s) for c in ("rep", "label", "tokens")]) for s in ("_x", "_y"))
    cross = x.join(y, (x["token"] == y["token"]) & (F.col("label_x") < F.col("label_y"))
                   & (F.size(F.array_intersect("tokens_x", "tokens_y")) >= matches))
    more = stored(sized(cross.select(F.col("label_x").alias("a"), F.col("label_y").alias("b")).distinct(), n), "minhash-more")
    if more.isEmpty():
        return label
    higher = components(more).withColumnRenamed("node", "label")
    alone = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("label"))
    labels = label.select("node", F.col("component").alias("label")).union(alone)
    moved = labels.join(higher, "label", "left").select("node", F.coalesce("component", "label").alias("component"))
    return stored(sized(moved.filter("node <> component"), n), "minhash-labels")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    A null, empty or blank text has an empty set and links with nothing.  Rows
    that repeat a doc_id are one document: it links as any of them does, and
    each row is returned.  A row without a doc_id cannot be named by others: it
    has no component_id and is kept.  Other columns are ignored.
    """
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    sketches = stored(
        rows.mapInArrow(_sketch, "doc_id BIGINT, n_shingles BIGINT, key1 BIGINT, key2 BIGINT, tokens ARRAY<BIGINT>"), "minhash-sketches")
    key, matches = ["n_shingles", "key1", "key2"], match_threshold(percent)
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    n = sketches.count()
    classes = stored(
        sized(sketches.filter(linked).groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens")), n, CARD_ROWS), "minhash-classes")

    groups = _candidate_groups(classes.select("rep", "tokens"), matches)
    groups = groups.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    groups = groups.union(groups.select(F.col("cluster").alias("rep"), "cluster").distinct())
    members = groups.select(F.col("rep").alias("doc_id")).distinct()
    n_members = groups.count()
    few = n_members <= BROADCAST_MEMBERS
    sets = rows.join(F.broadcast(members) if few else members, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(
        _sets, "doc_id BIGINT, shingles BINARY").withColumnRenamed("doc_id", "rep")
    sets = stored(groups.join(sets, "rep"), "minhash-sets")
    pivots = sets.filter("rep = cluster").select("cluster", F.col("shingles").alias("pivot"))
    checked = stored(sized(sets.select("rep", "cluster", "shingles").join(pivots, "cluster").select("rep", "cluster", "shingles", "pivot").mapInArrow(
        _like_pivot(percent), "rep BIGINT, cluster BIGINT, joined BOOLEAN"), n_members, BUCKET_ROWS // 4), "minhash-pivots")

    # Members linked with the pivot are in one component already: only the others are compared, with all.
    tiles = stored(sized(checked.groupBy("cluster").agg(
        F.ceil(F.sum(F.col("joined").cast("int")) / TILE).cast("int").alias("done"),
        F.ceil(F.sum((~F.col("joined")).cast("int")) / TILE).cast("int").alias("open")).filter("open > 0"), n), "minhash-tiles")
    spot = F.xxhash64("rep", "cluster")
    tile = F.when(F.col("joined"), F.pmod(spot, F.col("done"))).otherwise(F.col("done") + F.pmod(spot, F.col("open"))).cast("int")
    first = F.when(F.col("joined"), F.col("done")).otherwise(F.lit(0))
    dealt = checked.distinct().join(tiles, "cluster").withColumn("tile", tile).select(
        "rep", "cluster", "tile", F.explode(F.sequence(first, F.col("done") + F.col("open") - 1)).alias("other"))
    dealt = stored(dealt.select("rep", "cluster", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")), "minhash-groups")
    buckets = max(1, math.ceil(dealt.count() / BUCKET_ROWS))
    together = dealt.join(sets.select("rep", "shingles"), "rep").withColumn("bucket", F.pmod(F.xxhash64("cluster", "low", "high"), F.lit(buckets)))
    links = together.groupBy("bucket").applyInArrow(_compare(percent), "a BIGINT, b BIGINT")
    links = links.union(checked.filter("joined").select(F.col("cluster").alias("a"), F.col("rep").alias("b")))

    found = stored(sized(components(links), n), "minhash-components")
    named = classes.select(*key, "rep").join(found, classes["rep"] == found["node"], "left").select(
        *key, F.coalesce("component", "rep").alias("component_id"))
    named = stored(sized(named, n), "minhash-named")
    out = sketches.filter(linked).select("doc_id", *key).join(named, key).select("doc_id", "n_shingles", "component_id")
    alone = sketches.filter(~linked).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
