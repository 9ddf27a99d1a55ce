"""Hard-negative mining by residue-number-system products (operator 13).

1. Vectors become whole numbers.  The largest squared length bounds every inner
   product, and so how many primes are needed.
2. All rows meet all anchors in tiles: a tile of rows goes once to every tile
   of anchors, so a task never holds more than two of them.
3. A tile product is exact: both matrices are reduced modulo several primes
   below 1024 and multiplied in float32, ``DIMS`` components at a time, so that
   every partial sum stays below 2^24; Chinese remaindering joins the residues
   into the signed score.
4. A first pass keeps each tile's best rows of the anchor's label and then the
   best of all; a second one keeps, for each of these positives, each tile's
   best rows of other labels inside the window of scores, and then the best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countwise.llm.frames import pick, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these hundredths of the positive's.
WINDOW = (50, 95)
#: Rows of a tile, and anchors of one that are scored at once.
TILE_ROWS = 4096
STEP = 128
#: The largest primes below 1024; fixed values.
PRIMES = (1021, 1019, 1013, 1009, 997, 991)
#: Components whose products of residues of at most 510 sum up below 2^24.
DIMS = 64


def primes_for(bound: float) -> list[int]:
    """The first primes, two at least, whose product exceeds twice ``bound``."""
    for k in range(2, len(PRIMES) + 1):
        if math.prod(PRIMES[:k]) > 2 * bound + 2:
            return list(PRIMES[:k])
    raise ValueError(f"scores may exceed {math.prod(PRIMES) // 2}: a squared length is {bound:.3g}")


def _residues(x: np.ndarray, p: int) -> np.ndarray:
    """The residues of least magnitude, in float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def exact_products(x: np.ndarray, y: np.ndarray, primes: list[int]) -> np.ndarray:
    """The inner products of the rows of two matrices of 64-bit integers."""
    total, modulus = None, 1
    for p in primes:
        own = np.zeros((len(x), len(y)), np.int64)
        for k in range(0, x.shape[1], DIMS):
            own += (_residues(x[:, k:k + DIMS], p) @ _residues(y[:, k:k + DIMS], p).T).astype(np.int64)
        own %= p
        if total is None:
            total = own
        else:
            total += modulus * ((own - total) % p * pow(modulus, -1, p) % p)
        modulus *= p
    return np.where(total > modulus // 2, total - modulus, total)


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """One row per list; missing components are zeros."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _best(scores: np.ndarray, allowed: np.ndarray, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of each row's best, second best, .. allowed score; of equal ones the first."""
    low = np.iinfo(np.int64).min
    left = np.where(allowed, scores, low)
    rows = np.arange(len(left))
    for _ in range(min(count, left.shape[1])):
        column = left.argmax(axis=1)
        some = left[rows, column] != low
        if not some.any():
            return
        yield rows[some], column[some]
        left[rows, column] = low


def _tiles(dims: int, primes: list[int], rows: pa.Table, anchors: pa.Table):
    """Scores of the anchors, some at a time, with the rows in order of vec_id."""
    rows = rows.sort_by("vec_id")
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    codes, asked = _matrix(rows["codes"], dims), _matrix(anchors["codes"], dims)
    for at in range(0, len(asked), STEP):
        some = anchors.slice(at, STEP)
        yield ids, labels, some, exact_products(asked[at:at + STEP], codes, primes)


def _table(columns: dict[str, list[np.ndarray]]) -> pa.Table:
    return pa.table({k: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for k, v in columns.items()})


def _positives(dims: int, primes: list[int], count: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {"anchor_id": [], "positive_id": [], "positive_score": []}
        for ids, labels, some, scores in _tiles(dims, primes, rows, anchors):
            own, label = some["vec_id"].to_numpy(), some["label"].to_numpy()
            for i, j in _best(scores, (labels == label[:, None]) & (ids != own[:, None]), count):
                out["anchor_id"].append(own[i])
                out["positive_id"].append(ids[j])
                out["positive_score"].append(scores[i, j])
        return _table(out)

    return run


def _negatives(dims: int, primes: list[int], count: int, window: tuple[int, int]):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {"anchor_id": [], "positive_id": [], "negative_id": [], "positive_score": [], "negative_score": []}
        for ids, labels, some, scores in _tiles(dims, primes, rows, anchors):
            own, other = some["vec_id"].to_numpy(), labels != some["label"].to_numpy()[:, None]
            given = some["positives"].to_pylist()
            for k in range(max(map(len, given), default=0)):
                has = np.flatnonzero([len(g) > k for g in given])
                positive = np.array([given[i][k]["positive_id"] for i in has], np.int64)
                score = np.array([given[i][k]["positive_score"] for i in has], np.int64)
                part = scores[has]
                # 100 * s >= low * p and 100 * s <= high * p, in whole numbers that cannot overflow
                least, most = _ceil(window[0], score), _floor(window[1], score)
                inside = other[has] & (part >= least[:, None]) & (part <= most[:, None])
                for i, j in _best(part, inside, count):
                    out["anchor_id"].append(own[has][i])
                    out["positive_id"].append(positive[i])
                    out["negative_id"].append(ids[j])
                    out["positive_score"].append(score[i])
                    out["negative_score"].append(part[i, j])
        return _table(out)

    return run


def _floor(percent: int, x: np.ndarray) -> np.ndarray:
    return x // 100 * percent + x % 100 * percent // 100


def _ceil(percent: int, x: np.ndarray) -> np.ndarray:
    return -_floor(percent, -x)


def _met(rows: DataFrame, anchors: DataFrame, n_tiles: int, n_anchor_tiles: int):
    """Every tile of rows with every tile of anchors."""
    x = rows.withColumn("anchor_tile", F.explode(F.sequence(F.lit(0), F.lit(n_anchor_tiles - 1))))
    y = anchors.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
    return x.groupBy("tile", "anchor_tile").cogroup(y.groupBy("tile", "anchor_tile"))


def mine(vectors: DataFrame, is_anchor: Column, scale: float = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, tile_rows: int = TILE_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``vectors`` (vec_id, label, embedding).

    ``is_anchor`` is a condition on vec_id.  Rows with a null vec_id, label or
    vector, or with a null or non-finite component, take no part.  Of rows that
    repeat a vec_id, the one with the smallest label and then the smallest
    vector takes part.  A shorter vector counts as filled up with zeros.  An
    empty table, or one without anchors, gives no rows.  Scores that could
    exceed 2^58 raise.  Other columns are ignored.
    """
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall(
        "x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = pick(vectors, vec_id="vec_id", label="label", x="embedding").select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("x").cast("array<double>")).filter(usable)
    rows = rows.select("vec_id", "label", F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v)).alias("codes"))
    rows = stored(rows.groupBy("vec_id").agg(F.min(F.struct("label", "codes")).alias("one")).select("vec_id", "one.*"), "negative-rows")
    square = F.aggregate("codes", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("anchors"), F.max(square).alias("bound"), F.max(F.size("codes")).alias("dims")).first()
    primes, dims = primes_for(1.0001 * (size.bound or 0)), size.dims or 0
    n_tiles, n_anchor_tiles = (max(1, math.ceil(n / tile_rows)) for n in (size.n, size.anchors))
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(n_tiles)).cast("int")
    tiled = rows.withColumn("tile", dealt)
    anchors = rows.filter(is_anchor).withColumn("anchor_tile", F.pmod(F.xxhash64(F.lit("anchor"), "vec_id"), F.lit(n_anchor_tiles)).cast("int"))

    near = _met(tiled, anchors, n_tiles, n_anchor_tiles).applyInArrow(
        _positives(dims, primes, positives), "anchor_id BIGINT, positive_id BIGINT, positive_score BIGINT")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    near = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = stored(anchors.join(near, "vec_id"), "negative-anchors")

    found = _met(tiled, asked, n_tiles, n_anchor_tiles).applyInArrow(
        _negatives(dims, primes, negatives, window),
        "anchor_id BIGINT, positive_id BIGINT, negative_id BIGINT, positive_score BIGINT, negative_score BIGINT")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
