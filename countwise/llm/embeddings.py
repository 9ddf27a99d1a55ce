"""Embedding near-duplicates by int8 tile products (operator 9).

Vectors with one label are dealt to tiles; every pair of tiles is compared in
one task by a matrix product of int8 codes.  A unit vector x is coded as
s * q + e with integer q in [-127, 127], so for two of them

    |x.y - s s' q.q'|  <=  |e| |s' q'| + |s q| |e'| + |e| |e'|

and only pairs whose product plus that bound (and a margin for rounding)
reaches the threshold are computed again, in double precision.

Equal vectors are one class with a count, so a group of copies costs one row.
A task returns link counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countwise.llm.components import components, local_roots
from countwise.llm.frames import stored

THRESHOLD = 0.98
#: Classes per tile on average.
TILE = 1024
#: Covers the rounding of the bound's own arithmetic in single precision.
MARGIN = 1e-4
#: Pairs recomputed at once.
RECOMPUTED = 1 << 16

_TILE = "label STRING, dim INT, tile INT, tiles INT, rep ARRAY<BIGINT>, copies ARRAY<BIGINT>, vectors BINARY"
_FOUND = "rep BIGINT, n_links BIGINT, root BIGINT"


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, length of the coded vector, length of the error) of unit row vectors."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(unit - coded, axis=1)


def close_pairs(x: np.ndarray, y: np.ndarray | None, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of all pairs with cosine >= threshold; y None: pairs i < j of x."""
    same = y is None
    y = x if same else y
    # Powers of two are exact: very large or small components lose nothing.
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None]) for v in (x, y))
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    qx, sx, cx, ex = quantise(x / nx[:, None])
    qy, sy, cy, ey = (qx, sx, cx, ex) if same else quantise(y / ny[:, None])
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64  # integer products stay exact
    bound = (qx.astype(kind) @ qy.astype(kind).T).astype(np.float32)
    bound *= sx.astype(np.float32)[:, None]
    bound *= sy.astype(np.float32)
    bound += (np.stack([ex, cx + ex], 1) @ np.stack([cy, ey])).astype(np.float32)
    i, j = np.nonzero(bound >= np.float32(threshold - MARGIN))
    if same:
        upper = i < j
        i, j = i[upper], j[upper]
    keep = np.empty(len(i), bool)
    for k in range(0, len(i), RECOMPUTED):
        a, b = i[k:k + RECOMPUTED], j[k:k + RECOMPUTED]
        keep[k:k + RECOMPUTED] = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b]) >= threshold
    return i[keep], j[keep]


def _gather(key: tuple, rows: pa.Table) -> pa.Table:
    values = rows["embedding"].combine_chunks()
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    data = np.ascontiguousarray(values.flatten().to_numpy(zero_copy_only=False), "<f8")
    return pa.table({
        "label": pa.array([rows["label"][0].as_py()], pa.string()), "dim": pa.array([rows["dim"][0].as_py()], pa.int32()),
        "tile": pa.array([rows["tile"][0].as_py()], pa.int32()), "tiles": pa.array([rows["tiles"][0].as_py()], pa.int32()),
        "rep": pa.array([rows["rep"].to_pylist()], pa.list_(pa.int64())), "copies": pa.array([rows["copies"].to_pylist()], pa.list_(pa.int64())),
        "vectors": pa.array([data.tobytes()], pa.binary()),
    })


def _compare(threshold: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        tiles = sorted(rows.select(["dim", "tile", "rep", "copies", "vectors"]).to_pylist(), key=lambda t: t["tile"])
        blocks = [np.frombuffer(t["vectors"], "<f8").reshape(-1, t["dim"]) for t in tiles]
        if len(blocks) == 1 and rows["low"][0].as_py() != rows["high"][0].as_py():
            blocks = []  # the other tile is empty
        if not blocks:
            return pa.table({c: pa.array([], pa.int64()) for c in ("rep", "n_links", "root")})
        i, j = close_pairs(blocks[0], blocks[1] if len(blocks) > 1 else None, threshold)
        if len(blocks) > 1:
            j = j + len(blocks[0])
        rep = np.concatenate([np.array(t["rep"], np.int64) for t in tiles])
        copies = np.concatenate([np.array(t["copies"], np.int64) for t in tiles])
        order = np.argsort(rep, kind="stable")  # so that the least root is the least rep
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        root = rep[order][local_roots(len(rep), rank[i], rank[j])[rank]]
        n = np.bincount(i, copies[j], len(rep)) + np.bincount(j, copies[i], len(rep))
        linked = n > 0
        return pa.table({"rep": rep[linked], "n_links": n[linked].astype(np.int64), "root": root[linked]})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Vectors are compared when their labels are equal and not null and they have
    as many components.  Null, empty and zero vectors, and such with a null or
    non-finite component, link with nothing.  A row without a vec_id cannot be
    named by others: it is not compared, has no component_id and is kept.
    Other columns are ignored.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False))
              & F.coalesce(F.exists("embedding", lambda v: v != 0), F.lit(False)))
    key = ["key1", "key2"]
    keyed = rows.withColumns({
        "key1": F.when(usable, F.xxhash64("label", "embedding")), "key2": F.when(usable, F.xxhash64(F.lit(9), "embedding", "label"))})
    classes = stored(keyed.filter(usable).groupBy(*key).agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding")), "vector-classes")
    sizes = stored(classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "vector-tiles")
    dealt = classes.join(sizes, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64(*key), F.col("tiles")).cast("int"))
    tiles = dealt.select("label", "dim", "tile", "tiles", "rep", "copies", "embedding").groupBy("label", "dim", "tile").applyInArrow(
        lambda k, t: _gather(k, t), _TILE)
    meetings = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumns(
        {"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    found = stored(meetings.drop("other", "tiles").groupBy("label", "dim", "low", "high").applyInArrow(_compare(threshold), _FOUND), "vector-links")

    joined = stored(components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))), "vector-components")
    links = found.groupBy("rep").agg(F.sum("n_links").alias("n"))
    named = classes.select(*key, "rep", "copies").join(links, "rep", "left").join(
        joined, F.col("rep") == F.col("node"), "left").select(
        *key, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = keyed.filter(usable).select("vec_id", *key).join(stored(named, "vector-named"), key).select("vec_id", "n_links", "component_id")
    alone = keyed.filter(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
