"""Triangle counting on undirected graphs, exact and approximate.

All variants share one counting core on canonical edges (u < v):

1. Orient every edge from the lower to the higher vertex of a total order.
   The default order is (degree, id) (Suri & Vassilvitskii, WWW 2011): every
   out-degree is then at most sqrt(2m), so no vertex -- not even a hub holding
   a third of all edges -- yields an unbounded list.
   ``order="id"`` orders by (heavy, id), where a vertex is heavy if its degree
   exceeds sqrt(2m).  A light vertex has at most sqrt(2m) neighbours at all
   and fewer than sqrt(2m) vertices are heavy, so the same bound holds for the
   lists, and for the heavy table, which can be broadcast: the edges are not
   shuffled to be oriented.  On skewed graphs the lists are longer.
2. Out-neighbour lists N+(x) by ``groupBy(src).collect_list(dst)``.
3. Every oriented edge (x -> y) meets N+(y) in one equi-join; the triangle
   count of the edge is ``size(array_intersect(N+(x), N+(y)))``.  Each
   triangle is counted once, at the edge between its two lowest vertices.
   Rows stay one per edge: no wedge (vertex pair) is ever emitted.  A list of
   one vertex closes no triangle, so its edge is not sent.  In id order a
   list may be as long as a degree although its edges end where there is
   none, so the shorter of an edge's two lists is sent to the longer, and
   nothing if one is empty: at most sum(min(d(x), d(y))) ids, which is
   within 2a times the edges for a graph of arboricity a (Chiba & Nishizeki,
   SIAM J. Comput. 1985), whatever the order.

The join in 3 takes N+(x) from the exploded adjacency row.  A hub has few
out-neighbours but up to n in-edges, each with a list: one join key.  AQE
splits such a partition only if both sides of the join are shuffle stages,
and an aggregate is not; so the lists are written to the shared folder once
and read back, and likewise the degrees.

The orientation is computed once on the base graph; group columns
(colour, run, bucket, colour triplet) are then extra key columns of every
grouping and join, so each group is counted separately in the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countwise.functions.hashing import (
    PRIME,
    BucketParams,
    LinearParams,
    edge_bucket,
    edge_hash,
    vertex_color,
)
from countwise.functions.stats import int_median
from countwise.session import stored

ORDERS = ("degree", "id")


def _check_colors(num_colors: int) -> None:
    if num_colors < 1:
        raise ValueError("the number of colours C must be >= 1")


# --------------------------------------------------------------------------
# counting core
# --------------------------------------------------------------------------

def orient_edges(edges: DataFrame, order: str = "degree") -> DataFrame:
    """Canonical edges (u, v, extra..) -> oriented edges (extra.., src, dst).

    Extra columns (a subset key, say) are carried along.  The orientation
    is computed once on the whole graph.  Any total order on the vertices
    is a valid orientation of every subgraph, so keyed variants (colours,
    runs, subsets, colour triplets) attach their keys afterwards instead
    of re-orienting C or R copies of the edges; the out-degree bound holds
    within every group as well.  Edges that are oriented already (they have
    src and dst) are returned as they are, so a report orients once.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    if {"src", "dst"} <= set(edges.columns):
        return edges
    extra = [c for c in edges.columns if c not in ("u", "v")]
    ends = edges.select(F.explode(F.array("u", "v")).alias("x"))
    deg = ends.groupBy("x").agg(F.count(F.lit(1)).alias("d"))
    if order == "id":
        twice_m = deg.agg(F.sum("d")).scalar()
        d = F.col("d").cast("double")
        heavy = stored(deg.where(d * d > twice_m).select("x"), "heavy-vertices")
        # Fewer than sqrt(2m) rows: degrees above sqrt(2m) sum to 2m at most.
        hu, hv = (F.broadcast(heavy.select(F.col("x").alias(c), F.lit(True).alias("h" + c)))
                  for c in ("u", "v"))
        e = edges.join(hu, "u", "left").join(hv, "v", "left")
        # u < v on canonical edges, so within a class u comes first.
        forward = F.col("hu").isNull() | F.col("hv").isNotNull()
    else:
        deg = stored(deg, "degrees")
        du = deg.select(F.col("x").alias("u"), F.col("d").alias("du"))
        dv = deg.select(F.col("x").alias("v"), F.col("d").alias("dv"))
        # Shuffled hash joins built on the degree table (one row per vertex,
        # never more rows than the edges): the edges stream through, and a
        # hub's many edges can be split because the degrees are read back.
        e = (edges.join(du.hint("shuffle_hash"), "u")
             .join(dv.hint("shuffle_hash"), "v"))
        forward = F.col("du") <= F.col("dv")
    return e.select(
        *extra,
        F.when(forward, F.col("u")).otherwise(F.col("v")).alias("src"),
        F.when(forward, F.col("v")).otherwise(F.col("u")).alias("dst"),
    )


def neighbour_lists(oriented: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., src, nbrs): out-neighbours of every vertex with out-edges."""
    return oriented.groupBy(*keys, "src").agg(F.collect_list("dst").alias("nbrs"))


def shorter_lists(adj: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Neighbour lists (keys.., src, nbrs) -> (keys.., src, dst, at, sent) for
    every edge that can close a triangle: the shorter list of its ends and
    the end ``at`` whose list it has to meet."""
    keys = list(keys)
    asked = adj.where(F.size("nbrs") >= 2).select(
        *keys, "src", F.explode("nbrs").alias("dst"), F.size("nbrs").alias("n_src"))
    sizes = adj.select(*keys, F.col("src").alias("dst"), F.size("nbrs").alias("n_dst"))
    tail = F.col("n_src") <= F.col("n_dst")
    asked = asked.join(sizes.hint("shuffle_hash"), [*keys, "dst"]).select(
        *keys, "src", "dst", F.when(tail, F.col("src")).otherwise(F.col("dst")).alias("of"),
        F.when(tail, F.col("dst")).otherwise(F.col("src")).alias("at"))
    lists = adj.select(*keys, F.col("src").alias("of"), F.col("nbrs").alias("sent"))
    return asked.join(lists.hint("shuffle_hash"), [*keys, "of"]).select(*keys, "src", "dst", "at", "sent")


def common_neighbours(oriented: DataFrame, keys: Sequence[str] = (), order: str = "degree") -> DataFrame:
    """Oriented edges (keys.., src, dst) -> (keys.., src, dst, common) for
    every edge whose tail has two out-neighbours or more and whose head has
    any; ``common`` = N+(src) & N+(dst), the third vertices of the triangles
    counted at this edge."""
    keys = list(keys)
    adj = stored(neighbour_lists(oriented, keys), "neighbours")
    if order == "id":
        there = adj.select(*keys, F.col("src").alias("at"), F.col("nbrs").alias("kept"))
        return shorter_lists(adj, keys).join(there.hint("shuffle_hash"), [*keys, "at"]).select(
            *keys, "src", "dst", F.array_intersect("sent", "kept").alias("common"))
    tails = adj.where(F.size("nbrs") >= 2).select(
        *keys, "src", F.explode("nbrs").alias("dst"), F.col("nbrs").alias("n_src"))
    heads = adj.select(*keys, F.col("src").alias("dst"), F.col("nbrs").alias("n_dst"))
    # Built on the heads (one row per vertex): the exploded tails, which
    # carry arrays, stream through unsorted.
    return tails.join(heads.hint("shuffle_hash"), [*keys, "dst"]).select(
        *keys, "src", "dst", F.array_intersect("n_src", "n_dst").alias("common"))


def triangle_counts(oriented: DataFrame, keys: Sequence[str] = (), order: str = "degree") -> DataFrame:
    """Triangles per group of oriented edges -> (keys.., t); one row (t)
    when there are no keys.  Groups without triangles are absent; with no
    keys the row is 0.
    """
    keys = list(keys)
    per_edge = common_neighbours(oriented, keys, order).select(*keys, F.size("common").alias("n"))
    if not keys:
        return per_edge.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("t"))
    return per_edge.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("t")).where("t > 0")


# --------------------------------------------------------------------------
# exact
# --------------------------------------------------------------------------

def sorted3(a: Column, b: Column, c: Column) -> tuple[Column, Column, Column]:
    """Three values in non-decreasing order, as plain codegen'd arithmetic."""
    lo, hi = F.least(a, b, c), F.greatest(a, b, c)
    return lo, a + b + c - lo - hi, hi


def triangles(edges: DataFrame, order: str = "degree") -> DataFrame:
    """List every triangle once -> (u, v, w) with u < v < w by id."""
    tri = (common_neighbours(orient_edges(edges, order), order=order)
           .select("src", "dst", F.explode("common").alias("w")))
    u, v, w = sorted3(F.col("src"), F.col("dst"), F.col("w"))
    return tri.select(u.alias("u"), v.alias("v"), w.alias("w"))


def exact_tc(edges: DataFrame, order: str = "degree") -> DataFrame:
    """Exact triangle count of canonical edges -> one row (triangles)."""
    return triangle_counts(orient_edges(edges, order), order=order).select(F.col("t").alias("triangles"))


# --------------------------------------------------------------------------
# node colouring (P5, A7, T4, T4r)
# --------------------------------------------------------------------------

def _mono(edges: DataFrame, num_colors: int, params: LinearParams, p: int,
          ends: tuple[str, str]) -> DataFrame:
    x, y = ends
    cx = vertex_color(x, num_colors, params.a, params.b, p)
    cy = vertex_color(y, num_colors, params.a, params.b, p)
    return (edges.select(cx.alias("cx"), cy.alias("cy"), x, y)
            .where("cx = cy").select(F.col("cx").alias("color"), x, y))


def monochromatic(edges: DataFrame, num_colors: int, params: LinearParams,
                  p: int = PRIME) -> DataFrame:
    """P5: edges whose ends have the same colour -> (color, u, v)."""
    _check_colors(num_colors)
    return _mono(edges, num_colors, params, p, ("u", "v"))


def triangles_by_color(edges: DataFrame, num_colors: int, params: LinearParams,
                       p: int = PRIME, order: str = "degree") -> DataFrame:
    """t(i), the triangles of the edges of colour i -> (color, t)."""
    _check_colors(num_colors)
    mono = _mono(edges, num_colors, params, p, ("u", "v"))
    return triangle_counts(orient_edges(mono, order), ["color"], order)


def approx_tc_colors(edges: DataFrame, num_colors: int, params: LinearParams,
                     p: int = PRIME, order: str = "degree") -> DataFrame:
    """T4: C^2 * (triangles of monochromatic edges) -> one row (estimate).

    A triangle of monochromatic edges is wholly one colour (the edges share
    vertices), so counting the monochromatic subgraph at once equals the
    sum of t(i) without a per-colour step.
    """
    _check_colors(num_colors)
    # One colouring keeps about 1/C of the edges: filter first, then orient
    # only the monochromatic subgraph (its own degrees order it).
    mono = _mono(edges, num_colors, params, p, ("u", "v")).select("u", "v")
    c2 = F.lit(num_colors).cast("bigint") * F.lit(num_colors).cast("bigint")
    return (triangle_counts(orient_edges(mono, order), order=order)
            .select((c2 * F.col("t")).alias("estimate")))


def _runs_column(runs: Sequence[LinearParams]) -> Column:
    return F.array(*[
        F.struct(F.lit(r).cast("int").alias("run"), F.lit(prm.a).cast("bigint").alias("a"),
                 F.lit(prm.b).cast("bigint").alias("b"))
        for r, prm in enumerate(runs)])


def approx_tc_runs(edges: DataFrame, num_colors: int, runs: Sequence[LinearParams],
                   p: int = PRIME, order: str = "degree") -> DataFrame:
    """T4 repeated R times in one plan -> (run, estimate), every run present.

    Each oriented edge is replicated once per run by exploding a literal
    array of the R colourings (no join), and dropped at once unless
    monochromatic, so the shuffle carries about R/C of the edges.  Runs
    without triangles come from ``range(R)`` with estimate 0: a missing
    zero would bias the median.
    """
    _check_colors(num_colors)
    if len(runs) < 1:
        raise ValueError("at least one run is needed")
    spark = edges.sparkSession
    rep = orient_edges(edges, order).select("src", "dst", F.explode(_runs_column(runs)).alias("r"))
    cs = vertex_color("src", num_colors, F.col("r.a"), F.col("r.b"), p)
    cd = vertex_color("dst", num_colors, F.col("r.a"), F.col("r.b"), p)
    mono = (rep.select(F.col("r.run").alias("run"), "src", "dst", cs.alias("cs"), cd.alias("cd"))
            .where("cs = cd").select("run", "src", "dst"))
    counts = triangle_counts(mono, ["run"], order)
    zeros = spark.range(len(runs)).select(F.col("id").cast("int").alias("run"),
                                          F.lit(0).cast("bigint").alias("t"))
    c2 = F.lit(num_colors).cast("bigint") * F.lit(num_colors).cast("bigint")
    return (counts.unionByName(zeros).groupBy("run")
            .agg((c2 * F.sum("t")).cast("bigint").alias("estimate")))


def approx_tc_median(edges: DataFrame, num_colors: int, runs: Sequence[LinearParams],
                     p: int = PRIME, order: str = "degree") -> DataFrame:
    """T4r: median over R colourings -> one row (estimate)."""
    per_run = approx_tc_runs(edges, num_colors, runs, p, order)
    return per_run.agg(int_median(F.collect_list("estimate")).alias("estimate"))


# --------------------------------------------------------------------------
# random edge subsets
# --------------------------------------------------------------------------

def bucketed(edges: DataFrame, num_buckets: int, params: BucketParams, p: int = PRIME) -> DataFrame:
    """P7 (hash mode): every edge in exactly one of C subsets -> (bucket, u, v)."""
    _check_colors(num_buckets)
    return edges.select(edge_bucket("u", "v", num_buckets, params, p).alias("bucket"), "u", "v")


def _oriented_buckets(edges: DataFrame, num_buckets: int, params: BucketParams, p: int,
                      order: str) -> DataFrame:
    # The subset hash reads the canonical (least, greatest) ends, so an
    # edge's subset does not depend on its orientation.
    o = orient_edges(edges, order)
    lo, hi = F.least("src", "dst"), F.greatest("src", "dst")
    return o.select(edge_bucket(lo, hi, num_buckets, params, p).alias("bucket"), "src", "dst")


def triangles_by_bucket(bucketed_edges: DataFrame, order: str = "degree") -> DataFrame:
    """t(i) within each subset of (bucket, u, v) -> (bucket, t)."""
    return triangle_counts(orient_edges(bucketed_edges, order), ["bucket"], order)


def _scaled_sum(per_group: DataFrame, num_buckets: int) -> DataFrame:
    c2 = F.lit(num_buckets).cast("bigint") * F.lit(num_buckets).cast("bigint")
    return per_group.agg((c2 * F.coalesce(F.sum("t"), F.lit(0))).cast("bigint").alias("estimate"))


def triangles_by_hash_bucket(edges: DataFrame, num_buckets: int, params: BucketParams,
                             p: int = PRIME, order: str = "degree") -> DataFrame:
    """A8 (hash mode) -> (bucket, t), the subset computed after orienting."""
    _check_colors(num_buckets)
    return triangle_counts(_oriented_buckets(edges, num_buckets, params, p, order), ["bucket"], order)


def approx_tc_buckets(edges: DataFrame, num_buckets: int, params: BucketParams,
                      p: int = PRIME, order: str = "degree") -> DataFrame:
    """T5: C^2 * sum of triangles inside random edge subsets -> (estimate)."""
    return _scaled_sum(triangles_by_hash_bucket(edges, num_buckets, params, p, order), num_buckets)


def partition_buckets(edges: DataFrame, num_buckets: int, params: BucketParams,
                      p: int = PRIME, order: str = "degree") -> DataFrame:
    """P7 (partition mode): a round-robin deal of all edges into C subsets
    -> oriented (bucket, src, dst).

    The edges are ranked by (hash, u, v), where ``params`` gives the hash --
    other parameters, another shuffle -- and the edge of rank r goes to
    subset r mod C: subset sizes differ by one at most, as Spark's own
    ``repartition(C)`` would make them, but the deal depends on the rows
    alone, not on how they were split.

    Ranks come from a range partitioning: each task numbers its own rows,
    and the driver adds up one count per task.  The numbered rows are
    written once, so a retried task cannot number them anew.
    """
    _check_colors(num_buckets)
    spark = edges.sparkSession
    part = F.spark_partition_id()
    ends = orient_edges(edges, order).select(
        F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"), "src", "dst")
    ranked = (ends.select(edge_hash("u", "v", params, p).alias("s"), "u", "v", "src", "dst")
              .repartitionByRange("s", "u", "v").sortWithinPartitions("s", "u", "v"))
    # monotonically_increasing_id = partition id << 33 | row index
    numbered = stored(ranked.select(
        part.alias("part"), "src", "dst",
        (F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33)).alias("row")), "ranked-edges")
    before, starts = 0, []
    for r in sorted(numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):
        starts.append((r["part"], before))
        before += r["n"]
    first = spark.createDataFrame(starts, "part INT, first BIGINT")
    bucket = F.pmod(F.col("first") + F.col("row"), F.lit(num_buckets).cast("bigint"))
    return numbered.join(first, "part").select(bucket.alias("bucket"), "src", "dst")


def triangles_by_partition(edges: DataFrame, num_buckets: int, params: BucketParams,
                           p: int = PRIME, order: str = "degree") -> DataFrame:
    """A8 (partition mode) -> (bucket, t)."""
    return triangle_counts(partition_buckets(edges, num_buckets, params, p, order), ["bucket"], order)


def approx_tc_partitions(edges: DataFrame, num_buckets: int, params: BucketParams,
                         p: int = PRIME, order: str = "degree") -> DataFrame:
    """T5 with round-robin partitions as the subsets -> (estimate)."""
    return _scaled_sum(triangles_by_partition(edges, num_buckets, params, p, order), num_buckets)


# --------------------------------------------------------------------------
# colour triplets
# --------------------------------------------------------------------------

def _triplets(edges: DataFrame, num_colors: int, params: LinearParams, p: int,
              ends: tuple[str, str]) -> DataFrame:
    x, y = ends
    cx = vertex_color(x, num_colors, params.a, params.b, p)
    cy = vertex_color(y, num_colors, params.a, params.b, p)
    i = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(num_colors - 1).cast("bigint")))
    rows = edges.select(x, y, cx.alias("cx"), cy.alias("cy"), i.alias("i"))
    k1, k2, k3 = sorted3(F.col("cx"), F.col("cy"), F.col("i"))
    return rows.select(k1.alias("k1"), k2.alias("k2"), k3.alias("k3"), x, y)


def expand_triplets(edges: DataFrame, num_colors: int, params: LinearParams,
                    p: int = PRIME) -> DataFrame:
    """Each edge once per i in [0, C-1], keyed by the sorted colours
    (h(u), h(v), i) -> (k1, k2, k3, u, v).  Data grows C times."""
    _check_colors(num_colors)
    return _triplets(edges, num_colors, params, p, ("u", "v"))


TRIPLET_METHODS = ("direct", "expand")


def _triplet_candidates(oriented: DataFrame, num_colors: int, params: LinearParams,
                        p: int) -> DataFrame:
    """Oriented edges (src, dst) -> (cx, cy, i, n): for an edge of the colours
    cx, cy within its key sort(cx, cy, i), the common out-neighbours of
    colour i.

    The edges are gathered by tail before they are expanded: one row for the
    out-neighbours of one colour goes into its C keys at once.  A head's list
    within a key, cut to colour i, is known by (cx, i) beside the head.  An
    edge whose tail has no other out-neighbour of colour i has no candidate
    in that key and is not sent to it.
    """
    def color(x: str) -> Column:
        return vertex_color(x, num_colors, params.a, params.b, p)

    ends = oriented.select("src", color("src").alias("c"), F.struct(color("dst").alias("c"), "dst").alias("end"))
    adj = stored(ends.groupBy("src", "c").agg(F.collect_list("end").alias("ends")), "colored-neighbours")
    by_color = adj.select("src", "c", "ends", F.explode(F.array_distinct("ends.c")).alias("i"))
    of_color = F.transform(F.filter("ends", lambda e: e["c"] == F.col("i")), lambda e: e["dst"])
    lists = by_color.select("src", "c", "ends", "i", of_color.alias("nbrs"))
    edges = lists.where(F.size("ends") >= 2).select(
        F.col("c").alias("cx"), "i", "nbrs", F.explode("ends").alias("end"))
    tails = edges.select(
        "cx", F.col("end.c").alias("cy"), "i", F.col("end.dst").alias("dst"),
        F.when(F.col("end.c") == F.col("i"), F.array_remove("nbrs", F.col("end.dst")))
        .otherwise(F.col("nbrs")).alias("n_src")).where(F.size("n_src") > 0)
    heads = lists.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(num_colors - 1).cast("bigint"))).alias("cx"),
        "i", F.col("src").alias("dst"), F.col("nbrs").alias("n_dst"))
    met = tails.join(heads.hint("shuffle_hash"), ["cx", "i", "dst"])
    return met.select("cx", "cy", "i", F.size(F.array_intersect("n_src", "n_dst")).alias("n"))


def triangles_by_triplet(edges: DataFrame, num_colors: int, params: LinearParams,
                         p: int = PRIME, order: str = "degree",
                         method: str = "direct") -> DataFrame:
    """t_k, the triangles inside key k whose sorted colours equal k
    -> (k1, k2, k3, t).  Every triangle is counted at exactly one key.

    ``method="direct"`` lists the triangles once and groups them by their
    sorted colours (the partial aggregation folds them map-side into at most
    C^3 rows per task).

    ``method="expand"`` is the colour-triplet algorithm as published: every
    edge is replicated into its C keys and each key group is counted on its
    own.  An edge (x, y) sits in key k = sort(h(x), h(y), i) for exactly one
    i, so a triangle x, y, w of that group has colours k iff h(w) = i: only
    out-neighbours of that colour are sent and compared.  It was
    made for engines whose tasks must hold a whole group: here the list bound
    of the core already bounds every group, so it ships C times the edges for
    the same result and serves as an independent check of ``direct``.
    """
    _check_colors(num_colors)
    if method not in TRIPLET_METHODS:
        raise ValueError(f"method must be one of {TRIPLET_METHODS}")
    keys = ["k1", "k2", "k3"]
    if method == "direct":
        listed = (common_neighbours(orient_edges(edges, order), order=order)
                  .select("src", "dst", F.explode("common").alias("w")))
        k1, k2, k3 = sorted3(*[vertex_color(c, num_colors, params.a, params.b, p)
                               for c in ("src", "dst", "w")])
        return (listed.groupBy(k1.alias("k1"), k2.alias("k2"), k3.alias("k3"))
                .agg(F.count(F.lit(1)).alias("t")))
    common = _triplet_candidates(orient_edges(edges, order), num_colors, params, p)
    k1, k2, k3 = sorted3(F.col("cx"), F.col("cy"), F.col("i"))
    return (common.groupBy(k1.alias("k1"), k2.alias("k2"), k3.alias("k3"))
            .agg(F.sum("n").cast("bigint").alias("t")).where("t > 0"))


def exact_tc_triplets(edges: DataFrame, num_colors: int, params: LinearParams,
                      p: int = PRIME, order: str = "degree", method: str = "direct") -> DataFrame:
    """Sum of t_k -> one row (triangles); equals ``exact_tc``."""
    per_key = triangles_by_triplet(edges, num_colors, params, p, order, method)
    return per_key.agg(F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("triangles"))
