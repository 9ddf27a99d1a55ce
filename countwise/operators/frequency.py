"""Frequency statistics of an item stream: exact counts, count sketch,
second moment, top-K with ties and the sketch error.

Input is a DataFrame with a BIGINT ``item`` column (batch here, the
streaming module feeds the same functions).  Layout of a sketch: the
sparse long form (j, h, c) -- row j of D, column h of W, signed count c;
a missing cell is 0.  It has at most D*W rows by construction, which is
the size bound that allows it to be broadcast.

Skew: a hot item (a third of the stream) is folded by the partial hash
aggregates before any shuffle; the sketch shuffle carries at most D*W
rows per task whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countwise.functions.hashing import (
    MAX_PRIME,
    PRIME,
    FourWiseRow,
    SketchRow,
    cubic_hash,
    family_struct_array,
    linear_hash,
    sign_hash,
)
from countwise.functions.stats import WIDE, int_median

# Sketches up to this many cells (D*W) are broadcast to the lookup; a
# larger one is joined by a shuffle instead.
BROADCAST_MAX_CELLS = 1 << 20


def _check_sketch(family: Sequence[SketchRow], width: int, p: int) -> None:
    if not family:
        raise ValueError("sketch depth D must be >= 1")
    if width < 1:
        raise ValueError("sketch width W must be >= 1")
    if width > p:
        # Columns >= p can never be hit: the inner hash is already mod p.
        import warnings
        warnings.warn(f"sketch width W={width} exceeds the hash prime p={p}; "
                      "columns p..W-1 stay empty", stacklevel=3)


def in_range(items: DataFrame, left: int | None, right: int | None) -> DataFrame:
    """Items in the closed interval [left, right] (None = unbounded)."""
    cond = F.lit(True)
    if left is not None:
        cond = cond & (F.col("item") >= F.lit(left))
    if right is not None:
        cond = cond & (F.col("item") <= F.lit(right))
    return items.where(cond)


def item_frequencies(items: DataFrame, left: int | None = None,
                     right: int | None = None) -> DataFrame:
    """K2: exact frequency of every distinct item in range -> (item, f).

    The range filter runs before the shuffle (the reference shuffled every
    item and dropped out-of-range ones after).
    """
    return (in_range(items, left, right).groupBy("item")
            .agg(F.count(F.lit(1)).alias("f")))


def sketch_cells(items: DataFrame, family: Sequence[SketchRow], width: int,
                 p: int = PRIME, extra: Sequence[str] = ()) -> DataFrame:
    """Each row once per sketch row j -> (item, extra.., j, h, g).

    The D hash pairs are a literal array exploded in the same codegen
    stage: no join, no shuffle.
    """
    r = F.explode(family_struct_array(list(family))).alias("r")
    rows = items.select("item", *extra, r)
    return rows.select(
        "item", *extra,
        F.col("r.j").alias("j"),
        linear_hash("item", F.col("r.ah"), F.col("r.bh"), width, p).alias("h"),
        sign_hash("item", F.col("r.ag"), F.col("r.bg"), p).alias("g"),
    )


def count_sketch(items: DataFrame, family: Sequence[SketchRow], width: int,
                 left: int | None = None, right: int | None = None,
                 p: int = PRIME) -> DataFrame:
    """K1: D x W count sketch of the items in range -> (j, h, c)."""
    _check_sketch(family, width, p)
    cells = sketch_cells(in_range(items, left, right), family, width, p)
    return cells.groupBy("j", "h").agg(F.sum("g").cast("bigint").alias("c"))


def sketch_from_frequencies(freq: DataFrame, family: Sequence[SketchRow], width: int,
                            p: int = PRIME) -> DataFrame:
    """K1 from exact frequencies (linear): C[j][h] = sum g_j(i) * f(i)."""
    _check_sketch(family, width, p)
    cells = sketch_cells(freq, family, width, p, extra=["f"])
    return cells.groupBy("j", "h").agg(F.sum(F.col("g") * F.col("f")).cast("bigint").alias("c"))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """K3: cell-wise sum of sketches built with the same family -> (j, h, c)."""
    if not sketches:
        raise ValueError("nothing to merge")
    allc = sketches[0].select("j", "h", "c")
    for s in sketches[1:]:
        allc = allc.unionByName(s.select("j", "h", "c"))
    return allc.groupBy("j", "h").agg(F.sum("c").cast("bigint").alias("c"))


def estimate_frequencies(sketch: DataFrame, candidates: DataFrame, family: Sequence[SketchRow],
                         width: int, p: int = PRIME, keep: Sequence[str] = (),
                         candidates_by_item: bool = True) -> DataFrame:
    """K4: f~(u) = median_j g_j(u) * C[j][h_j(u)] for distinct candidates
    -> (item, keep.., est).

    The sketch (at most D*W cells) is broadcast when D*W is within
    ``BROADCAST_MAX_CELLS``, else joined by a shuffle.

    ``candidates_by_item=True`` (candidates from an aggregation by item,
    e.g. the exact frequencies): each candidate is exploded into its D
    cells, looked up, and grouped back by item -- the grouping reuses the
    candidates' partitioning, so nothing is shuffled.
    ``candidates_by_item=False`` (e.g. ``range_candidates``): the D lookups
    run as D map-side joins against one broadcast keyed by
    cell = j*W + h (built once, reused), and the median is taken over an
    array of D columns, so the candidates are never shuffled either.
    """
    _check_sketch(family, width, p)
    zero = F.lit(0).cast("bigint")
    fits = len(family) * width <= BROADCAST_MAX_CELLS
    if fits and not candidates_by_item:
        cells = F.broadcast(sketch.select(
            (F.col("j") * F.lit(width).cast("bigint") + F.col("h")).alias("cell"), "c"))
        out = candidates.select("item", *keep).alias("cand")
        values = []
        for r in family:
            side = cells.alias(f"row{r.j}")
            cell = F.lit(r.j * width).cast("bigint") + linear_hash("item", r.ah, r.bh, width, p)
            out = out.join(side, cell == F.col(f"row{r.j}.cell"), "left")
            values.append(sign_hash(F.col("cand.item"), r.ag, r.bg, p)
                          * F.coalesce(F.col(f"row{r.j}.c"), zero))
        return out.select(F.col("cand.item").alias("item"),
                          *[F.col(f"cand.{k}").alias(k) for k in keep],
                          int_median(F.array(*values)).alias("est"))
    cells = sketch_cells(candidates, family, width, p, extra=list(keep))
    sk = sketch.select("j", "h", "c")
    if fits:
        sk = F.broadcast(sk)
    looked = cells.join(sk, ["j", "h"], "left")
    value = F.col("g") * F.coalesce(F.col("c"), zero)
    return (looked.groupBy("item", *keep)
            .agg(int_median(F.collect_list(value)).alias("est")))


def range_candidates(items: DataFrame, left: int, right: int) -> DataFrame:
    """Every integer in [left, right], seen or not (the reference's choice),
    as a distributed range -> (item)."""
    return items.sparkSession.range(left, right + 1).select(F.col("id").alias("item"))


def f2_exact(freq: DataFrame) -> DataFrame:
    """K5: sum f^2 / (sum f)^2 -> one row (f2); NULL when the range is empty.

    Squares are summed exactly in DECIMAL(38,0): a hot item with a third of
    10^12 rows already has f^2 ~ 10^23, past BIGINT (which raises under
    ANSI).  One DOUBLE division at the end.
    """
    f = F.col("f").cast(WIDE)
    agg = freq.agg(F.sum(f * f).alias("s2"), F.sum("f").alias("n"))
    n = F.col("n").cast("double")
    return agg.select((F.col("s2").cast("double") / F.nullif(n * n, F.lit(0.0))).alias("f2"))


def f2_estimate(sketch: DataFrame, depth: int, n_in_range: Column) -> DataFrame:
    """K6: median_j sum_h C[j][h]^2 / n^2 -> one row (f2_est).

    All D rows take part (an empty row counts 0, from ``range(D)``), so the
    median is over exactly D values; row sums of squares are exact
    DECIMAL(38,0).  ``n_in_range`` is a scalar column (for example a scalar
    subquery counting the items in range).
    """
    spark = sketch.sparkSession
    c = F.col("c").cast(WIDE)
    per_row = sketch.groupBy("j").agg(F.sum(c * c).cast(WIDE).alias("s"))
    zeros = spark.range(depth).select(F.col("id").alias("j"), F.lit(0).cast(WIDE).alias("s"))
    rows = per_row.unionByName(zeros).groupBy("j").agg(F.sum("s").cast(WIDE).alias("s"))
    n = n_in_range.cast("double")
    med = int_median(F.collect_list("s"), wide=True).cast("double")
    return rows.agg((med / F.nullif(n * n, F.lit(0.0))).alias("f2_est"))


def four_wise_sketch(freq: DataFrame, family: Sequence[FourWiseRow], width: int,
                     p: int = MAX_PRIME) -> DataFrame:
    """K6 with four-wise independent signs, from (item, f) -> (j, h, c).

    The parity of a linear hash is pairwise independent at best, and on
    consecutive ids its products do not cancel; the variance bound of the F2
    estimate, 2 F2^2 / W per row, needs four-wise signs.  ``f2_estimate``
    takes this sketch like any other.
    """
    if not family or width < 1:
        raise ValueError("sketch depth D and width W must be >= 1")
    rows = F.array(*[
        F.struct(F.lit(r.j).cast("bigint").alias("j"), F.lit(r.ah).cast("bigint").alias("ah"), F.lit(r.bh).cast("bigint").alias("bh"),
                 *[F.lit(c).cast("bigint").alias(f"g{k}") for k, c in enumerate(r.g)]) for r in family])
    cells = freq.select("item", "f", F.explode(rows).alias("r"))
    odd = F.pmod(cubic_hash("item", [F.col(f"r.g{k}") for k in range(4)], p), F.lit(2)) == 1
    return cells.select(F.col("r.j").alias("j"), linear_hash("item", F.col("r.ah"), F.col("r.bh"), width, p).alias("h"),
                        F.when(odd, F.col("f")).otherwise(-F.col("f")).alias("g")) \
        .groupBy("j", "h").agg(F.sum("g").cast("bigint").alias("c"))


def kth_frequency(freq: DataFrame, k: int) -> DataFrame:
    """K7: phi(K), the K-th largest frequency (duplicates counted) -> (phi).

    Selected from the histogram of frequencies, whatever K is: a stream of n
    items has fewer than sqrt(2n) different frequencies, and only these are
    summed up in order, in one task.  NULL when there are no items; the
    smallest frequency when K exceeds the number of items.
    """
    if k < 1:
        raise ValueError("K must be >= 1")
    histogram = freq.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy(F.lit(0)).orderBy(F.col("f").desc())
    reached = histogram.select("f", F.sum("n").over(down).alias("items"))
    return reached.agg(F.coalesce(F.max(F.when(F.col("items") >= k, F.col("f"))), F.min("f")).alias("phi"))


def top_k_items(freq: DataFrame, k: int) -> DataFrame:
    """K8: every item with f >= phi(K) (ties included) -> (item, f).

    phi is a scalar subquery: computed once, then a plain filter; the
    frequency aggregation is shared by exchange reuse.
    """
    phi = kth_frequency(freq, k).scalar()
    return freq.where(F.col("f") >= phi)


def top_k_with_estimates(freq: DataFrame, sketch: DataFrame, family: Sequence[SketchRow],
                         width: int, k: int, p: int = PRIME) -> DataFrame:
    """K8 + J5: top-K items with their sketch estimates -> (item, f, est)."""
    top = top_k_items(freq, k)
    return estimate_frequencies(sketch, top, family, width, p, keep=["f"])


def relative_error(with_est: DataFrame, digits: int = 12) -> DataFrame:
    """K9 over (item, f, est) -> one row (avg_rel_err) = mean |f - est| / f.

    Rounded to ``digits`` decimals so that the value does not depend on
    the order in which partial sums are merged.  NULL when there are no
    items.
    """
    rel = F.abs(F.col("f") - F.col("est")).cast("double") / F.col("f").cast("double")
    return with_est.agg(F.round(F.avg(rel), digits).alias("avg_rel_err"))


def top_k_error(freq: DataFrame, sketch: DataFrame, family: Sequence[SketchRow], width: int,
                k: int, p: int = PRIME) -> DataFrame:
    """K9: average relative error of the sketch over the top-K items."""
    return relative_error(top_k_with_estimates(freq, sketch, family, width, k, p))


#: log2 of the registers of a distinct-items sketch, and its error: estimates
#: lie within 5 % of the exact number with a chance of more than 99 %.
DISTINCT_LG = 12
DISTINCT_ERROR = 0.05


def distinct_sketches(items: DataFrame, by: str, lg: int = DISTINCT_LG) -> DataFrame:
    """A13 at scale: one mergeable HyperLogLog sketch of the items per part
    (batch, day, partition) -> (by, n_items, sketch), a few KB each."""
    return items.groupBy(by).agg(F.count(F.lit(1)).alias("n_items"), F.hll_sketch_agg("item", lg).alias("sketch"))


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """The union of any parts -> one row (n_sketches, n_items, est_distinct); no
    item is read again, and items that parts share count once."""
    return sketches.agg(F.count(F.lit(1)).alias("n_sketches"), F.coalesce(F.sum("n_items"), F.lit(0)).cast("bigint").alias("n_items"),
                        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("bigint").alias("est_distinct"))


def distinct_stats(items: DataFrame) -> DataFrame:
    """One row (n_items, n_distinct, max_item) of an item stream."""
    return items.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_distinct("item").alias("n_distinct"),
        F.max("item").alias("max_item"),
    )
