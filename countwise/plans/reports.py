"""The programs' printed reports, as one-row DataFrames.

Each report is one plan.  Its figures are scalar subqueries over shared
sub-plans: Spark runs each once and inlines the value, and identical
exchanges (the same frequency aggregation used by several figures) are
reused.  No figure passes through Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countwise.functions.hashing import PRIME, BucketParams, LinearParams, SketchRow
from countwise.functions.text import space_tokens
from countwise.operators import frequency as fq
from countwise.operators import triangles as tri
from countwise.operators import words as wd
from countwise.session import stored
from countwise.sources.readers import canonical_edges


def _lines_and_words(lines: DataFrame) -> DataFrame:
    """(word, n) from one pass over the text: the counts of all words, and one
    row without a word whose ``n`` is the number of documents."""
    token = F.explode(F.concat(F.array(F.lit(None).cast("string")), space_tokens("text")))
    return lines.select(token.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def report_words(lines: DataFrame) -> DataFrame:
    """C1 -> (n_docs, n_distinct_words, avg_word_length).

    Every document adds one null token, so the same aggregate that counts
    the words counts the documents: the text is read and split once.
    """
    counts = _lines_and_words(lines)
    is_word = F.col("word").isNotNull()
    n = F.count("word")
    total = F.sum(F.when(is_word, F.length("word").cast("bigint")))
    return counts.agg(
        F.coalesce(F.max(F.when(~is_word, F.col("n"))), F.lit(0)).cast("bigint").alias("n_docs"),
        n.alias("n_distinct_words"), total.alias("total")).select(
        "n_docs", "n_distinct_words", F.when(F.col("n_distinct_words") > 0, F.expr("total div n_distinct_words")).alias("avg_word_length"))


def report_word_counts(lines: DataFrame, num_keys: int, seed: int = 0) -> DataFrame:
    """The word-count program's cross-check -> (n_docs, n_words_one_round,
    n_words_salted, n_words_partitioned, avg_word_length): the distinct-word
    count after each variant (they must agree) and the average length.

    Each variant is a pass over the text of its own, as that is what is
    compared; the number of documents comes with the first.
    """
    first = report_words(lines)
    salted = wd.word_count_salted(lines, num_keys, seed).agg(F.count(F.lit(1))).scalar()
    parts = wd.word_count_by_partition(lines).agg(F.count(F.lit(1))).scalar()
    return first.select("n_docs", F.col("n_distinct_words").alias("n_words_one_round"),
                        salted.alias("n_words_salted"), parts.alias("n_words_partitioned"),
                        "avg_word_length")


def report_tc_approx(raw_edges: DataFrame, num_colors: int, runs: Sequence[LinearParams],
                     buckets: BucketParams, p: int = PRIME, order: str = "degree",
                     subsets: str = "hash") -> DataFrame:
    """C2 -> (n_edges, C, R, est_colors_median, est_partitions).

    ``n_edges`` is the raw row count.  The second estimate uses random
    edge subsets: by hash, or with ``subsets="partitions"`` the round-robin
    deal of the hash order.
    """
    if subsets not in ("hash", "partitions"):
        raise ValueError("subsets must be hash or partitions")
    # Both estimates count on the same oriented edges.
    edges = stored(tri.orient_edges(canonical_edges(raw_edges), order), "oriented-edges")
    med = tri.approx_tc_median(edges, num_colors, runs, p, order).scalar()
    estimate = tri.approx_tc_buckets if subsets == "hash" else tri.approx_tc_partitions
    part = estimate(edges, num_colors, buckets, p, order).scalar()
    return raw_edges.agg(F.count(F.lit(1)).alias("n_edges")).select(
        "n_edges", F.lit(num_colors).alias("C"), F.lit(len(runs)).alias("R"),
        med.alias("est_colors_median"), part.alias("est_partitions"))


def report_tc(raw_edges: DataFrame, num_colors: int, runs: Sequence[LinearParams], mode: int,
              coloring: LinearParams | None = None, p: int = PRIME,
              order: str = "degree") -> DataFrame:
    """C3 -> (n_edges, C, R, mode, triangles).

    mode 0: median of R node-colouring estimates; mode 1: exact count by
    colour triplets (with ``coloring``, default the first run's).
    """
    edges = canonical_edges(raw_edges)
    if mode == 0:
        value = tri.approx_tc_median(edges, num_colors, runs, p, order).scalar()
    elif mode == 1:
        col = coloring if coloring is not None else runs[0]
        value = tri.exact_tc_triplets(edges, num_colors, col, p, order).scalar()
    else:
        raise ValueError("mode must be 0 (approximate) or 1 (exact)")
    return raw_edges.agg(F.count(F.lit(1)).alias("n_edges")).select(
        "n_edges", F.lit(num_colors).alias("C"), F.lit(len(runs)).alias("R"),
        F.lit(mode).alias("mode"), value.alias("triangles"))


def report_sketch(items: DataFrame, family: Sequence[SketchRow], width: int, left: int,
                  right: int, k: int, p: int = PRIME) -> DataFrame:
    """C4 -> (D, W, left, right, K, n_items, n_in_range, range_width,
    distinct_items, avg_rel_err, f2, f2_est).

    One range-filtered scan feeds the exact frequencies; the sketch is
    built from them (linear: C[j][h] = sum g_j(i) f(i)), and the in-range
    length and distinct count are sums over them, so every figure but the
    total length reuses that one aggregation (shared exchange).
    ``range_width`` is what the reference printed as the number of
    distinct items; ``distinct_items`` is the true number.
    """
    n_items = items.agg(F.count(F.lit(1)).alias("n_items"))
    return report_sketch_of(fq.item_frequencies(items, left, right), n_items, family, width, left, right, k, p)


def report_sketch_of(freq: DataFrame, n_items: DataFrame, family: Sequence[SketchRow], width: int, left: int,
                     right: int, k: int, p: int = PRIME, sketch: DataFrame | None = None) -> DataFrame:
    """C4 from the frequencies in [left, right], of a table or of the committed
    part of a stream, and one row (n_items) with the whole length.  ``sketch``
    is one that a stream has kept; without it, it is built from the
    frequencies."""
    if sketch is None:
        sketch = fq.sketch_from_frequencies(freq, family, width, p)
    sizes = freq.agg(F.coalesce(F.sum("f"), F.lit(0)).cast("bigint").alias("n"),
                     F.count(F.lit(1)).alias("d"))
    n_in_range = sizes.select("n").scalar()
    distinct_items = sizes.select("d").scalar()
    err = fq.top_k_error(freq, sketch, family, width, k, p).scalar()
    f2 = fq.f2_exact(freq).scalar()
    f2_est = fq.f2_estimate(sketch, len(family), n_in_range).scalar()
    return n_items.select(
        F.lit(len(family)).alias("D"), F.lit(width).alias("W"), F.lit(left).alias("left"),
        F.lit(right).alias("right"), F.lit(k).alias("K"), "n_items",
        n_in_range.alias("n_in_range"), F.lit(right - left + 1).alias("range_width"),
        distinct_items.alias("distinct_items"), err.alias("avg_rel_err"),
        f2.alias("f2"), f2_est.alias("f2_est"))


def report_distinct(items: DataFrame) -> DataFrame:
    """C5 -> (n_items, n_distinct, max_item)."""
    return fq.distinct_stats(items)
