"""Approximations against the exact answers on fixed seeds (sf0.01)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from countwise.operators import frequency as Q
from countwise.operators import triangles as T
from countwise.plans import params as P
from countwise.sources import canonical_edges, edges_partsupp, items_parts


@pytest.fixture(scope="module")
def graph(spark):
    e = canonical_edges(edges_partsupp(spark, SF_MID)).cache()
    yield e, T.exact_tc(e).first()["triangles"]
    e.unpersist()


def test_triangle_estimates_near_exact(graph):
    e, exact = graph
    assert exact == 300177
    estimates = [
        T.approx_tc_colors(e, P.COLORS, P.COLORING).first()["estimate"],
        T.approx_tc_median(e, P.COLORS, P.RUN_PARAMS).first()["estimate"],
        T.approx_tc_buckets(e, P.BUCKETS, P.BUCKET_PARAMS).first()["estimate"],
        T.approx_tc_partitions(e, P.BUCKETS, P.BUCKET_PARAMS).first()["estimate"],
    ]
    for est in estimates:
        assert abs(est - exact) / exact < 0.10, estimates
    assert T.exact_tc_triplets(e, 3, P.COLORING).first()["triangles"] == exact


# The interval this check was calibrated on (1,001 part ids at sf0.01).
LEFT, RIGHT = 100, 1100


def test_sketch_estimates_near_exact(spark):
    items = items_parts(spark, SF_MID)
    freq = Q.item_frequencies(items, LEFT, RIGHT)
    sketch = Q.count_sketch(items, P.FAMILY, 1024, LEFT, RIGHT)
    n = Q.in_range(items, LEFT, RIGHT).agg(F.count("*")).scalar()
    f2 = Q.f2_exact(freq).first()["f2"]
    f2_est = Q.f2_estimate(sketch, len(P.FAMILY), n).first()["f2_est"]
    # The reference's hash family ((a*x + b) mod 8191) gives structured signs
    # on consecutive ids: single rows range from 0.3x to 1.4x the exact F2
    # here (a well-mixed hash gives ~1.05x), so the median of 5 rows is
    # checked loosely.
    assert abs(f2_est - f2) / f2 < 0.25
    assert Q.top_k_error(freq, sketch, P.FAMILY, 1024, P.TOP_K).first()["avg_rel_err"] < 0.5
