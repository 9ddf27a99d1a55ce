import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL, edges_df
from pyspark.sql import functions as F

from countwise.functions import BucketParams, LinearParams, color_params
from countwise.operators import triangles as T
from countwise.sources import canonical_edges, edges_from_text, edges_partsupp

K4 = [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]
NOISY = [(1, 2), (2, 1), (2, 3), (3, 1), (3, 1), (5, 5)]
STAR = [(1, 2), (1, 3), (1, 4), (1, 5)]
BOWTIE = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (3, 5)]
NEG_LARGE = [(-1, 2000000000), (2000000000, 7), (-1, 7)]


def brute(pairs):
    adj = {}
    for u, v in pairs:
        if u != v:
            adj.setdefault(u, set()).add(v)
            adj.setdefault(v, set()).add(u)
    return sum(1 for a, b, c in itertools.combinations(sorted(adj), 3)
               if b in adj[a] and c in adj[a] and c in adj[b])


def exact(spark, pairs, order="degree"):
    return T.exact_tc(canonical_edges(edges_df(spark, pairs)), order).first()["triangles"]


@pytest.mark.parametrize("pairs,expected", [(K4, 4), (NOISY, 1), (STAR, 0), (BOWTIE, 2),
                                            (NEG_LARGE, 1)])
@pytest.mark.parametrize("order", ["degree", "id"])
def test_exact_fixtures(spark, pairs, expected, order):
    assert exact(spark, pairs, order) == expected


def test_noisy_canonical(spark):
    e = canonical_edges(edges_df(spark, NOISY))
    assert sorted(map(tuple, e.collect())) == [(1, 2), (1, 3), (2, 3)]


@pytest.mark.parametrize("c", [1, 2, 3, 4, 5])
def test_triplets_equal_exact_on_negative_ids(spark, c):
    e = canonical_edges(edges_df(spark, NEG_LARGE))
    assert T.exact_tc_triplets(e, c, LinearParams(1234, 567)).first()["triangles"] == 1


def test_c1_estimates_equal_exact(spark):
    e = canonical_edges(edges_df(spark, K4))
    assert T.approx_tc_colors(e, 1, LinearParams(17, 3)).first()["estimate"] == 4
    assert T.approx_tc_buckets(e, 1, BucketParams(5, 7, 11)).first()["estimate"] == 4
    assert T.approx_tc_partitions(e, 1, DEAL).first()["estimate"] == 4
    assert T.approx_tc_median(e, 1, color_params(1, 3)).first()["estimate"] == 4


def test_bad_edge_raises(spark):
    lines = spark.createDataFrame([("1,x",)], "value STRING")
    with pytest.raises(Exception):
        edges_from_text(lines).collect()


def test_edges_from_text_ignores_extra_fields(spark):
    lines = spark.createDataFrame([("1,2,9",), ("3,4",)], "value STRING")
    assert sorted(map(tuple, edges_from_text(lines).collect())) == [(1, 2), (3, 4)]


@pytest.fixture(scope="module")
def partsupp(spark):
    df = canonical_edges(edges_partsupp(spark, SF_SMALL)).cache()
    yield df
    df.unpersist()


def test_partsupp_fixture_numbers(partsupp):
    assert partsupp.count() == 1852
    assert T.exact_tc(partsupp).first()["triangles"] == 7852
    assert T.approx_tc_colors(partsupp, 4, LinearParams(1234, 567)).first()["estimate"] == 6976


@pytest.mark.parametrize("c", [1, 2, 3, 5])
def test_sum_over_triplets_is_exact(partsupp, c):
    params = LinearParams(321, 45)
    per_key = T.triangles_by_triplet(partsupp, c, params)
    assert per_key.groupBy().sum("t").first()[0] == 7852
    # every key is a sorted colour triple
    assert per_key.where("k1 > k2 OR k2 > k3 OR k3 >= %d" % c).count() == 0


def test_listing_matches_count_and_orders_agree(partsupp):
    listed = T.triangles(partsupp)
    assert listed.count() == 7852
    assert listed.where("u >= v OR v >= w").count() == 0
    assert listed.distinct().count() == 7852
    assert T.exact_tc(partsupp, "id").first()["triangles"] == 7852


def test_colors_sum_equals_estimate(partsupp):
    params = LinearParams(1234, 567)
    per_color = T.triangles_by_color(partsupp, 4, params)
    total = per_color.groupBy().sum("t").first()[0]
    assert 16 * total == T.approx_tc_colors(partsupp, 4, params).first()["estimate"]


def test_runs_keep_zero_runs_and_median(spark):
    # a star has no triangles: every run must still be present, with 0
    e = canonical_edges(edges_df(spark, STAR))
    runs = T.approx_tc_runs(e, 3, color_params(5, 4)).orderBy("run").collect()
    assert [(r["run"], r["estimate"]) for r in runs] == [(0, 0), (1, 0), (2, 0), (3, 0)]
    assert T.approx_tc_median(e, 3, color_params(5, 4)).first()["estimate"] == 0


def test_median_of_runs_matches_per_run(partsupp):
    params = color_params(42, 4)
    runs = sorted(r["estimate"] for r in T.approx_tc_runs(partsupp, 4, params).collect())
    want = (runs[1] + runs[2]) // 2
    assert T.approx_tc_median(partsupp, 4, params).first()["estimate"] == want
    for i, prm in enumerate(params):
        one = T.approx_tc_colors(partsupp, 4, prm).first()["estimate"]
        assert one in runs


DEAL = BucketParams(11, 13, 17)


def test_partition_buckets_cover_each_edge_once(partsupp):
    b = T.partition_buckets(partsupp, 4, DEAL)
    m = partsupp.count()
    assert b.select("src", "dst").distinct().count() == b.count() == m
    sizes = [r["n"] for r in b.groupBy("bucket").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_partition_deal_depends_on_rows_and_parameters_only(partsupp):
    one = sorted(map(tuple, T.partition_buckets(partsupp, 4, DEAL).collect()))
    assert sorted(map(tuple, T.partition_buckets(partsupp.repartition(13), 4, DEAL).collect())) == one
    estimates = {T.approx_tc_partitions(partsupp, 4, BucketParams(a, a + 5, 3)).first()["estimate"]
                 for a in (17, 401, 1999, 5003)}
    assert len(estimates) > 1  # other parameters, another deal


def test_partition_estimates_with_c1(spark):
    e = canonical_edges(edges_df(spark, BOWTIE))
    assert T.approx_tc_partitions(e, 1, DEAL).first()["estimate"] == 2


def test_bucketed_input_matches_hash_buckets(partsupp):
    bp = BucketParams(11, 13, 17)
    a = T.triangles_by_bucket(T.bucketed(partsupp, 4, bp)).orderBy("bucket").collect()
    b = T.triangles_by_hash_bucket(partsupp, 4, bp).orderBy("bucket").collect()
    assert a == b


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=0, max_size=30),
       st.integers(0, 10_000))
def test_exact_matches_brute_force_under_noise(spark, pairs, seed):
    rng = random.Random(seed)
    noisy = pairs + [(v, u) for u, v in pairs[: len(pairs) // 2]] + pairs[:3]
    rng.shuffle(noisy)
    want = brute(pairs)
    assert exact(spark, noisy) == want


def test_hub_out_degree_is_bounded(spark):
    # hub 0 holds half of all edges; a ring among its leaves makes triangles
    n = 200
    pairs = [(0, i) for i in range(1, n + 1)] + [(i, i + 1) for i in range(1, n)]
    e = canonical_edges(edges_df(spark, pairs))
    m = e.count()
    for order in T.ORDERS:
        adj = T.neighbour_lists(T.orient_edges(e, order))
        assert adj.agg(F.max(F.size("nbrs"))).first()[0] <= int((2 * m) ** 0.5)
        assert exact(spark, pairs, order) == brute(pairs) == n - 1


def test_id_order_sends_the_shorter_list(spark):
    # 100 stars of 100 leaves, light in id order: their centres' lists end where there is none
    pairs = [(h, 1000 + 100 * h + i) for h in range(100) for i in range(100)]
    pairs += [(1000, 1001), (1000, 1100), (1001, 1100)]
    adj = T.neighbour_lists(T.orient_edges(canonical_edges(edges_df(spark, pairs)), "id"))
    lengths = {r["src"]: len(r["nbrs"]) for r in adj.collect()}
    sent = T.shorter_lists(adj).collect()
    assert lengths[0] == 100 and all(len(r["sent"]) == min(lengths[r["src"]], lengths[r["dst"]]) for r in sent)
    assert sum(len(r["sent"]) for r in sent) < 10  # each list along all its edges: a million
    assert exact(spark, pairs, "id") == 2


def test_triplet_keys_get_candidates_of_their_colour_only(spark):
    # a complete graph of 24 vertices: an edge is in 4 keys, and each other out-neighbour is its candidate in one
    e = canonical_edges(edges_df(spark, [(u, v) for u in range(24) for v in range(u)]))
    params = LinearParams(1234, 567)
    o = T.orient_edges(e)
    rows = T._triplet_candidates(o, 4, params, 8191)
    assert rows.agg(F.sum("n")).first()[0] == 24 * 23 * 22 // 6
    assert rows.count() <= 4 * e.count()
    a, b = (sorted(map(tuple, T.triangles_by_triplet(e, 4, params, method=m).collect())) for m in T.TRIPLET_METHODS)
    assert a == b


@pytest.fixture
def skew_settings(spark):
    """Thresholds that make a few kilobytes a skewed partition."""
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("count", [
    lambda e: T.exact_tc(e),
    lambda e: T.exact_tc(e, "id"),
    lambda e: T.approx_tc_runs(e, 2, color_params(3, 3)),
    lambda e: T.exact_tc_triplets(e, 2, LinearParams(1234, 567), method="expand"),
], ids=["exact", "exact_id", "median", "triplets"])
def test_a_hub_is_split(spark, skew_settings, count):
    # two hubs share all leaves: their in-edges are two join keys
    n = 6000
    e = canonical_edges(edges_df(spark, [(h, i) for h in (0, 1) for i in range(2, n)] + [(0, 1)]))
    df = count(e)
    got = df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    if "triangles" in df.columns:
        assert got[0]["triangles"] == n - 2


def test_prime_above_8191(spark):
    p = 2**31 - 1
    e = canonical_edges(edges_df(spark, [(p - 2, 2**40), (2**40, 2**62), (p - 2, 2**62), (-5, 7)]))
    assert T.approx_tc_colors(e, 1, LinearParams(p - 1, p - 1), p).first()["estimate"] == 1
    assert T.approx_tc_buckets(e, 1, BucketParams(p - 1, p - 1, p - 1), p).first()["estimate"] == 1
    assert T.approx_tc_partitions(e, 1, BucketParams(p - 1, p - 1, p - 1), p).first()["estimate"] == 1
    assert T.exact_tc_triplets(e, 5, LinearParams(p - 1, p - 1), p).first()["triangles"] == 1
    colors = {r["color"] for r in T.monochromatic(e, 1, LinearParams(p - 1, 3), p).collect()}
    assert colors == {0}
    for bad in (1, 2**61 - 1):
        with pytest.raises(ValueError):
            T.approx_tc_colors(e, 2, LinearParams(1, 1), bad)


def test_read_edges_from_text_file(spark, tmp_path):
    from countwise.sources import read_edges
    f = tmp_path / "g.txt"
    f.write_text("1,2\n2,3\n3,1\n3,4\n")
    e = canonical_edges(read_edges(spark, str(f)))
    assert T.exact_tc(e).first()["triangles"] == 1


def test_strict_and_permissive_edge_parsing(spark):
    from countwise.sources import rejected_edges
    lines = spark.createDataFrame([("1,2",), (" 3,4",), ("5,x",), ("6",), ("+7,-8",),
                                   ("9,99999999999",)], "value STRING")
    with pytest.raises(Exception):
        edges_from_text(lines).collect()  # Java rejects a blank before 3
    ok = sorted(map(tuple, edges_from_text(lines, strict=False).collect()))
    assert ok == [(1, 2), (7, -8)]
    assert sorted(r["value"] for r in rejected_edges(lines).collect()) == \
        sorted([" 3,4", "5,x", "6", "9,99999999999"])


@pytest.mark.parametrize("c", [1, 3, 4])
def test_triplet_methods_agree(partsupp, c):
    params = LinearParams(77, 5)
    a = sorted(map(tuple, T.triangles_by_triplet(partsupp, c, params, method="expand").collect()))
    b = sorted(map(tuple, T.triangles_by_triplet(partsupp, c, params, method="direct").collect()))
    assert a == b
    for method in T.TRIPLET_METHODS:
        assert T.exact_tc_triplets(partsupp, c, params, method=method).first()["triangles"] == 7852
