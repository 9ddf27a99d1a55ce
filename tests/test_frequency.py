import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, items_df
from countwise.functions import hash_family, int_median
from countwise.functions.hashing import SketchRow
from countwise.operators import frequency as Q
from countwise.plans.reports import report_sketch
from countwise.sources import items_parts

TINY = [1, 1, 2, 3, 3, 3, 9]


def freq_map(df):
    return {r["item"]: r["f"] for r in df.collect()}


def test_tiny_stream(spark):
    items = items_df(spark, TINY)
    freq = Q.item_frequencies(items, 1, 3)
    assert freq_map(freq) == {1: 2, 2: 1, 3: 3}
    assert Q.f2_exact(freq).first()["f2"] == pytest.approx(14 / 36)
    assert Q.kth_frequency(freq, 2).first()["phi"] == 2
    assert freq_map(Q.top_k_items(freq, 2)) == {3: 3, 1: 2}
    st = Q.distinct_stats(items).first()
    assert (st["n_items"], st["n_distinct"], st["max_item"]) == (7, 4, 9)


def test_ties(spark):
    freq = Q.item_frequencies(items_df(spark, [1, 1, 2, 2, 3]))
    assert freq_map(Q.top_k_items(freq, 1)) == {1: 2, 2: 2}


def test_k_beyond_items_and_bad_k(spark):
    freq = Q.item_frequencies(items_df(spark, [5, 5, 6]))
    assert freq_map(Q.top_k_items(freq, 10)) == {5: 2, 6: 1}
    with pytest.raises(ValueError):
        Q.kth_frequency(freq, 0)


def test_no_collision_is_exact(spark):
    items = items_df(spark, TINY)
    fam = hash_family(3, 5)
    sketch = Q.count_sketch(items, fam, 8191, 1, 3)
    freq = Q.item_frequencies(items, 1, 3)
    est = Q.estimate_frequencies(sketch, freq, fam, 8191, keep=["f"]).collect()
    assert all(r["est"] == r["f"] for r in est)
    n = F.lit(6)
    assert Q.f2_estimate(sketch, 5, n).first()["f2_est"] == pytest.approx(14 / 36)
    assert Q.top_k_error(freq, sketch, fam, 8191, 2).first()["avg_rel_err"] == 0.0
    rep = report_sketch(items, fam, 8191, 1, 3, 2).first()
    assert (rep["n_items"], rep["n_in_range"], rep["range_width"], rep["distinct_items"]) == \
        (7, 6, 3, 3)
    assert rep["avg_rel_err"] == 0.0
    assert rep["f2"] == pytest.approx(14 / 36) and rep["f2_est"] == pytest.approx(14 / 36)


def test_empty_range(spark):
    items = items_df(spark, [9, 9])
    fam = hash_family(3, 3)
    rep = report_sketch(items, fam, 16, 1, 3, 2).first()
    assert rep["n_in_range"] == 0 and rep["distinct_items"] == 0
    assert rep["f2"] is None and rep["f2_est"] is None and rep["avg_rel_err"] is None
    freq = Q.item_frequencies(items, 1, 3)
    assert Q.top_k_items(freq, 2).count() == 0


def test_median_rows(spark):
    df = spark.createDataFrame([([5, 1, 9],), ([4, 1, 2, 9],), ([-3, -2],), ([],)],
                               "x ARRAY<BIGINT>")
    got = [r["m"] for r in df.select(int_median("x").alias("m")).collect()]
    assert got == [5, 3, -2, None]


def test_hash_of_known_family(spark):
    # h = ((3*x + 5) mod 8191) mod 4, g parity of ((7*x + 1) mod 8191)
    fam = [SketchRow(0, 3, 5, 7, 1)]
    cells = Q.sketch_cells(items_df(spark, [10, 8191 + 10, -1]), fam, 4).collect()
    hs = [(r["item"], r["h"], r["g"]) for r in cells]
    assert hs[0] == (10, (3 * 10 + 5) % 8191 % 4, -1 if (7 * 10 + 1) % 8191 % 2 == 0 else 1)
    assert hs[1][1:] == hs[0][1:]  # ids equal mod p collide
    x = (-1) % 8191
    assert hs[2][1] == (3 * x + 5) % 8191 % 4


@pytest.fixture(scope="module")
def parts(spark):
    df = items_parts(spark, SF_SMALL).cache()
    yield df
    df.unpersist()


def test_sketch_is_linear(spark, parts):
    fam = hash_family(11, 4)
    direct = Q.count_sketch(parts, fam, 64, 20, 150)
    via_freq = Q.sketch_from_frequencies(Q.item_frequencies(parts, 20, 150), fam, 64)
    key = lambda df: sorted((r["j"], r["h"], r["c"]) for r in df.collect() if r["c"] != 0)
    assert key(direct) == key(via_freq)
    a = Q.count_sketch(parts.where("item % 2 = 0"), fam, 64, 20, 150)
    b = Q.count_sketch(parts.where("item % 2 = 1"), fam, 64, 20, 150)
    assert key(Q.merge_sketches(a, b)) == key(direct)


def test_range_candidates_cover_unseen(spark, parts):
    fam = hash_family(11, 3)
    sketch = Q.count_sketch(parts, fam, 64, 20, 150)
    cands = Q.range_candidates(parts, 20, 150)
    est = Q.estimate_frequencies(sketch, cands, fam, 64)
    assert est.count() == 131


@pytest.mark.parametrize("largest", [3, 1_000_004])
def test_registered_range_is_whole(spark, tmp_path, largest):
    """The whole interval is estimated however small the table's items are, and beyond it up to the largest."""
    from countwise.plans.catalog import QUERIES

    spark.createDataFrame([(1,), (1,), (largest,)], "l_partkey BIGINT").write.parquet(f"{tmp_path}/lineitem.parquet")
    est = QUERIES["estimate_range"](spark, str(tmp_path))
    row = est.agg(F.count("item").alias("n"), F.min("item").alias("lo"), F.max("item").alias("hi")).first()
    right = max(999_999, largest)
    assert tuple(row) == (right + 1, 0, right)


def test_width_above_prime_warns(spark, parts):
    with pytest.warns(UserWarning):
        Q.count_sketch(parts, hash_family(1, 2), 9000)


def test_second_moments_past_bigint(spark):
    # f ~ 4e10: f^2 ~ 1.6e21 is past BIGINT; the sums must stay exact
    big = 40_000_000_000
    freq = spark.createDataFrame([(1, big), (2, big), (3, 1)], "item BIGINT, f BIGINT")
    n = 2 * big + 1
    assert Q.f2_exact(freq).first()["f2"] == pytest.approx((2 * big * big + 1) / (n * n))
    sketch = spark.createDataFrame([(0, 0, big), (0, 1, big), (1, 0, 2 * big)],
                                   "j BIGINT, h BIGINT, c BIGINT")
    got = Q.f2_estimate(sketch, 2, F.lit(n)).first()["f2_est"]
    # rows: 2*big^2 and 4*big^2 -> median = 3*big^2
    assert got == pytest.approx(3 * big * big / (n * n))


def test_wide_median(spark):
    from decimal import Decimal
    df = spark.createDataFrame([([Decimal(10**20), Decimal(3)],), ([Decimal(-5), Decimal(-2)],)],
                               "x ARRAY<DECIMAL(38,0)>")
    got = [r["m"] for r in df.select(int_median("x", wide=True).alias("m")).collect()]
    assert [int(v) for v in got] == [(10**20 + 3) // 2, -3]


def test_estimates_same_on_both_join_paths(spark, parts, monkeypatch):
    fam = hash_family(9, 4)
    sketch = Q.count_sketch(parts, fam, 32, 0, 150)
    freq = Q.item_frequencies(parts, 0, 150)
    broadcast_path = sorted(map(tuple, Q.estimate_frequencies(sketch, freq, fam, 32,
                                                              keep=["f"]).collect()))
    lookup_path = sorted(map(tuple, Q.estimate_frequencies(sketch, freq, fam, 32, keep=["f"],
                                                           candidates_by_item=False).collect()))
    assert lookup_path == broadcast_path
    monkeypatch.setattr(Q, "BROADCAST_MAX_CELLS", 0)
    shuffle_path = sorted(map(tuple, Q.estimate_frequencies(sketch, freq, fam, 32,
                                                            keep=["f"]).collect()))
    assert broadcast_path == shuffle_path and len(broadcast_path) == freq.count()
