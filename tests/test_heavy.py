"""Heavy items of wide intervals, selection of phi(K), four-wise signs, sketches
of distinct items, bucketed results and the life of intermediate tables."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import items_df
from countwise.functions.hashing import MAX_PRIME, cubic_hash, four_wise_family
from countwise.operators import frequency as Q
from countwise.operators.heavy import dyadic, dyadic_sketch, heavy_items
from countwise.session import checkpoint_root, scratch_scope, stored
from countwise.sources import items_parts
from countwise.sources.results import save_bucketed
from test_plans import plan


def freq_df(spark, counts):
    return spark.createDataFrame(sorted(counts.items()), "item BIGINT, f BIGINT")


def signed(r, x, p):
    return 1 if (r.ag * (x % p) + r.bg) % p % 2 else -1


def plain_heavy(counts, spec, threshold):
    """The same search over dictionaries."""
    inside = {x - spec.left: f for x, f in counts.items() if spec.left <= x <= spec.right}
    found = None
    for level, family in reversed(spec.families):
        cells = Counter()
        for x, f in inside.items():
            for r in family:
                cells[r.j, (r.ah * ((x >> level) % spec.p) + r.bh) % spec.p % spec.width] += signed(r, x >> level, spec.p) * f
        asked = range((spec.span >> level) + 1) if found is None else [
            c for x in found for c in range(x << spec.bits, (x + 1) << spec.bits) if c <= spec.span >> level]
        found = {}
        for x in asked:
            values = sorted(signed(r, x, spec.p) * cells[r.j, (r.ah * (x % spec.p) + r.bh) % spec.p % spec.width] for r in family)
            if values[len(values) // 2] >= threshold:
                found[x] = values[len(values) // 2]
    return sorted((x + spec.left, est) for x, est in found.items())


@pytest.mark.parametrize("left,right,bits", [(0, 2 ** 31 - 1, 4), (-1000, 5000, 3), (7, 7, 4), (0, 2 ** 31 - 1, 2), (10 ** 9, 10 ** 9 + 15, 4)])
def test_heavy_items_of_an_interval(spark, left, right, bits):
    rng = random.Random(right)
    counts = Counter(rng.randint(left, right) for _ in range(400))
    heavy = sorted({rng.randint(left, right) for _ in range(6)} | {left, right})
    counts.update({x: 300 for x in heavy})
    outside = Counter({left - 1: 5000, right + 1: 5000, right + 2 ** 33: 9000})
    spec = dyadic(left, right, 5, 512, 3, bits)
    sketch = stored(dyadic_sketch(freq_df(spark, counts + outside), spec), "test-dyadic")
    got = sorted(map(tuple, heavy_items(sketch, spec, F.lit(150)).collect()))
    assert got == plain_heavy(counts, spec, 150)
    assert set(heavy) <= {x for x, _ in got}
    # one light item may come with a heavy one in its cells; the rest of the interval does not
    assert len(got) <= len(heavy) + 20


def test_heavy_items_of_parts_add_up_and_of_nothing(spark):
    spec = dyadic(0, 2 ** 31 - 1, 5, 256, 1)
    parts = [Counter({5: 60, 9: 3}), Counter({5: 50, 2_000_000_000: 120})]
    sketches = [dyadic_sketch(freq_df(spark, c), spec) for c in parts]
    both = sketches[0].unionByName(sketches[1]).groupBy("level", "j", "h").agg(F.sum("c").cast("bigint").alias("c"))
    got = sorted(map(tuple, heavy_items(stored(both, "test-dyadic"), spec, F.lit(100)).collect()))
    assert got == plain_heavy(parts[0] + parts[1], spec, 100)
    assert {5, 2_000_000_000} <= {x for x, _ in got}
    assert heavy_items(dyadic_sketch(freq_df(spark, {}), spec), spec, F.lit(1)).count() == 0
    with pytest.raises(ValueError):
        dyadic(5, 4, 3, 16, 1)


# -- phi(K) ---------------------------------------------------------------------

@pytest.mark.parametrize("k", [1, 2, 3, 7, 8, 10 ** 6])
def test_kth_frequency_by_histogram(spark, k):
    items = [1] * 5 + [2] * 5 + [3] * 4 + [4] + [5] + [6] + [7] * 9
    values = sorted(Counter(items).values(), reverse=True)
    freq = Q.item_frequencies(items_df(spark, items))
    assert Q.kth_frequency(freq, k).first()["phi"] == values[min(k, len(values)) - 1]
    assert "TakeOrdered" not in plan(Q.kth_frequency(freq, k))
    assert Q.kth_frequency(Q.item_frequencies(items_df(spark, [])), k).first()["phi"] is None


def test_kth_frequency_of_a_million(spark):
    freq = spark.range(1_200_000).select(F.col("id").alias("item"), (F.col("id") % 1000 + 1).alias("f"))
    assert Q.kth_frequency(freq, 10 ** 6).first()["phi"] == 167  # frequencies of 168 and more make up 999,600 items


# -- four-wise signs ---------------------------------------------------------------

def test_cubic_hash_never_overflows(spark):
    rng = random.Random(2)
    p = MAX_PRIME
    xs = [0, 1, p - 1, p, p + 1, 2 ** 62, -1, -(2 ** 62)] + [rng.randrange(2 ** 40) for _ in range(30)]
    for c in ([p - 1] * 4, [rng.randrange(p) for _ in range(4)]):
        got = {r["item"]: r["h"] for r in items_df(spark, xs).select("item", cubic_hash("item", c).alias("h")).collect()}
        assert got == {x: (((c[0] * x + c[1]) * x + c[2]) * x + c[3]) % p for x in xs}


@pytest.mark.parametrize("seed", range(3))
def test_f2_by_four_wise_signs_is_within_ten_percent(spark, seed):
    freq = Q.item_frequencies(items_parts(spark, "/root/testdata/sf0.1")).cache()
    n = freq.agg(F.sum("f")).scalar()
    exact = Q.f2_exact(freq).first()["f2"]
    got = Q.f2_estimate(Q.four_wise_sketch(freq, four_wise_family(seed, 5), 1024), 5, n).first()["f2_est"]
    freq.unpersist()
    assert abs(got - exact) <= 0.1 * exact


# -- distinct items by sketches -----------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 100, 50_000])
def test_distinct_sketches_merge(spark, n):
    items = spark.range(3 * n).select((F.col("id") % n if n else F.col("id")).alias("item"), (F.col("id") % 5).alias("part"))
    items = items.unionByName(spark.createDataFrame([(None, 0)], "item BIGINT, part BIGINT"))
    parts = stored(Q.distinct_sketches(items, "part"), "test-distinct")
    one = Q.merged_distinct(parts).first()
    assert one["n_items"] == 3 * n + 1
    assert abs(one["est_distinct"] - n) <= Q.DISTINCT_ERROR * n
    # a part merged twice counts once
    assert Q.merged_distinct(parts.unionByName(parts)).first()["est_distinct"] == one["est_distinct"]
    assert Q.merged_distinct(parts.limit(0)).first()["est_distinct"] == 0


# -- stored results -----------------------------------------------------------------

def test_bucketed_results_join_without_an_exchange(spark):
    freq = Q.item_frequencies(items_parts(spark, "/root/testdata/sf0.001"))
    a, b = (save_bucketed(df, "item", 4) for df in (freq, freq.select("item", (F.col("f") * 2).alias("g"))))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, "item")
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        # merging two states needs none either
        merged = a.join(b, "item", "full").select("item", (F.coalesce("f", F.lit(0)) + F.coalesce("g", F.lit(0))).alias("f"))
        assert "Exchange" not in plan(merged)
        assert sorted(map(tuple, joined.collect())) == sorted((r["item"], r["f"], 2 * r["f"]) for r in freq.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def entries(spark):
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/countwise")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(at)} if fs.exists(at) else set()


def test_a_scope_removes_its_intermediates(spark, tmp_path):
    import __spark_entry__ as E

    before = entries(spark)
    with scratch_scope(spark):
        for name in ("exact_tc", "stream_frequencies", "heavy_items"):
            E.queries()[name](spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / name))
        assert entries(spark) > before
        with scratch_scope(spark):
            inner = stored(spark.range(3), "inner")
            assert inner.count() == 3
    assert entries(spark) == before
    assert spark.read.parquet(str(tmp_path / "exact_tc")).first()["triangles"] == 7852
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        stored(spark.range(3), "failed")
        1 / 0
    assert entries(spark) == before
