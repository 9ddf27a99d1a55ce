"""Property tests: Spark operators against plain-Python brute force on small
random inputs (same definitions, same hash family)."""

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import items_df
from countwise.functions import hash_family
from countwise.operators import frequency as Q
from countwise.operators import words as W

P = 8191


def java_split_space(s: str) -> list[str]:
    """Java String.split(" "): trailing empty strings removed; "" -> [""]."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="ab \t", max_size=12), min_size=1, max_size=6))
def test_tokens_match_java_split(spark, texts):
    rows = [(i, 0, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, line_no INT, text STRING")
    got = Counter((r["doc_id"], r["word"]) for r in W.tokenize(df).collect())
    want = Counter((i, w) for i, t in enumerate(texts) for w in java_split_space(t))
    assert got == want


def brute_sketch(items, family, width, left, right):
    table = {}
    for x in items:
        if left <= x <= right:
            for r in family:
                h = ((r.ah * (x % P) + r.bh) % P) % width
                g = -1 if ((r.ag * (x % P) + r.bg) % P) % 2 == 0 else 1
                table[(r.j, h)] = table.get((r.j, h), 0) + g
    return table


def brute_estimate(table, family, width, x):
    vals = []
    for r in family:
        h = ((r.ah * (x % P) + r.bh) % P) % width
        g = -1 if ((r.ag * (x % P) + r.bg) % P) % 2 == 0 else 1
        vals.append(g * table.get((r.j, h), 0))
    vals.sort()
    n = len(vals)
    if n % 2:
        return vals[n // 2]
    s = vals[n // 2 - 1] + vals[n // 2]
    return int(s / 2)  # truncate toward zero


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-5, 60), min_size=0, max_size=80), st.integers(1, 4),
       st.integers(2, 16), st.integers(0, 1000))
def test_sketch_and_estimates_match_brute_force(spark, items, depth, width, seed):
    left, right = 0, 40
    family = hash_family(seed, depth)
    df = items_df(spark, items)
    table = brute_sketch(items, family, width, left, right)
    got = {(r["j"], r["h"]): r["c"] for r in Q.count_sketch(df, family, width, left, right).collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in table.items() if v}
    freq = Q.item_frequencies(df, left, right)
    est = {r["item"]: r["est"] for r in
           Q.estimate_frequencies(Q.count_sketch(df, family, width, left, right), freq,
                                  family, width).collect()}
    seen = {x for x in items if left <= x <= right}
    assert est == {x: brute_estimate(table, family, width, x) for x in seen}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(1, 6))
def test_f2_and_top_k_match_brute_force(spark, items, k):
    df = items_df(spark, items)
    freq = Q.item_frequencies(df)
    counts = Counter(items)
    n = len(items)
    assert abs(Q.f2_exact(freq).first()["f2"] - sum(f * f for f in counts.values()) / (n * n)) \
        < 1e-12
    ordered = sorted(counts.values(), reverse=True)
    phi = ordered[min(k, len(ordered)) - 1]
    assert Q.kth_frequency(freq, k).first()["phi"] == phi
    top = {r["item"]: r["f"] for r in Q.top_k_items(freq, k).collect()}
    assert top == {x: f for x, f in counts.items() if f >= phi}
    st_ = Q.distinct_stats(df).first()
    assert (st_["n_items"], st_["n_distinct"], st_["max_item"]) == (n, len(counts), max(items))
    assert Q.in_range(df, 5, 10).agg(F.count("*")).first()[0] == \
        sum(1 for x in items if 5 <= x <= 10)
