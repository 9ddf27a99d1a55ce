"""Registered queries and their DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the driver
tables; ``ORACLE_SQL[name]`` is the same result written as plain SQL for
DuckDB (tables registered as views).  Column names match one to one.
Every query has an SQL form.

Inputs: the graph is the part-supplier graph (one edge per lineitem
row), the item stream is ``lineitem.l_partkey`` (``events.user_id`` for
the distinct-items report and the second stream of the sketch merge),
the documents are the lines of ``documents.text``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countwise.functions.hashing import PRIME, vertex_color
from countwise.operators import frequency as fq
from countwise.operators import triangles as tri
from countwise.operators import words as wd
from countwise.operators.heavy import dyadic_sketch, heavy_items
from countwise.plans import params as P
from countwise.plans import reports as rp
from countwise.sources import readers as rd
from countwise.session import stored
from countwise.sources import tables as tb
from countwise.sources.results import save_bucketed

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def _lines(spark, d):
    return rd.document_lines(tb.documents(spark, d))


def _edges(spark, d):
    return rd.canonical_edges(tb.edges_partsupp(spark, d))


def _items(spark, d):
    return tb.items_parts(spark, d)


def _freq(spark, d):
    return fq.item_frequencies(_items(spark, d), P.LEFT, P.RIGHT)


def _sketch(spark, d):
    return fq.count_sketch(_items(spark, d), P.FAMILY, P.SKETCH_W, P.LEFT, P.RIGHT)


def q_edge_list(spark, d):
    text = tb.table(spark, d, "lineitem").select(
        F.concat_ws(",", "l_partkey", "l_suppkey").alias("value"))
    return rd.edges_from_text(text)


def q_vertex_colors(spark, d):
    e = _edges(spark, d)
    verts = e.select(F.explode(F.array("u", "v")).alias("vertex")).distinct()
    return verts.select("vertex", vertex_color("vertex", P.COLORS, P.COLORING.a,
                                               P.COLORING.b).alias("color"))


def q_item_hashes(spark, d):
    cand = _freq(spark, d).select("item")
    return fq.sketch_cells(cand, P.FAMILY, P.SKETCH_W)


def q_runs(spark, d):
    return tri.approx_tc_runs(_edges(spark, d), P.COLORS, P.RUN_PARAMS)


def q_merge_sketches(spark, d):
    a = fq.count_sketch(tb.items_parts(spark, d), P.FAMILY, P.SKETCH_W, P.LEFT, P.RIGHT)
    b = fq.count_sketch(tb.items_users(spark, d).select("item"), P.FAMILY, P.SKETCH_W,
                        P.LEFT, P.RIGHT)
    return fq.merge_sketches(a, b)


def q_estimates(spark, d):
    return fq.estimate_frequencies(_sketch(spark, d), _freq(spark, d).select("item"),
                                   P.FAMILY, P.SKETCH_W)


def q_estimates_range(spark, d):
    items = _items(spark, d)
    largest = items.agg(F.max("item")).first()[0]
    right = P.INTERVAL_RIGHT if largest is None else max(P.INTERVAL_RIGHT, min(P.RIGHT, largest))
    return fq.estimate_frequencies(_sketch(spark, d), fq.range_candidates(items, P.LEFT, right),
                                   P.FAMILY, P.SKETCH_W, candidates_by_item=False)


def q_estimate_median(spark, d):
    sketch = fq.count_sketch(_items(spark, d), P.FAMILY_EVEN, P.SKETCH_W, P.LEFT, P.RIGHT)
    return fq.estimate_frequencies(sketch, _freq(spark, d).select("item"), P.FAMILY_EVEN,
                                   P.SKETCH_W)


def q_sketch_from_freq(spark, d):
    return fq.sketch_from_frequencies(_freq(spark, d), P.FAMILY, P.SKETCH_W)


def q_f2_estimate(spark, d):
    n = fq.in_range(_items(spark, d), P.LEFT, P.RIGHT).agg(F.count(F.lit(1))).scalar()
    return fq.f2_estimate(_sketch(spark, d), P.SKETCH_D, n)


def q_heavy_items(spark, d):
    freq = _freq(spark, d)
    phi = fq.kth_frequency(freq, P.TOP_K).scalar()
    return heavy_items(stored(dyadic_sketch(freq, P.DYADIC), "dyadic-sketch"), P.DYADIC, phi)


def q_f2_four_wise(spark, d):
    freq = _freq(spark, d)
    n = freq.agg(F.coalesce(F.sum("f"), F.lit(0)).cast("bigint")).scalar()
    return fq.f2_estimate(fq.four_wise_sketch(freq, P.FOUR_WISE, P.FOUR_WISE_W), len(P.FOUR_WISE), n)


def q_distinct_by_sketch(spark, d):
    """The estimate from stored sketches of the parts, held against the exact number."""
    rows = tb.table(spark, d, "lineitem").select(
        F.col("l_partkey").cast("bigint").alias("item"), F.pmod("l_orderkey", F.lit(P.DISTINCT_PARTS)).alias("part"))
    merged = fq.merged_distinct(stored(fq.distinct_sketches(rows, "part"), "distinct-sketches"))
    exact = rows.agg(F.count_distinct("item")).scalar()
    return merged.select("n_sketches", "n_items", exact.alias("n_distinct"),
                         (F.abs(F.col("est_distinct") - exact) <= fq.DISTINCT_ERROR * exact).alias("within_error"))


def q_bucketed_estimates(spark, d):
    freq = save_bucketed(_freq(spark, d), "item", P.RESULT_BUCKETS)
    est = save_bucketed(q_estimates(spark, d), "item", P.RESULT_BUCKETS)
    return freq.join(est, "item").select("item", "f", "est")


def q_report_sketch(spark, d):
    return rp.report_sketch(_items(spark, d), P.FAMILY, P.SKETCH_W, P.LEFT, P.RIGHT, P.TOP_K)


def _stream(name):
    def run(spark, d):
        from countwise.streaming import catalog_streams
        return catalog_streams.run(name, spark, d)
    return run


QUERIES: dict[str, Query] = {
    # scans and layout
    "document_lines": _lines,
    "edge_list": q_edge_list,
    "canonical_edges": _edges,
    # projections and generators
    "tokens": lambda s, d: wd.tokenize(_lines(s, d)),
    "vertex_colors": q_vertex_colors,
    "item_hashes": q_item_hashes,
    "monochromatic_edges": lambda s, d: tri.monochromatic(_edges(s, d), P.COLORS, P.COLORING),
    "edge_color_triplets": lambda s, d: tri.expand_triplets(_edges(s, d), P.COLORS, P.COLORING),
    "items_in_range": lambda s, d: fq.in_range(_items(s, d), P.INNER_LEFT, P.INNER_RIGHT),
    # joins
    "triangles": lambda s, d: tri.triangles(_edges(s, d)),
    # word statistics
    "doc_word_counts": lambda s, d: wd.doc_word_counts(_lines(s, d)),
    "word_count": lambda s, d: wd.word_count(_lines(s, d)),
    "word_count_salted": lambda s, d: wd.word_count_salted(_lines(s, d), P.SALT_KEYS, P.SALT_SEED),
    "word_count_partitioned": lambda s, d: wd.word_count_by_partition(_lines(s, d)),
    "word_stats": lambda s, d: wd.word_stats(wd.word_count(_lines(s, d))),
    # triangle counts
    "triangles_by_color": lambda s, d: tri.triangles_by_color(_edges(s, d), P.COLORS, P.COLORING),
    "triangles_by_bucket": lambda s, d: tri.triangles_by_hash_bucket(_edges(s, d), P.BUCKETS,
                                                                     P.BUCKET_PARAMS),
    "triangles_by_triplet": lambda s, d: tri.triangles_by_triplet(
        _edges(s, d), P.COLORS, P.COLORING, method="expand"),
    "triangles_by_triplet_direct": lambda s, d: tri.triangles_by_triplet(
        _edges(s, d), P.COLORS, P.COLORING, method="direct"),
    "approx_tc_colors": lambda s, d: tri.approx_tc_colors(_edges(s, d), P.COLORS, P.COLORING),
    "approx_tc_runs": q_runs,
    "approx_tc_median": lambda s, d: tri.approx_tc_median(_edges(s, d), P.COLORS, P.RUN_PARAMS),
    "approx_tc_buckets": lambda s, d: tri.approx_tc_buckets(_edges(s, d), P.BUCKETS,
                                                            P.BUCKET_PARAMS),
    "approx_tc_partitions": lambda s, d: tri.approx_tc_partitions(_edges(s, d), P.BUCKETS,
                                                                  P.BUCKET_PARAMS),
    "exact_tc": lambda s, d: tri.exact_tc(_edges(s, d)),
    "exact_tc_id_order": lambda s, d: tri.exact_tc(_edges(s, d), order="id"),
    "exact_tc_triplets": lambda s, d: tri.exact_tc_triplets(_edges(s, d), P.COLORS, P.COLORING),
    # frequencies and sketch
    "item_frequencies": _freq,
    "count_sketch": _sketch,
    "merge_sketches": q_merge_sketches,
    "estimate_frequencies": q_estimates,
    "estimate_range": q_estimates_range,
    "estimate_median": q_estimate_median,
    "count_sketch_from_frequencies": q_sketch_from_freq,
    "f2_exact": lambda s, d: fq.f2_exact(_freq(s, d)),
    "f2_estimate": q_f2_estimate,
    "kth_frequency": lambda s, d: fq.kth_frequency(_freq(s, d), P.TOP_K),
    "top_k_items": lambda s, d: fq.top_k_with_estimates(_freq(s, d), _sketch(s, d), P.FAMILY,
                                                        P.SKETCH_W, P.TOP_K),
    "top_k_error": lambda s, d: fq.top_k_error(_freq(s, d), _sketch(s, d), P.FAMILY,
                                               P.SKETCH_W, P.TOP_K),
    "distinct_items": lambda s, d: fq.distinct_stats(_items(s, d)),
    "heavy_items": q_heavy_items,
    "f2_estimate_four_wise": q_f2_four_wise,
    "distinct_by_sketch": q_distinct_by_sketch,
    "bucketed_estimates": q_bucketed_estimates,
    # reports
    "report_words": lambda s, d: rp.report_words(_lines(s, d)),
    "report_word_counts": lambda s, d: rp.report_word_counts(_lines(s, d), P.SALT_KEYS,
                                                             P.SALT_SEED),
    "report_tc_approx": lambda s, d: rp.report_tc_approx(
        tb.edges_partsupp(s, d), P.COLORS, P.RUN_PARAMS, P.BUCKET_PARAMS),
    "report_tc_approx_partitions": lambda s, d: rp.report_tc_approx(
        tb.edges_partsupp(s, d), P.COLORS, P.RUN_PARAMS, P.BUCKET_PARAMS, subsets="partitions"),
    "report_tc": lambda s, d: rp.report_tc(tb.edges_partsupp(s, d), P.COLORS, P.RUN_PARAMS, 1,
                                           P.COLORING),
    "report_tc_colors": lambda s, d: rp.report_tc(tb.edges_partsupp(s, d), P.COLORS,
                                                  P.RUN_PARAMS, 0),
    "report_sketch": q_report_sketch,
    "report_distinct": lambda s, d: rp.report_distinct(tb.items_users(s, d).select("item")),
    # streaming (file source, availableNow; results read back in batch)
    "stream_frequencies": _stream("stream_frequencies"),
    "stream_frequencies_stateful": _stream("stream_frequencies_stateful"),
    "stream_count_sketch": _stream("stream_count_sketch"),
    "stream_distinct_items": _stream("stream_distinct_items"),
    "stream_distinct_set": _stream("stream_distinct_set"),
    "stream_prefix": _stream("stream_prefix"),
    "batch_counts": _stream("batch_counts"),
    "stream_report_sketch": _stream("stream_report_sketch"),
    "stream_report_distinct": _stream("stream_report_distinct"),
}


# --------------------------------------------------------------------------
# DuckDB side
# --------------------------------------------------------------------------

def _h(x: str, a, b, m) -> str:
    return f"((({a} * ({x} % {PRIME}) + {b}) % {PRIME}) % {m})"


def _color(x: str) -> str:
    return _h(x, P.COLORING.a, P.COLORING.b, P.COLORS)


_C2 = P.COLORS * P.COLORS
_B2 = P.BUCKETS * P.BUCKETS

S_LINES = ("SELECT doc_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS line_no, "
           "unnest(arr) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS arr "
           "FROM documents)")
S_TOKENS = (f"SELECT doc_id, line_no, unnest(CASE WHEN text = '' THEN [''] "
            f"WHEN rtrim(text, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM ({S_LINES})")
S_WORDS = f"SELECT word, count(*) AS n FROM ({S_TOKENS}) GROUP BY word"
S_RAW = ("SELECT CAST(l_partkey AS BIGINT) AS u, CAST(l_suppkey AS BIGINT) AS v "
         "FROM lineitem")
S_EDGES = (f"SELECT DISTINCT least(u, v) AS u, greatest(u, v) AS v FROM ({S_RAW}) "
           f"WHERE u <> v")
W_E = f"WITH e AS ({S_EDGES}) "
S_TRI = ("SELECT x.u AS u, x.v AS v, y.v AS w FROM e x JOIN e y ON x.v = y.u "
         "JOIN e z ON z.u = x.u AND z.v = y.v")
S_MONO = (f"SELECT {_color('u')} AS color, u, v FROM e "
          f"WHERE {_color('u')} = {_color('v')}")
S_ITEMS = "SELECT CAST(l_partkey AS BIGINT) AS item FROM lineitem"
S_USERS = "SELECT CAST(user_id AS BIGINT) AS item FROM events"
S_INR = f"SELECT item FROM ({S_ITEMS}) WHERE item BETWEEN {P.LEFT} AND {P.RIGHT}"
S_FREQ = f"SELECT item, count(*) AS f FROM ({S_INR}) GROUP BY item"
def _family_sql(family) -> str:
    return ("SELECT * FROM (VALUES " + ", ".join(
        f"({r.j}, {r.ah}, {r.bh}, {r.ag}, {r.bg})" for r in family) + ") AS t(j, ah, bh, ag, bg)")


S_FAMILY = _family_sql(P.FAMILY)


def _cells(src: str, extra: str = "", family_sql: str = S_FAMILY) -> str:
    h = _h("i.item", "f.ah", "f.bh", P.SKETCH_W)
    g = f"CASE WHEN {_h('i.item', 'f.ag', 'f.bg', 2)} = 0 THEN -1 ELSE 1 END"
    return (f"SELECT i.item AS item{extra}, CAST(f.j AS BIGINT) AS j, CAST({h} AS BIGINT) AS h, "
            f"CAST({g} AS BIGINT) AS g FROM ({src}) i CROSS JOIN ({family_sql}) f")


def _sketch_of(src: str, family_sql: str = S_FAMILY) -> str:
    return (f"SELECT j, h, CAST(sum(g) AS BIGINT) AS c FROM ({_cells(src, '', family_sql)}) "
            f"GROUP BY j, h")


S_SKETCH = _sketch_of(S_INR)


def _median(lst: str) -> str:
    n = f"len({lst})"
    return (f"(CASE WHEN {n} = 0 THEN NULL WHEN {n} % 2 = 1 THEN {lst}[{n} // 2 + 1] "
            f"ELSE ({lst}[{n} // 2] + {lst}[{n} // 2 + 1]) // 2 END)")


def _estimates(cands: str, extra: str = "", family_sql: str = S_FAMILY) -> str:
    # cands: SELECT item[, f] ...
    cells = _cells(cands, ", i.f" if extra else "", family_sql)
    keep = ", f" if extra else ""
    sketch = _sketch_of(S_INR, family_sql)
    return (f"SELECT item{keep}, CAST({_median('list_sort(list(x.g * coalesce(s.c, 0)))')} "
            f"AS BIGINT) AS est FROM ({cells}) x LEFT JOIN ({sketch}) s "
            f"ON x.j = s.j AND x.h = s.h GROUP BY item{keep}")


S_PHI = f"SELECT min(f) AS phi FROM (SELECT f FROM ({S_FREQ}) ORDER BY f DESC LIMIT {P.TOP_K})"
S_TOP = f"SELECT item, f FROM ({S_FREQ}) WHERE f >= ({S_PHI})"
S_TOPEST = _estimates(S_TOP, extra="f")
S_ERR = (f"SELECT round(avg(abs(f - est) / CAST(f AS DOUBLE)), 12) AS avg_rel_err "
         f"FROM ({S_TOPEST})")
S_F2 = (f"SELECT CAST(s2 AS DOUBLE) / nullif(CAST(n AS DOUBLE) * CAST(n AS DOUBLE), 0.0) AS f2 "
        f"FROM (SELECT sum(CAST(f AS HUGEINT) * f) AS s2, sum(f) AS n FROM ({S_FREQ}))")
S_F2EST = (
    f"SELECT CAST({_median('list_sort(list(s))')} AS DOUBLE) / "
    f"nullif(CAST((SELECT count(*) FROM ({S_INR})) AS DOUBLE) * "
    f"CAST((SELECT count(*) FROM ({S_INR})) AS DOUBLE), 0.0) AS f2_est FROM ("
    f"SELECT r.j, CAST(coalesce(sum(CAST(k.c AS HUGEINT) * k.c), 0) AS BIGINT) AS s "
    f"FROM range(0, {P.SKETCH_D}) r(j) LEFT JOIN ({S_SKETCH}) k ON k.j = r.j GROUP BY r.j)")

def _linear(x: str, a, b, m, p: int) -> str:
    return f"((({a} * ({x} % {p}) + {b}) % {p}) % {m})"


def _heavy_sql() -> str:
    """The dyadic search, one step per level."""
    spec = P.DYADIC
    family = ", ".join(f"({level}, {r.j}, {r.ah}, {r.bh}, {r.ag}, {r.bg})" for level, rows in spec.families for r in rows)

    def cell(prefix: str) -> str:
        return _linear(prefix, "f.ah", "f.bh", spec.width, spec.p)

    def sign(prefix: str) -> str:
        return f"CASE WHEN {_linear(prefix, 'f.ag', 'f.bg', 2, spec.p)} = 0 THEN -1 ELSE 1 END"

    prefix = f"((q.item - {spec.left}) >> f.level)"
    out = (f"WITH freq AS ({S_FREQ}), phi AS ({S_PHI}), "
           f"family AS (SELECT * FROM (VALUES {family}) AS t(level, j, ah, bh, ag, bg)), "
           f"cells AS (SELECT f.level, f.j, {cell(prefix)} AS h, CAST(sum({sign(prefix)} * q.f) AS BIGINT) AS c "
           f"FROM freq q CROSS JOIN family f GROUP BY f.level, f.j, h)")
    above = None
    for level, _ in reversed(spec.families):
        last = spec.span >> level
        asked = (f"SELECT CAST(range AS BIGINT) AS x FROM range(0, {last + 1})" if above is None else
                 f"SELECT x FROM (SELECT unnest(range(x << {spec.bits}, (x + 1) << {spec.bits})) AS x FROM e{above}) WHERE x <= {last}")
        out += (f", c{level} AS ({asked}), e{level} AS (SELECT x, {_median('list_sort(list(g * coalesce(c, 0)))')} AS est FROM ("
                f"SELECT a.x, {sign('a.x')} AS g, s.c FROM c{level} a CROSS JOIN (SELECT * FROM family WHERE level = {level}) f "
                f"LEFT JOIN cells s ON s.level = {level} AND s.j = f.j AND s.h = {cell('a.x')}) GROUP BY x "
                f"HAVING est >= (SELECT phi FROM phi))")
        above = level
    return f"{out} SELECT x + {spec.left} AS item, CAST(est AS BIGINT) AS est FROM e0"


def _f2_four_wise_sql() -> str:
    p = (1 << 31) - 1
    family = ", ".join(f"({r.j}, {r.ah}, {r.bh}, {', '.join(map(str, r.g))})" for r in P.FOUR_WISE)
    x = f"(q.item % {p})"
    cubic = f"(((((r.g0 * {x} + r.g1) % {p}) * {x} + r.g2) % {p}) * {x} + r.g3) % {p}"
    cells = (f"SELECT r.j, {_linear('q.item', 'r.ah', 'r.bh', P.FOUR_WISE_W, p)} AS h, "
             f"sum(CASE WHEN ({cubic}) % 2 = 1 THEN q.f ELSE -q.f END) AS c "
             f"FROM ({S_FREQ}) q CROSS JOIN (SELECT * FROM (VALUES {family}) AS t(j, ah, bh, g0, g1, g2, g3)) r GROUP BY r.j, h")
    rows = f"SELECT r.j, coalesce(sum(CAST(k.c AS HUGEINT) * k.c), 0) AS s FROM range(0, {len(P.FOUR_WISE)}) r(j) LEFT JOIN ({cells}) k ON k.j = r.j GROUP BY r.j"
    n = f"CAST((SELECT count(*) FROM ({S_INR})) AS DOUBLE)"
    return f"SELECT CAST({_median('list_sort(list(s))')} AS DOUBLE) / nullif({n} * {n}, 0.0) AS f2_est FROM ({rows})"


S_F2_FOUR_WISE = _f2_four_wise_sql()

S_RUNS = ("SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {prm.a}, {prm.b})" for i, prm in enumerate(P.RUN_PARAMS)) + ") AS t(run, a, b)")


def _runs_sql() -> str:
    cu = _h("e.u", "r.a", "r.b", P.COLORS)
    cv = _h("e.v", "r.a", "r.b", P.COLORS)
    mono = f"SELECT r.run, e.u, e.v FROM e CROSS JOIN ({S_RUNS}) r WHERE {cu} = {cv}"
    tri_sql = (f"SELECT x.run, count(*) AS t FROM m x JOIN m y ON x.run = y.run AND x.v = y.u "
               f"JOIN m z ON z.run = x.run AND z.u = x.u AND z.v = y.v GROUP BY x.run")
    return (f"{W_E}, m AS ({mono}) SELECT CAST(r.run AS INTEGER) AS run, "
            f"CAST({_C2} * coalesce(t.t, 0) AS BIGINT) AS estimate "
            f"FROM ({S_RUNS}) r LEFT JOIN ({tri_sql}) t ON t.run = r.run")


S_RUNS_EST = _runs_sql()
S_MEDIAN_RUNS = (f"SELECT CAST({_median('list_sort(list(estimate))')} AS BIGINT) AS estimate "
                 f"FROM ({S_RUNS_EST})")


def _bucket(x: str = "") -> str:
    bp = P.BUCKET_PARAMS
    u, v = (f"{x}.u", f"{x}.v") if x else ("u", "v")
    return (f"((({bp.a} * ({u} % {PRIME}) + {bp.b} * ({v} % {PRIME}) + {bp.c}) % {PRIME}) "
            f"% {P.BUCKETS})")


S_BUCKET_T = (f"{W_E}, b AS (SELECT {_bucket()} AS bucket, u, v FROM e) "
              f"SELECT CAST(x.bucket AS BIGINT) AS bucket, count(*) AS t FROM b x "
              f"JOIN b y ON x.bucket = y.bucket AND x.v = y.u "
              f"JOIN b z ON z.bucket = x.bucket AND z.u = x.u AND z.v = y.v GROUP BY x.bucket")
_BP = P.BUCKET_PARAMS
S_PARTITION_EST = (
    f"{W_E}, b AS (SELECT (row_number() OVER (ORDER BY "
    f"({_BP.a} * (u % {PRIME}) + {_BP.b} * (v % {PRIME}) + {_BP.c}) % {PRIME}, u, v) - 1) "
    f"% {P.BUCKETS} AS bucket, u, v FROM e) "
    f"SELECT CAST({_B2} * count(*) AS BIGINT) AS estimate FROM b x "
    f"JOIN b y ON x.bucket = y.bucket AND x.v = y.u "
    f"JOIN b z ON z.bucket = x.bucket AND z.u = x.u AND z.v = y.v")
S_COLOR_T = (f"{W_E}, m AS ({S_MONO}) SELECT CAST(x.color AS BIGINT) AS color, count(*) AS t "
             f"FROM m x JOIN m y ON x.color = y.color AND x.v = y.u "
             f"JOIN m z ON z.color = x.color AND z.u = x.u AND z.v = y.v GROUP BY x.color")
S_TRIPLET_T = (
    f"{W_E}, t AS ({S_TRI}), k AS (SELECT list_sort([{_color('u')}, {_color('v')}, "
    f"{_color('w')}]) AS k FROM t) SELECT CAST(k[1] AS BIGINT) AS k1, CAST(k[2] AS BIGINT) AS k2, "
    f"CAST(k[3] AS BIGINT) AS k3, count(*) AS t FROM k GROUP BY k[1], k[2], k[3]")
S_EXACT = f"{W_E} SELECT count(*) AS triangles FROM ({S_TRI})"
S_WORDSTATS_BODY = ("count(*) AS n_distinct_words, "
                    "CAST(coalesce(sum(length(word)), 0) AS BIGINT) AS total_word_length, "
                    "CAST(sum(length(word)) // count(*) AS BIGINT) AS avg_word_length, "
                    "CAST(coalesce(sum(length(word)), 0) AS BIGINT) / "
                    "nullif(CAST(count(*) AS DOUBLE), 0.0) AS avg_word_length_exact")

S_REPORT_SKETCH = (
    f"SELECT {P.SKETCH_D} AS \"D\", {P.SKETCH_W} AS \"W\", {P.LEFT} AS \"left\", "
    f"{P.RIGHT} AS \"right\", {P.TOP_K} AS \"K\", (SELECT count(*) FROM ({S_ITEMS})) AS n_items, "
    f"(SELECT count(*) FROM ({S_INR})) AS n_in_range, "
    f"{P.RIGHT - P.LEFT + 1} AS range_width, "
    f"(SELECT count(*) FROM ({S_FREQ})) AS distinct_items, ({S_ERR}) AS avg_rel_err, "
    f"({S_F2}) AS f2, ({S_F2EST}) AS f2_est")


def _prefix(table: str, key: str, n: int) -> tuple[str, str]:
    """(batches, condition): the arrivals with their lengths, and whether a
    row's arrival begins before n items are committed."""
    part = f"{key} % {P.STREAM_ARRIVALS}"
    batches = (f"SELECT k, n, coalesce(sum(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 "
               f"PRECEDING), 0) AS before FROM (SELECT {part} AS k, count(*) AS n FROM {table} GROUP BY 1)")
    return batches, f"{part} IN (SELECT k FROM ({batches}) WHERE before < {n})"


S_BATCHES, S_IN_PREFIX = _prefix("lineitem", "l_orderkey", P.PREFIX_ITEMS)
_, S_USER_PREFIX = _prefix("events", "event_id", P.PREFIX_USERS)

ORACLE_SQL: dict[str, str] = {
    "document_lines": S_LINES,
    "edge_list": S_RAW,
    "canonical_edges": S_EDGES,
    "tokens": S_TOKENS,
    "vertex_colors": (f"{W_E} SELECT vertex, CAST({_color('vertex')} AS BIGINT) AS color FROM "
                      f"(SELECT u AS vertex FROM e UNION SELECT v FROM e)"),
    "item_hashes": _cells(f"SELECT item FROM ({S_FREQ})"),
    "monochromatic_edges": f"{W_E} SELECT CAST(color AS BIGINT) AS color, u, v FROM ({S_MONO})",
    "edge_color_triplets": (
        f"{W_E} SELECT CAST(k[1] AS BIGINT) AS k1, CAST(k[2] AS BIGINT) AS k2, "
        f"CAST(k[3] AS BIGINT) AS k3, u, v FROM (SELECT u, v, list_sort([{_color('u')}, "
        f"{_color('v')}, i]) AS k FROM e CROSS JOIN range(0, {P.COLORS}) r(i))"),
    "items_in_range": (f"SELECT item FROM ({S_ITEMS}) "
                       f"WHERE item BETWEEN {P.INNER_LEFT} AND {P.INNER_RIGHT}"),
    "triangles": f"{W_E} {S_TRI}",
    "doc_word_counts": (f"SELECT doc_id, line_no, word, count(*) AS n FROM ({S_TOKENS}) "
                        f"GROUP BY doc_id, line_no, word"),
    "word_count": S_WORDS,
    "word_count_salted": S_WORDS,
    "word_count_partitioned": S_WORDS,
    "word_stats": f"SELECT {S_WORDSTATS_BODY} FROM ({S_WORDS})",
    "triangles_by_color": S_COLOR_T,
    "triangles_by_bucket": S_BUCKET_T,
    "triangles_by_triplet": S_TRIPLET_T,
    "triangles_by_triplet_direct": S_TRIPLET_T,
    "approx_tc_colors": (f"{W_E}, m AS ({S_MONO}) SELECT CAST({_C2} * count(*) AS BIGINT) "
                         f"AS estimate FROM m x JOIN m y ON x.v = y.u "
                         f"JOIN m z ON z.u = x.u AND z.v = y.v"),
    "approx_tc_runs": S_RUNS_EST,
    "approx_tc_median": S_MEDIAN_RUNS,
    "approx_tc_buckets": (f"SELECT CAST({_B2} * coalesce(sum(t), 0) AS BIGINT) AS estimate "
                          f"FROM ({S_BUCKET_T})"),
    "approx_tc_partitions": S_PARTITION_EST,
    "exact_tc": S_EXACT,
    "exact_tc_id_order": S_EXACT,
    "exact_tc_triplets": (f"SELECT CAST(coalesce(sum(t), 0) AS BIGINT) AS triangles "
                          f"FROM ({S_TRIPLET_T})"),
    "item_frequencies": S_FREQ,
    "count_sketch": S_SKETCH,
    "merge_sketches": _sketch_of(
        f"SELECT item FROM ({S_ITEMS} UNION ALL {S_USERS}) "
        f"WHERE item BETWEEN {P.LEFT} AND {P.RIGHT}"),
    "estimate_frequencies": _estimates(f"SELECT item FROM ({S_FREQ})"),
    "estimate_range": _estimates(f"SELECT CAST(range AS BIGINT) AS item "
                                 f"FROM range({P.LEFT}, (SELECT greatest({P.INTERVAL_RIGHT}, least({P.RIGHT}, coalesce(max(item), {P.LEFT}))) + 1 FROM ({S_ITEMS})))"),
    "estimate_median": _estimates(f"SELECT item FROM ({S_FREQ})",
                                  family_sql=_family_sql(P.FAMILY_EVEN)),
    "count_sketch_from_frequencies": (
        f"SELECT j, h, CAST(sum(g * f) AS BIGINT) AS c FROM ({_cells(S_FREQ, extra=', i.f')}) "
        f"GROUP BY j, h"),
    "f2_exact": S_F2,
    "f2_estimate": S_F2EST,
    "kth_frequency": S_PHI,
    "top_k_items": S_TOPEST,
    "top_k_error": S_ERR,
    "distinct_items": (f"SELECT count(*) AS n_items, count(DISTINCT item) AS n_distinct, "
                       f"max(item) AS max_item FROM ({S_ITEMS})"),
    "heavy_items": _heavy_sql(),
    "f2_estimate_four_wise": S_F2_FOUR_WISE,
    "distinct_by_sketch": (f"SELECT {P.DISTINCT_PARTS} AS n_sketches, count(*) AS n_items, "
                           f"count(DISTINCT item) AS n_distinct, TRUE AS within_error FROM ({S_ITEMS})"),
    "bucketed_estimates": _estimates(S_FREQ, extra="f"),
    "report_words": (f"SELECT (SELECT count(*) FROM ({S_LINES})) AS n_docs, "
                     f"count(*) AS n_distinct_words, "
                     f"CAST(sum(length(word)) // count(*) AS BIGINT) AS avg_word_length "
                     f"FROM ({S_WORDS})"),
    "report_word_counts": (f"SELECT (SELECT count(*) FROM ({S_LINES})) AS n_docs, "
                           f"count(*) AS n_words_one_round, count(*) AS n_words_salted, "
                           f"count(*) AS n_words_partitioned, "
                           f"CAST(sum(length(word)) // count(*) AS BIGINT) AS avg_word_length "
                           f"FROM ({S_WORDS})"),
    "report_tc_approx": (
        f"SELECT (SELECT count(*) FROM lineitem) AS n_edges, {P.COLORS} AS \"C\", "
        f"{P.RUNS} AS \"R\", ({S_MEDIAN_RUNS}) AS est_colors_median, "
        f"(SELECT CAST({_B2} * coalesce(sum(t), 0) AS BIGINT) FROM ({S_BUCKET_T})) "
        f"AS est_partitions"),
    "report_tc_approx_partitions": (
        f"SELECT (SELECT count(*) FROM lineitem) AS n_edges, {P.COLORS} AS \"C\", "
        f"{P.RUNS} AS \"R\", ({S_MEDIAN_RUNS}) AS est_colors_median, "
        f"({S_PARTITION_EST}) AS est_partitions"),
    "report_tc": (
        f"SELECT (SELECT count(*) FROM lineitem) AS n_edges, {P.COLORS} AS \"C\", "
        f"{P.RUNS} AS \"R\", 1 AS mode, ({S_EXACT}) AS triangles"),
    "report_tc_colors": (
        f"SELECT (SELECT count(*) FROM lineitem) AS n_edges, {P.COLORS} AS \"C\", "
        f"{P.RUNS} AS \"R\", 0 AS mode, ({S_MEDIAN_RUNS}) AS triangles"),
    "report_sketch": S_REPORT_SKETCH,
    "report_distinct": (f"SELECT count(*) AS n_items, count(DISTINCT item) AS n_distinct, "
                        f"max(item) AS max_item FROM ({S_USERS})"),
    # streams equal their batch counterparts
    "stream_frequencies": S_FREQ,
    "stream_frequencies_stateful": S_FREQ,
    "stream_count_sketch": S_SKETCH,
    "stream_distinct_items": (f"SELECT count(*) AS n_items, count(DISTINCT item) AS n_distinct, "
                              f"max(item) AS max_item FROM ({S_USERS})"),
    "stream_distinct_set": "SELECT DISTINCT CAST(user_id AS BIGINT) AS item FROM events",
    "batch_counts": f"SELECT CAST(k AS INTEGER) AS batch_id, n AS n_items FROM ({S_BATCHES})",
    "stream_prefix": (f"SELECT CAST(sum(n) AS BIGINT) AS n_items, count(*) AS n_batches "
                      f"FROM ({S_BATCHES}) WHERE before < {P.PREFIX_ITEMS}"),
    "stream_report_sketch": S_REPORT_SKETCH.replace("FROM lineitem", f"FROM lineitem WHERE {S_IN_PREFIX}"),
    "stream_report_distinct": (f"SELECT count(*) AS n_items, count(DISTINCT item) AS n_distinct, "
                               f"max(item) AS max_item FROM ({S_USERS} WHERE {S_USER_PREFIX})"),
}
