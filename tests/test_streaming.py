import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from countwise.functions import hash_family
from countwise.operators import frequency as Q
from countwise.session import scratch_path
from countwise.sources import items_parts
from countwise.streaming import items as S
from countwise.streaming import state as T
from countwise.streaming.catalog_streams import land_items

FAM = hash_family(5, 3)


@pytest.fixture(scope="module")
def landed(spark):
    items = items_parts(spark, SF_SMALL)
    root = scratch_path(spark, "test-stream")
    return items, land_items(items.repartition(3), f"{root}/landing"), root


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def folders(spark, path):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(f.getPath().getName() for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at))


def test_frequencies_equal_batch_and_a_restart_adds_what_is_new(spark, landed):
    items, _, root = landed
    src, ckpt = land_items(items.repartition(3), f"{root}/f-landing"), f"{root}/f-ckpt"
    for _ in range(2):  # the second run finds nothing new, and doubles nothing
        S.run_to_end(T.start_frequencies(S.item_stream(spark, src), ckpt, 10, 120))
        assert rows(T.running_frequencies(spark, ckpt), "item", "f") == rows(Q.item_frequencies(items, 10, 120), "item", "f")
        assert T.last_batch(spark, ckpt) == 2
    extra = spark.createDataFrame([(11,), (11,), (999999,), (None,)], "item BIGINT").coalesce(1)
    land_items(extra, src)
    S.run_to_end(T.start_frequencies(S.item_stream(spark, src), ckpt, 10, 120))
    want = rows(Q.item_frequencies(items.unionByName(extra), 10, 120), "item", "f")
    assert rows(T.running_frequencies(spark, ckpt), "item", "f") == want
    # the state as of an earlier batch
    assert rows(T.running_frequencies(spark, ckpt, 2), "item", "f") == rows(Q.item_frequencies(items, 10, 120), "item", "f")


def test_state_is_kept_by_rocksdb_with_changelogs_and_nothing_else(spark, landed):
    items, src, root = landed
    ckpt = f"{root}/only-ckpt"
    S.run_to_end(T.start_frequencies(S.item_stream(spark, src), ckpt))
    assert {"commits", "offsets", "sources", "state"} <= set(folders(spark, ckpt))
    assert any(name.endswith(".changelog") for name in folders(spark, f"{ckpt}/state/0/0"))
    # the session's own settings are as before
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_a_batch_that_failed_is_run_again_and_counts_once(spark, landed):
    items, _, root = landed
    src, ckpt = land_items(items.repartition(2), f"{root}/again-landing"), f"{root}/again-ckpt"
    bad = F.when(F.col("item") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("item")).cast("bigint")
    stream = S.item_stream(spark, src, max_files_per_trigger=None)
    with pytest.raises(Exception, match="lost"):
        S.run_to_end(T.start_frequencies(stream.select(bad.alias("item")), ckpt))
    assert T.last_batch(spark, ckpt) is None
    assert T.running_frequencies(spark, ckpt).count() == 0
    S.run_to_end(T.start_frequencies(stream, ckpt))
    assert rows(T.running_frequencies(spark, ckpt), "item", "f") == rows(Q.item_frequencies(items), "item", "f")


def test_stream_sketch_equals_batch(spark, landed):
    items, src, root = landed
    ckpt = f"{root}/sk-ckpt"
    S.run_to_end(T.start_sketch(S.item_stream(spark, src), ckpt, FAM, 32, 10, 120))
    assert rows(T.running_sketch(spark, ckpt), "j", "h", "c") == rows(Q.count_sketch(items, FAM, 32, 10, 120), "j", "h", "c")


def test_distinct_items_come_once(spark, landed):
    items, _, root = landed
    src, out, ckpt = f"{root}/d-landing", f"{root}/d-out", f"{root}/d-ckpt"
    known = set()
    for part in (items.limit(300), items, items.limit(50), spark.createDataFrame([(5_000_000,), (5_000_000,), (-3,)], "item BIGINT")):
        land_items(part, src)
        known |= {r["item"] for r in part.collect()}
        S.run_to_end(T.start_distinct(S.item_stream(spark, src), out, ckpt))
        assert [r["item"] for r in T.distinct_items(spark, out).orderBy("item").collect()] == sorted(known)
    assert rows(T.seen_items(spark, ckpt), "item") == rows(T.distinct_items(spark, out), "item")


def test_distinct_report_equals_batch(spark, landed):
    items, src, root = landed
    ckpt = f"{root}/dr-ckpt"
    S.run_to_end(T.start_frequencies(S.item_stream(spark, src), ckpt))
    assert T.distinct_report(T.running_frequencies(spark, ckpt)).first() == Q.distinct_stats(items).first()


def test_one_query_keeps_length_frequencies_and_sketch(spark, landed):
    items, _, root = landed
    odd = items.unionByName(spark.createDataFrame([(None,), (-5,), (2 ** 40,)], "item BIGINT"))
    src, ckpt = land_items(odd.repartition(3), f"{root}/one-landing"), f"{root}/one-ckpt"
    S.run_to_end(T.start_summary(S.item_stream(spark, src), ckpt, FAM, 32, 10, 120))
    got = T.summary(spark, ckpt)
    assert got.n_items.first()["n_items"] == odd.count()
    assert rows(got.frequencies, "item", "f") == rows(Q.item_frequencies(odd, 10, 120), "item", "f")
    assert rows(got.sketch, "j", "h", "c") == rows(Q.count_sketch(odd, FAM, 32, 10, 120), "j", "h", "c")


def prefix_of(spark, src, ckpt, n, files=1, trigger="availableNow"):
    return T.run_prefix(spark, ckpt, n, lambda metric: T.start_summary(
        S.item_stream(spark, src, max_files_per_trigger=files), ckpt, FAM, 32, trigger=trigger, metric=metric), timeout_s=120)


@pytest.mark.parametrize("trigger", ["availableNow", "100 milliseconds"])
def test_prefix_holds_the_batch_that_crosses_it_and_no_more(spark, landed, trigger):
    items, _, root = landed
    src, ckpt = f"{root}/p-{len(trigger)}-landing", f"{root}/p-{len(trigger)}-ckpt"
    lengths = []
    for k in range(6):
        part = items.where(F.col("item") % 6 == k).coalesce(1)
        land_items(part, src)
        lengths.append(part.count())
    batch = prefix_of(spark, src, ckpt, 1, trigger=trigger)
    assert batch == 0
    got = T.summary(spark, ckpt, batch)
    assert got.n_items.first()["n_items"] in lengths
    assert rows(got.frequencies, "item", "f") == rows(
        Q.item_frequencies(items.where(F.col("item") % 6 == got.frequencies.first()["item"] % 6)), "item", "f")
    # a larger prefix goes on from there; a smaller one starts nothing
    n = sum(sorted(lengths)[:3]) + 1
    batch = prefix_of(spark, src, ckpt, n, trigger=trigger)
    assert T.length_at(spark, ckpt, batch) >= n > T.length_at(spark, ckpt, batch - 1)
    last = T.last_batch(spark, ckpt)
    assert prefix_of(spark, src, ckpt, 1, trigger=trigger) == 0
    assert T.last_batch(spark, ckpt) == last
    if trigger == "availableNow":
        assert prefix_of(spark, src, ckpt, items.count()) == 5
        assert rows(T.summary(spark, ckpt).frequencies, "item", "f") == rows(Q.item_frequencies(items), "item", "f")
        assert prefix_of(spark, src, ckpt, items.count() + 1) is None


def test_a_failing_batch_is_not_taken_for_a_prefix(spark, landed):
    _, src, root = landed
    ckpt = f"{root}/fail-ckpt"
    bad = F.raise_error(F.lit("prefix reached")).cast("bigint")
    with pytest.raises(Exception, match="prefix reached"):
        T.run_prefix(spark, ckpt, 10, lambda metric: T.start_summary(
            S.item_stream(spark, src).select(bad.alias("item")), ckpt, FAM, 32, metric=metric))


def test_timeouts_raise(spark, landed):
    items, src, root = landed
    with pytest.raises(TimeoutError):
        T.run_prefix(spark, f"{root}/t-ckpt", 10 ** 12, lambda metric: T.start_summary(
            S.item_stream(spark, src), f"{root}/t-ckpt", trigger="100 milliseconds", metric=metric), timeout_s=3)
    query = T.start_frequencies(S.item_stream(spark, src), f"{root}/t2-ckpt", trigger="100 milliseconds")
    with pytest.raises(TimeoutError):
        S.run_to_end(query, timeout_s=2)
    assert not query.isActive


@pytest.mark.parametrize("read", [T.running_frequencies, T.running_sketch, T.seen_items, T.last_batch])
def test_missing_state_raises(spark, tmp_path, read):
    with pytest.raises(FileNotFoundError):
        read(spark, str(tmp_path / "none"))


def test_empty_stream_has_an_empty_state(spark, tmp_path):
    (tmp_path / "src").mkdir()
    S.run_to_end(T.start_summary(S.item_stream(spark, str(tmp_path / "src")), str(tmp_path / "ckpt"), FAM, 32))
    got = T.summary(spark, str(tmp_path / "ckpt"))
    assert got.n_items.first()["n_items"] == 0 and got.frequencies.count() == 0 and got.sketch.count() == 0
    assert T.prefix_batch(spark, str(tmp_path / "ckpt"), 1) is None


def test_text_item_stream_parses(spark, tmp_path):
    d = tmp_path / "txt"
    d.mkdir()
    (d / "a.txt").write_text("1\n2\n2\n")
    S.run_to_end(T.start_frequencies(S.text_item_stream(spark, str(d)), str(tmp_path / "c")))
    assert rows(T.running_frequencies(spark, str(tmp_path / "c")), "item", "f") == [(1, 1), (2, 2)]


def test_malformed_stream_item_raises(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    (d / "a.txt").write_text("1\nx\n")
    with pytest.raises(Exception):
        S.run_to_end(T.start_frequencies(S.text_item_stream(spark, str(d)), str(tmp_path / "c")))


# -- per-batch results ---------------------------------------------------------

FREQ = {"freq": Q.item_frequencies}


def test_batch_results_and_lengths(spark, landed):
    items, src, root = landed
    out, ckpt = f"{root}/w2-out", f"{root}/w2-ckpt"
    for _ in range(2):
        S.run_to_end(S.start_partials(S.item_stream(spark, src), out, ckpt, FREQ))
        counts = S.batch_counts(spark, out).collect()
        assert sorted(r["batch_id"] for r in counts) == [0, 1, 2]
        assert sum(r["n_items"] for r in counts) == items.count()
    each = S.partials(spark, out, "freq", "item BIGINT, f BIGINT")
    merged = each.groupBy("item").agg(F.sum("f").alias("f"))
    assert rows(merged, "item", "f") == rows(Q.item_frequencies(items), "item", "f")


def test_replayed_batch_changes_nothing(spark, landed):
    items, _, root = landed
    out = f"{root}/replay-out"
    handle = S.partials_handler(out, FREQ)
    first = items.limit(500)
    handle(first, 0)
    once = rows(S.partials(spark, out, "freq", "item BIGINT, f BIGINT"), "item", "f", "batch_id")
    handle(first, 0)  # the same batch delivered again
    assert rows(S.partials(spark, out, "freq", "item BIGINT, f BIGINT"), "item", "f", "batch_id") == once
    assert rows(S.batch_counts(spark, out), "batch_id", "n_items") == [(0, 500)]
