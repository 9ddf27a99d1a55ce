"""Streaming versions of the registered frequency queries.

The item stream of a table arrives in ``STREAM_ARRIVALS`` parts, dealt by a
key of the row, so SQL can say which items a part holds.  The table is dealt
in one pass; then each part is appended to the stream's folder under
``spark.checkpoint.dir`` and the query is started on its checkpoint with
``availableNow``: one micro-batch per part, as many files as the part has.
The result is read from the committed state, and must equal the batch query on
the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countwise.plans import params as P
from countwise.plans import reports as rp
from countwise.session import scratch_path
from countwise.sources import tables as tb
from countwise.streaming import items as st
from countwise.streaming import state

#: Runs a query over what has arrived: (stream, output folder, checkpoint).
Run = Callable[[DataFrame, str, str], object]


def land_items(items: DataFrame, path: str) -> str:
    """Append the items of one arrival to the folder of a stream."""
    items.select("item").write.mode("append").parquet(path)
    return path


def deal_arrivals(items: DataFrame, parts: int, path: str) -> list[DataFrame]:
    """(item, key) dealt into parts by the key, in one pass over the table."""
    items.select("item", F.pmod(F.col("key"), F.lit(parts)).cast("int").alias("part")).write.partitionBy("part").parquet(path)
    dealt = items.sparkSession.read.schema("item BIGINT, part INT").parquet(path)
    return [dealt.where(F.col("part") == k).select("item") for k in range(parts)]


def run_arrivals(spark: SparkSession, items: DataFrame, name: str, run: Run,
                 parts: int = P.STREAM_ARRIVALS) -> tuple[str, str]:
    """Run the query after every arrival -> (output folder, checkpoint)."""
    root = scratch_path(spark, name)
    src, out, ckpt = f"{root}/landing", f"{root}/out", f"{root}/checkpoint"
    for part in deal_arrivals(items, parts, f"{root}/dealt"):
        land_items(part, src)
        run(st.item_stream(spark, src, max_files_per_trigger=None), out, ckpt)
    return out, ckpt


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("bigint").alias("item"), F.col("l_orderkey").alias("key"))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("bigint").alias("item"), F.col("event_id").alias("key"))


def _to_end(start: Callable) -> Run:
    return lambda stream, out, ckpt: st.run_to_end(start(stream, out, ckpt))


def _frequencies(stream, out, ckpt):
    return state.start_frequencies(stream, ckpt, P.LEFT, P.RIGHT)


def _prefix(spark: SparkSession, items: DataFrame, name: str, n_items: int, **summary) -> tuple[state.Summary, int | None]:
    """The summary of the prefix, and the batch that completes it."""
    def run(stream, out, ckpt):
        state.run_prefix(spark, ckpt, n_items, lambda metric: state.start_summary(stream, ckpt, metric=metric, **summary))

    _, ckpt = run_arrivals(spark, items, name, run)
    batch = state.prefix_batch(spark, ckpt, n_items)
    return state.summary(spark, ckpt, batch), state.last_batch(spark, ckpt) if batch is None else batch


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    if name == "stream_count_sketch":
        _, ckpt = run_arrivals(spark, _parts(spark, sf_dir), name, _to_end(lambda stream, out, ckpt: state.start_sketch(
            stream, ckpt, P.FAMILY, P.SKETCH_W, P.LEFT, P.RIGHT)))
        return state.running_sketch(spark, ckpt)
    if name == "stream_frequencies":
        _, ckpt = run_arrivals(spark, _parts(spark, sf_dir), name, _to_end(_frequencies))
        return state.running_frequencies(spark, ckpt)
    if name == "stream_frequencies_stateful":
        _, ckpt = run_arrivals(spark, _parts(spark, sf_dir), name, _to_end(lambda stream, out, ckpt: state.start_summary(
            stream, ckpt, P.FAMILY, P.SKETCH_W, P.LEFT, P.RIGHT)))
        return state.summary(spark, ckpt).frequencies
    if name == "stream_distinct_items":
        _, ckpt = run_arrivals(spark, _users(spark, sf_dir), name, _to_end(lambda stream, out, ckpt: state.start_frequencies(stream, ckpt)))
        return state.distinct_report(state.running_frequencies(spark, ckpt))
    if name == "stream_distinct_set":
        out, _ = run_arrivals(spark, _users(spark, sf_dir), name, _to_end(state.start_distinct))
        return state.distinct_items(spark, out)
    if name == "batch_counts":
        out, _ = run_arrivals(spark, _parts(spark, sf_dir), name, _to_end(lambda stream, out, ckpt: st.start_partials(stream, out, ckpt, {})))
        return st.batch_counts(spark, out)
    if name == "stream_prefix":
        found, batch = _prefix(spark, _parts(spark, sf_dir), name, P.PREFIX_ITEMS, exact=False)
        return found.n_items.select("n_items", F.lit(batch + 1).cast("bigint").alias("n_batches"))
    if name == "stream_report_sketch":
        found, _ = _prefix(spark, _parts(spark, sf_dir), name, P.PREFIX_ITEMS, family=P.FAMILY, width=P.SKETCH_W, left=P.LEFT, right=P.RIGHT)
        return rp.report_sketch_of(found.frequencies, found.n_items, P.FAMILY, P.SKETCH_W, P.LEFT, P.RIGHT, P.TOP_K, sketch=found.sketch)
    if name == "stream_report_distinct":
        found, _ = _prefix(spark, _users(spark, sf_dir), name, P.PREFIX_USERS)
        return state.distinct_report(found.frequencies)
    raise KeyError(name)
