"""Running frequencies, distinct items and sketches in Spark's state store.

Every query here is one stateful operator: a streaming aggregation (W3a
frequencies, W3b count sketch, and both together with the length of the
stream) or the streaming deduplication (W3c).  Its state lives in RocksDB with
changelog checkpoints: a batch uploads what it changed, not all keys, and a
state larger than an executor's memory stays on its disk.  No result is
written beside it; the running result is read from the state itself by the
``statestore`` data source, as of the last committed batch or an earlier one.
A batch that is replayed after a failure starts from the state before it, so
nothing is counted twice (W6).

A bounded prefix (W4) ends with the batch in which the stream's length reaches
N.  ``observe`` reports the length of every batch, a listener adds it up, and
the caller's thread stops the query; what the prefix holds is the state as of
that batch, even if a further one was committed before the query stopped.  The
length is part of the state, so all this survives restarts: a larger N goes on
from there.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from countwise.functions.hashing import PRIME, SketchRow
from countwise.operators import frequency as fq
from countwise.streaming.items import triggered

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Rows of a summary that are no sketch rows: the stream's length, and exact frequencies.
LENGTH, EXACT = -2, -1
_SUMMARY = "j BIGINT, h BIGINT, c BIGINT"


@contextmanager
def _state_conf(spark: SparkSession) -> Iterator[None]:
    """A query takes its settings when it starts; the session gets its own back."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _start(frame: DataFrame, checkpoint: str, trigger: str | None) -> StreamingQuery:
    """Start a query that leaves nothing but its state."""
    writer = frame.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    with _state_conf(frame.sparkSession):
        return triggered(writer, trigger).start()


def last_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The last committed batch, None before the first; a checkpoint that no query has made raises."""
    at = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        raise FileNotFoundError(f"no stream has written to {checkpoint}")
    commits = spark._jvm.org.apache.hadoop.fs.Path(at, "commits")
    names = [f.getPath().getName() for f in fs.listStatus(commits)] if fs.exists(commits) else []
    return max((int(n) for n in names if n.isdigit()), default=None)


def _state(spark: SparkSession, checkpoint: str, batch: int | None, columns: dict[str, str], schema: str) -> DataFrame:
    """Columns of the state as of ``batch`` (default: the last committed one)."""
    newest = last_batch(spark, checkpoint)
    if newest is None:
        return spark.createDataFrame([], schema)
    reader = spark.read.format("statestore").option("batchId", newest if batch is None else batch)
    rows = reader.load(checkpoint)
    return rows.select(*[F.col(old).alias(new) for new, old in columns.items()])


# -- W3a -------------------------------------------------------------------------

def start_frequencies(stream: DataFrame, checkpoint: str, left: int | None = None, right: int | None = None,
                      trigger: str | None = "availableNow") -> StreamingQuery:
    """Running frequencies of the items in [left, right], one state row per distinct item."""
    return _start(fq.item_frequencies(stream, left, right), checkpoint, trigger)


def running_frequencies(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """W3a result -> (item, f)."""
    return _state(spark, checkpoint, batch, {"item": "key.item", "f": "value.count"}, "item BIGINT, f BIGINT")


def distinct_report(freq: DataFrame) -> DataFrame:
    """C5 over running frequencies of all items -> (n_items, n_distinct, max_item)."""
    return freq.agg(F.coalesce(F.sum("f"), F.lit(0)).cast("bigint").alias("n_items"),
                    F.count("item").alias("n_distinct"), F.max("item").alias("max_item"))


# -- W3b -------------------------------------------------------------------------

def start_sketch(stream: DataFrame, checkpoint: str, family: Sequence[SketchRow], width: int,
                 left: int | None = None, right: int | None = None, p: int = PRIME,
                 trigger: str | None = "availableNow") -> StreamingQuery:
    """Running count sketch, at most D*W state rows."""
    return _start(fq.count_sketch(stream, family, width, left, right, p), checkpoint, trigger)


def running_sketch(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """W3b result -> (j, h, c)."""
    return _state(spark, checkpoint, batch, {"j": "key.j", "h": "key.h", "c": "value.sum"}, _SUMMARY)


# -- W3c -------------------------------------------------------------------------

def start_distinct(stream: DataFrame, out: str, checkpoint: str, trigger: str | None = "availableNow") -> StreamingQuery:
    """W3c: the distinct items themselves, each appended to ``out`` once, with the batch that first holds it."""
    writer = (stream.dropDuplicates(["item"]).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", out))
    with _state_conf(stream.sparkSession):
        return triggered(writer, trigger).start()


def distinct_items(spark: SparkSession, out: str) -> DataFrame:
    """W3c result, from what was appended -> (item)."""
    return spark.read.schema("item BIGINT").parquet(out)


def seen_items(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """W3c result, from the state of the deduplication -> (item)."""
    return _state(spark, checkpoint, batch, {"item": "key.item"}, "item BIGINT")


# -- W4: length, frequencies and sketch of one bounded stream -----------------------

class _PrefixListener(StreamingQueryListener):
    """Adds up the observed lengths of one query's batches and says when they reach N."""

    def __init__(self, metric: str, n_items: int, done: int):
        self.metric, self.n_items, self.done = metric, n_items, done
        self.reached = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        lengths = event.progress.observedMetrics.get(self.metric)
        if lengths is not None:
            self.done += lengths.n or 0
            if self.done >= self.n_items:
                self.reached.set()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@dataclass(frozen=True)
class Summary:
    """What a summary's state holds as of a batch."""

    n_items: DataFrame  # one row (n_items)
    frequencies: DataFrame  # (item, f)
    sketch: DataFrame  # (j, h, c)


def summary_cells(stream: DataFrame, family: Sequence[SketchRow], width: int, left: int | None, right: int | None,
                  p: int = PRIME, exact: bool = True) -> DataFrame:
    """Every item as one row of the length, one of its exact frequency and D of
    the sketch -> (j, h, g); what is out of range counts for the length only."""
    inside = F.coalesce((F.col("item") >= F.lit(left)) if left is not None else F.lit(True), F.lit(False))
    if right is not None:
        inside = inside & F.coalesce(F.col("item") <= F.lit(right), F.lit(False))
    one = F.lit(1).cast("bigint").alias("g")

    def row(j: int, h) -> F.Column:
        return F.struct(F.lit(j).cast("bigint").alias("j"), h.cast("bigint").alias("h"), one)

    own = [row(EXACT, F.col("item"))] if exact else []
    own += [F.struct(F.lit(r.j).cast("bigint").alias("j"), fq.linear_hash("item", r.ah, r.bh, width, p).alias("h"),
                     fq.sign_hash("item", r.ag, r.bg, p).alias("g")) for r in family]
    rows = F.array(row(LENGTH, F.lit(0)))
    if own:
        rows = F.when(inside & F.col("item").isNotNull(), F.concat(rows, F.array(*own))).otherwise(rows)
    return stream.select(F.explode(rows).alias("x")).select("x.*")


def start_summary(stream: DataFrame, checkpoint: str, family: Sequence[SketchRow] = (), width: int = 1,
                  left: int | None = None, right: int | None = None, p: int = PRIME, exact: bool = True,
                  trigger: str | None = "availableNow", metric: str | None = None) -> StreamingQuery:
    """One query for the length, the exact frequencies and the sketch of a stream.

    With ``metric`` the length of every batch is observed under that name.
    """
    if metric is not None:
        stream = stream.observe(metric, F.count(F.lit(1)).alias("n"))
    cells = summary_cells(stream, family, width, left, right, p, exact)
    return _start(cells.groupBy("j", "h").agg(F.sum("g").alias("c")), checkpoint, trigger)


def summary(spark: SparkSession, checkpoint: str, batch: int | None = None) -> Summary:
    """The state of ``start_summary`` as of ``batch`` (default: the last committed one)."""
    cells = _state(spark, checkpoint, batch, {"j": "key.j", "h": "key.h", "c": "value.sum"}, _SUMMARY)
    length = cells.where(F.col("j") == LENGTH).agg(F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_items"))
    freq = cells.where(F.col("j") == EXACT).select(F.col("h").alias("item"), F.col("c").alias("f"))
    return Summary(length, freq, cells.where(F.col("j") >= 0))


def length_at(spark: SparkSession, checkpoint: str, batch: int | None = None) -> int:
    """The length of the stream through ``batch``."""
    return summary(spark, checkpoint, batch).n_items.first()["n_items"]


def prefix_batch(spark: SparkSession, checkpoint: str, n_items: int) -> int | None:
    """The batch in which the length reached N, None if it has not.

    Found by halving over the versions of the state that are kept
    (``spark.sql.streaming.minBatchesToRetain``)."""
    high = last_batch(spark, checkpoint)
    if high is None or length_at(spark, checkpoint, high) < n_items:
        return None
    kept = int(spark.conf.get("spark.sql.streaming.minBatchesToRetain"))
    low = max(0, high - kept + 1)
    while low < high:
        middle = (low + high) // 2
        if length_at(spark, checkpoint, middle) >= n_items:
            high = middle
        else:
            low = middle + 1
    return high


def run_prefix(spark: SparkSession, checkpoint: str, n_items: int, start: Callable[[str], StreamingQuery],
               timeout_s: float | None = None) -> int | None:
    """Run the query that ``start(metric)`` begins until N items are
    committed, or an availableNow query has read all there is -> the batch in
    which the length reached N, or None.

    Does not start one if the checkpoint holds N items already.  A failure of
    the query is raised, and TimeoutError if it takes too long.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    known = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at) and last_batch(spark, checkpoint) is not None
    done = length_at(spark, checkpoint) if known else 0
    if done < n_items:
        metric = f"prefix-{uuid.uuid4().hex}"
        listener = _PrefixListener(metric, n_items, done)
        spark.streams.addListener(listener)
        try:
            query, waited = start(metric), 0.0
            while not query.awaitTermination(0.1):
                waited += 0.1
                if listener.reached.is_set():
                    query.stop()
                elif timeout_s is not None and waited >= timeout_s:
                    query.stop()
                    raise TimeoutError(f"fewer than {n_items} items within {timeout_s} s")
        finally:
            spark.streams.removeListener(listener)
    return prefix_batch(spark, checkpoint, n_items)
