"""Item streams and per-batch results (Structured Streaming).

Running state -- frequencies, distinct items, the count sketch, a bounded
prefix -- is kept by Spark's state store, see ``state.py``.  Here are the
sources (S4) and what belongs to a micro-batch itself: ``foreachBatch`` (W2)
writes each batch's aggregates and its length (W5) to a folder named by the
batch id, with overwrite, so a replayed batch rewrites the same files (W6).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from countwise.sources.readers import read_item_lines

ITEM_SCHEMA = "item BIGINT"

BatchFn = Callable[[DataFrame], DataFrame]


def item_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1,
                fmt: str = "parquet", schema: str = ITEM_SCHEMA, **options) -> DataFrame:
    """A file-source item stream (a directory that receives files)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def text_item_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1,
                     fmt: str = "text", strict: bool = True, **options) -> DataFrame:
    """S4 for line sources (text files; ``fmt="socket"`` is a caller option):
    one integer per line -> (item BIGINT); malformed lines raise (``strict``)
    or are dropped."""
    reader = spark.readStream.format(fmt)
    if max_files_per_trigger and fmt == "text":
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    src = reader.load(path) if path else reader.load()
    return read_item_lines(src, "value", strict)


def triggered(writer, trigger: str | None):
    """``writer`` with a processing-time trigger (W1, e.g. "100 milliseconds"),
    or with ``availableNow``: read what there is and end."""
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def partials_handler(out: str, per_batch: Mapping[str, BatchFn]) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of ``start_partials``.

    Every write is an overwrite of the batch's own folder, so running it
    again for the same batch id (a replay after a failure) leaves exactly
    the output of one run.
    """
    every = {**per_batch, "counts": lambda batch: batch.agg(F.count(F.lit(1)).alias("n_items"))}

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, fn in every.items():
                fn(batch).write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return handle


def start_partials(stream: DataFrame, out: str, checkpoint: str, per_batch: Mapping[str, BatchFn],
                   trigger: str | None = "availableNow") -> StreamingQuery:
    """Write ``per_batch`` aggregates of every micro-batch, and its length
    (n_items) under ``counts`` (W5)."""
    writer = stream.writeStream.foreachBatch(partials_handler(out, per_batch)).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def partials(spark: SparkSession, out: str, name: str, schema: str) -> DataFrame:
    """The aggregates ``name`` of all batches, with their batch_id; an explicit
    schema, so no file is opened to learn it."""
    return spark.read.schema(f"{schema}, batch_id INT").parquet(f"{out}/{name}")


def batch_counts(spark: SparkSession, out: str) -> DataFrame:
    """W5 result: (batch_id, n_items) per micro-batch."""
    return partials(spark, out, "counts", "n_items BIGINT").select("batch_id", "n_items")


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait until an availableNow query has read all there is; raise its error
    if it failed, and TimeoutError if it takes too long."""
    if not (query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination() or True):
        query.stop()
        raise TimeoutError(f"the query did not end within {timeout_s} s")
