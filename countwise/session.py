"""Session helpers.

Library code never builds its own session: every operator takes the
caller's DataFrames.  ``local_session`` is for tests and the bench only.
Scratch output (materialised buckets, stream checkpoints and partials)
always lives under the shared folder named by ``spark.checkpoint.dir``;
a private temporary folder is used only when that setting is absent and
the session is local; without it a cluster session raises, because every
machine would write to its own disk.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "countwise") -> SparkSession:
    """A local session configured like the tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Local data is small: let AQE keep more (smaller) post-shuffle
        # partitions, since the array work after a shuffle is per-row heavy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); only
    when neither is set and the session is local a temporary folder is
    created and registered, so that ``DataFrame.checkpoint`` works.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return _parent_of_context_dir(current)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="countwise-ckpt-")
    sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def _parent_of_context_dir(path: str) -> str:
    # SparkContext.getCheckpointDir() appends a per-application uuid folder.
    path = path.rstrip("/")
    head, tail = path.rsplit("/", 1)
    try:
        uuid.UUID(tail)
        return head
    except ValueError:
        return path


#: The folders of the innermost scope, if there is one.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint folder, owned by
    the ``scratch_scope`` around the call."""
    path = f"{checkpoint_root(spark)}/countwise/{name}-{uuid.uuid4().hex}"
    owned = _SCOPE.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """The life of intermediate results.

    Everything that the library materialises inside the ``with`` block is
    removed at its end, also after an error.  Results are lazy, so write them
    out inside the block; what is read from removed folders fails.
    """
    owned: list[str] = []
    token = _SCOPE.set(owned)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in owned:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage, and drops the partitioning that a later join would
    reuse: both sides of that join are then shuffle stages of their own, the
    only kind whose skewed partitions AQE splits.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
