"""Results as stored tables, bucketed and sorted by their key.

Two results that are bucketed alike by the same key -- the exact frequencies
and the estimates of the same items, or the states of two streams -- are joined
bucket by bucket, without an exchange on either side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from countwise.session import scratch_path


def save_bucketed(df: DataFrame, by: str, buckets: int, name: str | None = None, path: str | None = None) -> DataFrame:
    """Save ``df`` as a table of ``buckets`` buckets by the column ``by``, each
    one sorted file, and read it.

    Without a ``name`` and ``path`` the table is the session's own, in its
    scratch folder.
    """
    spark = df.sparkSession
    name = name or f"countwise_{uuid.uuid4().hex}"
    (df.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(by)
     .option("path", path or scratch_path(spark, name)).saveAsTable(name))
    return spark.table(name)
