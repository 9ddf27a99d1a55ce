"""Inputs derived from the driver's Parquet tables.

Every derived input is a projection of one scan, so column pruning and
filters reach the Parquet reader and the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) of the ``documents`` table, as the scan delivers it."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def edges_partsupp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw edge list (u, v) = (l_partkey, l_suppkey), one edge per lineitem row.

    The two id ranges overlap on purpose, so the graph has triangles.
    Raw: reversed, repeated and self-loop rows are left for
    ``canonical_edges``; the raw row count is the reported edge count.
    """
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("bigint").alias("u"),
        F.col("l_suppkey").cast("bigint").alias("v"),
    )


def items_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item stream (item) = lineitem.l_partkey, one item per row."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("bigint").alias("item"))


def items_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item stream (item) = events.user_id, with its event order columns."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("bigint").alias("item"), "event_id", "ts")
