"""Small DataFrame helpers shared by the operators of this package."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countwise.session import stored

__all__ = ["WORD_SPLIT", "pick", "sized", "stored", "table"]

#: The white space that separates words: blank, tab, line feed, vertical tab,
#: form feed, carriage return.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns ``new=old``: extra columns cannot clash later."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def sized(df: DataFrame, rows: int, per_partition: int = 1 << 17) -> DataFrame:
    """``df``, which has at most ``rows`` rows, in no more partitions than these need."""
    return df.coalesce(max(1, math.ceil(rows / per_partition)))
