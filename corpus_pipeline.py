"""The corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns the documents it keeps, with the columns of ``documents``; the last
one returns the placed pieces.  ``run`` applies them in order and writes every
stage's result to the shared folder before the next one reads it, so a lost
executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countwise.llm import decontamination, line_dedup, minhash, packing, quality
from countwise.llm.frames import stored, table
from countwise.llm.queries import tokenizer_file
from countwise.llm.shipping import ship_package


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns that no stage reads under names that none uses, and column: name."""
    names = {c: c if c in ("doc_id", "text") else f"other_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()]), names


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship_package(spark)
    rows, names = _renamed(docs)
    scored = quality.with_scores(rows, quality.learn(docs, table(spark, sf_dir, "labels")))
    return scored.filter(F.col("quality_score") >= quality.THRESHOLD).select(*[F.col(name).alias(c) for c, name in names.items()])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier place holds already; one that loses its whole text goes."""
    # Stored first: a filter on the new text, pushed down, would build it anew for every use.
    rows, names = _renamed(docs)
    done = stored(line_dedup.dedup_lines(rows).drop("text"), "pipeline-lines")
    kept = done.filter((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")}
    return kept.select(*[new.get(c, F.col(names[c])).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates.

    Each (doc_id, text) is decided by itself, under a number of its own in the
    order of doc_id (nulls last); one row of equal ones stays.
    """
    ship_package(spark)
    keys = {"key_1": F.xxhash64("doc_id", "text"), "key_2": F.xxhash64(F.isnull("doc_id"), F.isnull("text"), "text", "doc_id")}
    ids = docs.select("doc_id", *[k.alias(name) for name, k in keys.items()]).distinct().orderBy(F.asc_nulls_last("doc_id"), *keys)
    ids = stored(ids.select(*keys, F.monotonically_increasing_id().alias("row_no")), "pipeline-row-numbers")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[k.alias(name) for name, k in keys.items()])
    rows = stored(rows.join(ids, list(keys)).groupBy(*keys, "row_no").agg(F.first("row").alias("row")), "pipeline-rows")
    gone = minhash.near_duplicates(rows.select(F.col("row_no").alias("doc_id"), "row.text")).filter("not kept").select(F.col("doc_id").alias("gone"))
    return rows.join(gone, F.col("row_no") == F.col("gone"), "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    ship_package(spark)
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: The classifier is fitted, so SQL cannot state the rows; tests hold each
#: stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
