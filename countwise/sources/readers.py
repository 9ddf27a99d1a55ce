"""Readers for the plain-text inputs of the programs, and canonical edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countwise.functions.text import lines_of


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of the text file(s) at ``path`` -> (value)."""
    return spark.read.text(path)


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """S1 on a table: one row per line of each text -> (doc_id, line_no, text).

    A line of a text file is one document for the word statistics, so a
    stored text with embedded newlines becomes several documents.  The
    split runs in the task that reads the row; nothing is gathered.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(lines_of(text_col)).alias("line_no", "text"),
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) with one document per line -> (doc_id, line_no, text).

    ``doc_id`` is ``monotonically_increasing_id()``: unique, and stable for
    the same files and splits, which is all the per-document keys need.
    """
    return read_lines(spark, path).select(
        F.monotonically_increasing_id().alias("doc_id"),
        F.lit(0).alias("line_no"),
        F.col("value").alias("text"))


# Fixed value: what Java's Integer.parseInt / Long.parseLong accept.
JAVA_INT = r"^[+-]?[0-9]+$"


def _parse_int(field, kind: str, strict: bool):
    """Strict: Java rules (no blanks, raises on anything else, ANSI CAST
    raises on overflow).  Permissive: whatever strict would reject -> NULL."""
    col = F.col(field) if isinstance(field, str) else field
    if not strict:
        return F.when(col.rlike(JAVA_INT), col.try_cast(kind))
    bad = F.raise_error(F.concat(F.lit("malformed integer: "), F.coalesce(col, F.lit("<missing>"))))
    return F.when(col.rlike(JAVA_INT), col.cast(kind)).otherwise(bad.cast(kind))


def edges_from_text(lines: DataFrame, col: str = "value", strict: bool = True) -> DataFrame:
    """S2 on a DataFrame of ``"u,v"`` lines -> (u BIGINT, v BIGINT).

    Both ends must be 32-bit integers.  ``strict`` (default) fails the job
    on a malformed line, like the reference's parser; otherwise malformed
    lines are dropped (see ``rejected_edges`` for the count).  Fields after
    the second are ignored.
    """
    parts = F.split(F.col(col), ",")
    u = _parse_int(F.get(parts, 0), "int", strict).cast("bigint")
    v = _parse_int(F.get(parts, 1), "int", strict).cast("bigint")
    out = lines.select(u.alias("u"), v.alias("v"))
    return out if strict else out.where(F.col("u").isNotNull() & F.col("v").isNotNull())


def rejected_edges(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines that a strict edge parse would reject -> (value)."""
    parts = F.split(F.col(col), ",")
    ok = (F.coalesce(F.get(parts, 0).rlike(JAVA_INT), F.lit(False))
          & F.coalesce(F.get(parts, 1).rlike(JAVA_INT), F.lit(False)))
    u = F.get(parts, 0).try_cast("int")
    v = F.get(parts, 1).try_cast("int")
    return lines.where(~(ok & u.isNotNull() & v.isNotNull())).select(F.col(col).alias("value"))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edge-list text file(s), one ``u,v`` per line."""
    return edges_from_text(read_lines(spark, path))


def canonical_edges(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """S3: the undirected simple graph of an edge list -> (u, v) with u < v.

    Self-loops are dropped, reversed and repeated edges collapse.  The
    ``distinct`` is a partial+final hash aggregate, so duplicates are
    removed map-side before the shuffle.
    """
    a, b = F.col(u).cast("bigint"), F.col(v).cast("bigint")
    lo, hi = F.least(a, b), F.greatest(a, b)
    # The explicit not-null test matches what joins on (u, v) infer, so
    # every branch that reads these edges shares one scan and exchange.
    return (edges.where((a != b) & lo.isNotNull() & hi.isNotNull())
            .select(lo.alias("u"), hi.alias("v"))
            .distinct())


def read_item_lines(lines: DataFrame, col: str = "value", strict: bool = True) -> DataFrame:
    """S4 parse step: one integer per line -> (item BIGINT); a malformed line
    raises when ``strict``, else it is dropped."""
    # A binary value (a message-queue source) is read as UTF-8 text first.
    item = _parse_int(F.col(col).cast("string"), "bigint", strict)
    out = lines.select(item.alias("item"))
    return out if strict else out.where(F.col("item").isNotNull())
