"""Heavy items of an interval of integers, by a dyadic count sketch.

Asking a sketch for every integer of [left, right] (K4/J4) takes work that
grows with the interval, not with the data: 2^31 lookups for the reference's
item type.  A dyadic sketch also counts ranges: at level l an item counts for
its prefix (item - left) >> l.  A range's frequency is at least that of any
item in it, so the search goes down from the whole interval and only into
ranges whose own estimate reaches the threshold.  It looks up 2^BITS prefixes
per surviving range and level, whatever the width of the interval.

The sketch has at most levels * D * W cells, a bound by its parameters alone.
Signs are noise for a range that holds nothing heavy: with W of about
16 F2 / threshold^2 or more few such ranges survive.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countwise.functions.hashing import MAX_PRIME, SketchRow, hash_family, linear_hash, sign_hash
from countwise.operators import frequency as fq

#: A level's ranges are halved so often from one level to the next.
BITS = 4


@dataclass(frozen=True)
class Dyadic:
    """The interval and the hash families of a dyadic sketch, one per level."""

    left: int
    right: int
    width: int
    families: tuple[tuple[int, Sequence[SketchRow]], ...]  # (level, rows), finest level first
    bits: int = BITS
    p: int = MAX_PRIME

    @property
    def span(self) -> int:
        return self.right - self.left


def dyadic(left: int, right: int, depth: int, width: int, seed: int, bits: int = BITS, p: int = MAX_PRIME) -> Dyadic:
    """Levels 0, bits, 2 bits, .. up to the one whose ranges are at most 2^bits."""
    if right < left:
        raise ValueError("an interval must not end before it begins")
    levels = [0]
    while (right - left) >> levels[-1] >= 1 << bits:
        levels.append(levels[-1] + bits)
    return Dyadic(left, right, width, tuple((level, tuple(hash_family(seed + level, depth, p))) for level in levels), bits, p)


def _prefix(item: Column, level: Column) -> Column:
    return F.call_function("shiftright", item, level.cast("int"))


def dyadic_sketch(freq: DataFrame, spec: Dyadic) -> DataFrame:
    """(level, j, h, c) of (item, f); for a raw stream f is 1.

    The hash rows of all levels are one literal array, exploded in the same
    stage; sketches of parts of a stream add up cell by cell.
    """
    rows = F.array(*[
        F.struct(F.lit(level).cast("bigint").alias("level"), F.lit(r.j).cast("bigint").alias("j"),
                 *[F.lit(v).cast("bigint").alias(name) for name, v in (("ah", r.ah), ("bh", r.bh), ("ag", r.ag), ("bg", r.bg))])
        for level, family in spec.families for r in family])
    inside = fq.in_range(freq, spec.left, spec.right).select((F.col("item") - F.lit(spec.left)).alias("x"), "f", F.explode(rows).alias("r"))
    prefix = _prefix(F.col("x"), F.col("r.level"))
    cells = inside.select(F.col("r.level").alias("level"), F.col("r.j").alias("j"), linear_hash(prefix, F.col("r.ah"), F.col("r.bh"), spec.width, spec.p).alias("h"),
                          (sign_hash(prefix, F.col("r.ag"), F.col("r.bg"), spec.p) * F.col("f")).alias("g"))
    return cells.groupBy("level", "j", "h").agg(F.sum("g").cast("bigint").alias("c"))


def heavy_items(sketch: DataFrame, spec: Dyadic, threshold: Column) -> DataFrame:
    """(item, est) of the integers in the interval whose estimate, and that of
    every range around them, reaches ``threshold`` (a number or a scalar
    subquery).

    ``sketch`` is read once per level, so it should be stored.
    """
    spark, found = sketch.sparkSession, None
    for level, family in reversed(spec.families):
        if found is None:
            prefixes = spark.range(0, (spec.span >> level) + 1).select(F.col("id").alias("item"))
        else:
            first = F.call_function("shiftleft", F.col("item"), F.lit(spec.bits))
            prefixes = found.select(F.explode(F.sequence(first, first + F.lit((1 << spec.bits) - 1))).alias("item")).where(
                F.col("item") <= F.lit(spec.span >> level))
        own = sketch.where(F.col("level") == level).select("j", "h", "c")
        found = fq.estimate_frequencies(own, prefixes, family, spec.width, spec.p).where(F.col("est") >= threshold)
    return found.select((F.col("item") + F.lit(spec.left)).alias("item"), "est")
