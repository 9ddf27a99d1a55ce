"""Benchmark decontamination by SimHash windows (operator 5), in DataFrame functions only.

A document is contaminated by a benchmark item if some window of the item's
size is at least ``SIMILAR`` alike: the weighted Jaccard similarity of their
five-word shingles, each weighted by how often it occurs.

1. Shingles that a document shares with an item are looked up and keep the few
   shingles around them.  A window as similar as asked holds a known number of
   shared ones, so only windows that can reach it go on, and every place of
   such a window lies near a shared one.  This drops no match, and the texts
   are read once.
2. Windows and items get 64-bit SimHash fingerprints.  Fingerprints are cut
   into blocks; two within ``RADIUS`` bits differ by at most RADIUS / BLOCKS
   bits in some block, so items are indexed under every value that near to each
   of their blocks, and every pair within the radius meets.
   The radius holds for shingles that occur once: with more weight on few of
   them the angle between two windows that are alike enough can be much wider.
   So windows and items with a repeated shingle skip the fingerprints: they are
   compared with all that step 1 leaves.
3. Pairs within the radius, and those, are compared exactly.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countwise.llm.frames import WORD_SPLIT, stored

SHINGLE_WORDS = 5
#: Least similarity, in percent.
SIMILAR = 75
#: Two windows of that similarity, without repeated shingles, are at 31 degrees:
#: 11 of 64 bits differ on average, with a deviation of 3, and more than 24 with
#: a chance of 2 in 100,000.
RADIUS = 24
BLOCKS = 8
BLOCK_BITS = 64 // BLOCKS
#: Item shingles that are broadcast, at 24 bytes; a larger benchmark meets the
#: documents' shingles by a shuffle.
BROADCAST_SHINGLES = 1 << 20
_LANES = 32
_LANE_MASK = 0x0000000100000001


def shingles(text: Column) -> Column:
    """The hashes of a text's shingles in order; of fewer words, the whole sequence as one; none without words."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPLIT))

    def of(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE_WORDS),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE_WORDS)]))
        whole = F.array(F.xxhash64(F.size(w), F.array_join(w, " ")))
        return F.when(F.size(w) >= SHINGLE_WORDS, runs).when(F.size(w) > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(words), of), 0)  # the words are split once


def least_shared(m: Column, w: Column) -> Column:
    """Shingles that sets of m and w must share at least: s >= SIMILAR / 100 * (m + w - s)."""
    return F.ceil((m + w) * F.lit(SIMILAR) / F.lit(100 + SIMILAR)).cast("int")


def simhash(windows: DataFrame, key: list[str], hashes: str) -> DataFrame:
    """``key`` and the fingerprint of the array column ``hashes``: bit b is set if most hashes have it."""
    rows = windows.select(*key, F.explode(hashes).alias("h"))
    mask = F.lit(_LANE_MASK).cast("bigint")
    # Each sum counts two bits, in the two halves of a long.
    sums = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(mask)).alias(f"s{b}") for b in range(_LANES)]
    counted = rows.groupBy(*key).agg(F.count("*").alias("n"), *sums)
    bits = F.lit(0).cast("bigint")
    for b in range(_LANES):
        low, high = F.col(f"s{b}").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")), F.shiftrightunsigned(F.col(f"s{b}"), 32)
        for count, place in ((low, b), (high, b + 32)):
            bits = bits.bitwiseOR(F.when(2 * count > F.col("n"), F.shiftleft(F.lit(1).cast("bigint"), place)).otherwise(0))
    return counted.select(*key, bits.alias("fingerprint"))


def blocks(fingerprint: Column) -> Column:
    """(block number, its bits) of a fingerprint."""
    full = F.lit((1 << BLOCK_BITS) - 1).cast("bigint")
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, i * BLOCK_BITS).bitwiseAND(full).cast("int").alias("bits"))
                     for i in range(BLOCKS)])


def near_masks(radius: int) -> list[int]:
    """All changes of a block that two fingerprints within ``radius`` allow in their nearest block."""
    most = radius // BLOCKS
    return [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(BLOCK_BITS), n)]


def weighted_shared(x: Column, y: Column) -> Column:
    """Size of the intersection of two arrays, each value as often as both hold it."""
    def times(values: Column, v: Column) -> Column:
        return F.size(F.filter(values, lambda u: u == v))

    plain = (F.size(F.array_distinct(x)) == F.size(x)) | (F.size(F.array_distinct(y)) == F.size(y))
    counted = F.aggregate(F.array_intersect(x, y), F.lit(0), lambda n, v: n + F.least(times(x, v), times(y, v)))
    return F.when(plain, F.size(F.array_intersect(x, y))).otherwise(counted)


def _name() -> Column:
    """What tells documents apart: the id, null or not, and the text."""
    return F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("doc")


def find_leaks(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, start_shingle, n_shared, similarity: the best window per document and item.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns
    are ignored.  Words are runs of other characters than blank and 0x09-0x0D,
    lower-cased.  A document shorter than the item is one window.  Items of
    fewer than five words match only documents that are nothing else: they
    have no shingle of five words.  Null and
    empty texts match nothing.  Ties go to the earliest window.  Repeated rows
    count once; null ids are ids like others.
    """
    return _best_windows(docs, benchmark, radius).select(
        F.col("doc.doc_id").alias("doc_id"), F.col("item.item_id").alias("item_id"), (-F.col("best.start")).cast("bigint").alias("start_shingle"),
        F.col("best.n_shared").cast("bigint").alias("n_shared"), F.col("best.similarity").alias("similarity"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows and columns of ``docs`` whose text holds no window of a benchmark item."""
    leaks = _best_windows(docs, benchmark, radius).select(F.col("doc").alias("leaked")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _name())
    return rows.join(leaks, F.col("doc") == F.col("leaked"), "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _best_windows(docs: DataFrame, benchmark: DataFrame, radius: int) -> DataFrame:
    """(doc, item, best): the most similar window of each document and item."""
    items = benchmark.select(F.struct("item_id", F.xxhash64("text").alias("text_hash")).alias("item"), shingles(F.col("text")).alias("own"))
    items = stored(items.filter(F.size("own") > 0).distinct().withColumn("m", F.size("own")), "items")
    entries = items.select("item", "m", F.explode(F.array_distinct("own")).alias("h"))
    few = (items.agg(F.sum("m")).first()[0] or 0) <= BROADCAST_SHINGLES

    hashed = docs.select(_name(), shingles(F.col("text")).alias("own"))
    each = hashed.select("doc", F.size("own").alias("n"), "own", F.posexplode_outer("own").alias("place", "h"))
    reach = F.col("m") - least_shared(F.col("m"), F.col("m"))
    first = F.greatest(F.lit(0), F.col("place") - reach)
    if few:
        found = each.join(F.broadcast(entries), "h")
    else:  # the places alone are shuffled, and then meet their documents again
        hits = each.select("doc", "n", "place", "h").join(entries, "h").drop("h")
        found = hits.join(hashed.groupBy("doc").agg(F.first("own").alias("own")), "doc")
    shared = stored(found.select(
        "doc", "n", "item", "m", "place", first.alias("first"),
        F.slice("own", first + 1, F.least(F.col("n") - 1, F.col("place") + reach) - first + 1).alias("around")), "leak-shingles")
    w = F.least("n", "m")
    places = shared.groupBy("doc", "n", "item", "m").agg(F.sort_array(F.collect_set("place")).alias("places")).withColumn(
        "need", least_shared(F.col("m"), w)).filter(F.size("places") >= F.col("need"))

    def starts(j: Column) -> Column:
        first, last = F.get("places", j), F.get("places", j + F.col("need") - 1)
        low, high = F.greatest(F.lit(0), last - w + 1), F.least(first, F.col("n") - w)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    every = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size("places") - F.col("need")), starts)))
    asked_for = places.select("doc", "item", "m", w.alias("w"), F.explode(every).alias("start"))
    wanted = asked_for.select("doc", "m", "w", "start").distinct()
    cells = wanted.select("doc", "m", "start", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("w") - 1)).alias("place"))
    values = shared.select("doc", "first", F.posexplode("around").alias("i", "h")).select(
        "doc", (F.col("first") + F.col("i")).alias("place"), "h").distinct()
    windows = cells.join(values, ["doc", "place"]).groupBy("doc", "m", "start").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "h"))), lambda x: x["h"]).alias("own"))
    repeats = F.size(F.array_distinct("own")) < F.size("own")
    windows = stored(windows.withColumn("repeats", repeats), "leak-windows")

    prints = simhash(windows, ["doc", "m", "start"], "own")
    probes = prints.select("doc", "m", "start", "fingerprint", F.inline(blocks(F.col("fingerprint"))))
    masks = F.array(*map(F.lit, near_masks(radius)))
    index = simhash(items, ["item", "m"], "own").withColumnRenamed("fingerprint", "item_print")
    index = index.select("item", "m", "item_print", F.inline(blocks(F.col("item_print")))).select(
        "item", "m", "item_print", "block", F.explode(F.transform(masks, lambda x: F.col("bits").bitwiseXOR(x))).alias("bits"))
    met = probes.join(index, ["m", "block", "bits"]).filter(
        F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= radius).select("doc", "m", "start", "item").distinct()

    odd_windows = asked_for.join(windows.filter("repeats").select("doc", "m", "start"), ["doc", "m", "start"]).select("doc", "m", "start", "item")
    odd_items = asked_for.join(F.broadcast(items.filter(repeats).select("item")) if few else items.filter(repeats).select("item"), "item")
    met = met.union(odd_windows).union(odd_items.select("doc", "m", "start", "item")).distinct()
    pairs = met.join(windows, ["doc", "m", "start"]).join(
        items.select("item", F.col("own").alias("asked")), "item").select(
        "doc", "item", "start", (F.size("own") + F.size("asked")).alias("both"), weighted_shared(F.col("own"), F.col("asked")).alias("n_shared"))
    alike = pairs.filter((100 + SIMILAR) * F.col("n_shared") >= SIMILAR * F.col("both")).withColumn(
        "similarity", F.col("n_shared") / (F.col("both") - F.col("n_shared")))
    return alike.groupBy("doc", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("start"), "n_shared")).alias("best"))
