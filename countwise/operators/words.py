"""Word statistics over a document collection (one document per line).

Input is a DataFrame with the identity columns of a document and a
``text`` column, as produced by ``sources.document_lines``.  A hot word
(a third of all tokens) is harmless: every count below is a hash
aggregate whose partial, map-side step folds a task's occurrences of a
word into one row before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countwise.functions.text import space_tokens
from countwise.session import stored

DOC_KEYS = ("doc_id", "line_no")
#: Keys of documents in several rows that are broadcast; more are joined by a shuffle.
BROADCAST_REPEATED = 1 << 20


def tokenize(docs: DataFrame, keys: Sequence[str] = DOC_KEYS, text_col: str = "text") -> DataFrame:
    """One row per token -> (keys.., word)."""
    return docs.select(*keys, F.explode(space_tokens(text_col)).alias("word"))


def doc_word_counts(docs: DataFrame, keys: Sequence[str] = DOC_KEYS) -> DataFrame:
    """A2: per-document histogram -> (keys.., word, n).

    A document that is one row is counted within that row, so only the
    documents' keys are shuffled, to find those of several rows; the words
    of these are counted together by a shuffle.
    """
    keys = list(keys)
    repeated = stored(docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
                      .select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]), "repeated-documents")
    n_repeated = repeated.count()
    if not n_repeated:
        return row_word_counts(docs, keys)
    if n_repeated <= BROADCAST_REPEATED:
        repeated = F.broadcast(repeated)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)])
    together = (tokenize(docs.join(repeated, same, "left_semi"), keys).groupBy(*keys, "word")
                .agg(F.count(F.lit(1)).alias("n")))
    return row_word_counts(docs.join(repeated, same, "left_anti"), keys).unionByName(together)


def row_word_counts(docs: DataFrame, keys: Sequence[str] = DOC_KEYS, text_col: str = "text") -> DataFrame:
    """The histogram of every row by itself -> (keys.., word, n): its tokens are
    sorted and the runs of equal ones counted, without a shuffle."""
    def runs(w: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: (i == 1) | (F.get(w, i - 1) != F.get(w, i - 2)))
        ends = F.concat(F.slice(starts, 2, F.size(w)), F.array(F.size(w) + 1))
        return F.zip_with(starts, ends, lambda i, j: F.struct(
            F.get(w, i - 1).alias("word"), (j - i).cast("bigint").alias("n")))

    # A lambda's argument is computed once; a column could be computed again at every step.
    words = F.filter(F.array(F.sort_array(space_tokens(text_col))), lambda w: F.size(w) > 0)
    return docs.select(*keys, F.explode(F.flatten(F.transform(words, runs))).alias("r")).select(
        *keys, "r.word", F.coalesce(F.col("r.n"), F.lit(0).cast("bigint")).alias("n"))


def word_count(docs: DataFrame, keys: Sequence[str] = DOC_KEYS) -> DataFrame:
    """A3: one-round word count -> (word, n).

    Spark's partial aggregation is the reference's per-document / per-task
    combine; one shuffle of at most (distinct words per task) rows.
    """
    return tokenize(docs, keys).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_salted(docs: DataFrame, num_keys: int, seed: int = 0,
                      keys: Sequence[str] = DOC_KEYS) -> DataFrame:
    """A4: two rounds with random keys -> (word, n).

    Every (document, word) pair draws a key in [0, K-1] from a seeded hash
    of the document identity and the word (deterministic, so a retried
    task reproduces its output).  Round 1 sums by (key, word), round 2 by
    word, so a hot word is spread over up to K reducers in round 1.  The
    per-document combine of the reference is the partial aggregation of
    round 1: all tokens of a document sit in one task and share the key.
    """
    if num_keys < 1:
        raise ValueError("the number of random keys K must be >= 1")
    tok = tokenize(docs, keys)
    salt = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.col("word"), F.lit(seed)),
                  F.lit(num_keys).cast("bigint"))
    round1 = tok.groupBy(salt.alias("salt"), "word").agg(F.count(F.lit(1)).alias("n"))
    return round1.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def word_count_by_partition(docs: DataFrame, keys: Sequence[str] = DOC_KEYS) -> DataFrame:
    """A5: two rounds, the first keyed by the physical input partition
    -> (word, n)."""
    tok = tokenize(docs, keys)
    round1 = (tok.groupBy(F.spark_partition_id().alias("part"), "word")
              .agg(F.count(F.lit(1)).alias("n")))
    return round1.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def word_stats(counts: DataFrame) -> DataFrame:
    """A6 over a word count -> one row (n_distinct_words, total_word_length,
    avg_word_length, avg_word_length_exact).

    ``avg_word_length`` is the reference's integer division of the summed
    lengths of the distinct words by their number; the exact mean is a
    DOUBLE.  Lengths are in characters (code points).
    """
    n = F.count(F.lit(1))
    total = F.coalesce(F.sum(F.length("word").cast("bigint")), F.lit(0).cast("bigint"))
    return counts.agg(
        n.alias("n_distinct_words"),
        total.alias("total_word_length"),
        F.when(n > 0, F.expr("CAST(sum(length(word)) AS BIGINT) div count(1)"))
        .alias("avg_word_length"),
        (total / F.nullif(n, F.lit(0))).alias("avg_word_length_exact"),
    )
