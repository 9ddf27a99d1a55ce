"""Quality classifier by positive-unlabelled learning (operator 7).

A linear scorer over character and word statistics of the whole text is fitted
to trusted positives and unlabelled web text by minimising the non-negative
unbiased risk

    p R+(positives) + max(0, R-(unlabelled) - p R-(positives))

where p is the share of positives among web text and R+, R- are logistic
losses.  Web text is drawn from all documents and p estimated from the two
samples alone, or both come from rated documents.  Fitting uses a bounded
sample; scoring covers every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countwise.llm.frames import pick
from countwise.llm.word_hashes import column_words, text_buffer

#: Most texts of each kind (positives, unlabelled) that the fit looks at.
SAMPLE_ROWS = 8_000
THRESHOLD = 0.3
#: Rows with crc32(doc_id as text) % FOLDS == 0 are held out.
FOLDS = 5
STEPS = 400
RATE = 0.05
PENALTY = 1e-4
#: Rounds of the prior's estimate, and the prior of its first round.
PRIOR_ROUNDS = 3
FIRST_PRIOR = 0.9
#: With fewer texts in half of a sample a share is uncertain by 0.05 and more, and the prior is not estimated from it.
LEAST_HALF = 100

_CLASS = np.zeros(256, np.int64)  # letter, capital, digit, space, line feed, mark, beyond ASCII
for _c in range(256):
    _x = chr(_c)
    _CLASS[_c] = (6 if _c > 127 else 0 if _x.islower() else 1 if _x.isupper() else 2 if _x.isdigit()
                  else 4 if _x == "\n" else 3 if _x.isspace() else 5)
_CLASSES = 7
_WORD_FEATURES = 9
N_FEATURES = 128 + _CLASSES * _CLASSES + _WORD_FEATURES


def text_features(texts: pa.Array) -> np.ndarray:
    """One row per text: byte shares, shares of neighbouring character classes, word statistics."""
    data, at = text_buffer(texts)
    words, word_at = column_words(texts, fold_case=True)
    out = np.zeros((len(texts), N_FEATURES), np.float32)
    kinds = _CLASS[data]
    for k in range(len(texts)):
        lo, hi = at[k], at[k + 1]
        if lo == hi:
            continue
        own, kind, own_words = data[lo:hi], kinds[lo:hi], words[word_at[k]:word_at[k + 1]]
        n, m = hi - lo, max(1, len(own_words))
        row = out[k]
        row[:128] = np.bincount(np.minimum(own, 127), minlength=128) / n
        row[128:128 + _CLASSES * _CLASSES] = np.bincount(kind[:-1] * _CLASSES + kind[1:], minlength=_CLASSES * _CLASSES) / n
        _, counts = np.unique(own_words, return_counts=True)
        top = counts.max() if len(counts) else 0
        lines = 1 + np.count_nonzero(kind == 4)
        again = np.count_nonzero(own_words[1:] == own_words[:-1])
        row[-_WORD_FEATURES:] = (np.log1p(n), np.log1p(len(own_words)), n / m, len(counts) / m, top / m,
                                 np.square(counts / m).sum(), again / m, np.log1p(lines), np.log1p(n / lines))
    return out


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> np.ndarray:
        # Summed row by row: a text's score must not depend on its batch.
        z = (np.clip((features - self.mean) / self.scale, -8, 8) * self.weights).sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Scorer:
    """Minimise the non-negative PU risk by gradient descent with momentum (Adam).

    Where the unlabelled part minus the positives' share of it falls below
    zero, the step goes against that part, so the scorer cannot gain by
    fitting the sample's noise.
    """
    every = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    w, b = np.zeros(every.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradient(x: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(x.T @ slope, slope.sum()) / len(x)

    for step in range(1, STEPS + 1):
        zp, zu = p @ w + b, u @ w + b
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        low = gradient(u, sigmoid(zu)) - prior * gradient(p, sigmoid(zp))
        g = prior * gradient(p, -sigmoid(-zp)) + low if negative >= 0 else -low
        g[:-1] += PENALTY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Scorer(mean, scale, w, b)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled rows.

    Above any score, at most all unlabelled rows are positives and the
    positives among them are as frequent as in the positive sample; so the
    share of unlabelled rows above it, divided by that of positives, is no less
    than the prior, and equal to it where no negative scores so high.  The
    least such ratio over the scores that half of the positives or more reach is
    the estimate.  The scorer comes from one half of both samples with the
    estimate of the round before, the ratios from the other half; the halves
    change places and the mean counts.  A standard error is added before the
    least is taken, which would else be too low in small samples and cost clean
    documents.  Samples too small to halve have the first round's prior.
    """
    if min(len(positive), len(unlabelled)) < 2 * LEAST_HALF:
        return FIRST_PRIOR
    halves = [(positive[k::2], unlabelled[k::2]) for k in (0, 1)]
    found = []
    for (p, u), (other_p, other_u) in (halves, halves[::-1]):
        prior = FIRST_PRIOR
        for _ in range(PRIOR_ROUNDS):
            scorer = fit(p, u, prior)
            of_p, of_u = np.sort(scorer.score(other_p)), np.sort(scorer.score(other_u))
            levels = np.quantile(of_p, np.linspace(0, 0.5, 51))
            above_p, above_u = (1 - np.searchsorted(x, levels) / len(x) for x in (of_p, of_u))
            error = np.sqrt(above_u * (1 - above_u) / len(other_u))
            prior = float(np.clip(((above_u + error) / above_p).min(), 1 / len(other_u), 1))
        found.append(prior)
    return sum(found) / 2


def held_out(doc_id: Column) -> Column:
    """Is the row's label kept from learning?  A null id has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            some = batch.slice(at, 512)
            rows = [x.tobytes() for x in text_features(some.column(2))]
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(rows, pa.binary())], ["id", "trusted", "features"])


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, web: str = "rated") -> Scorer | None:
    """Fit a scorer, or None without trusted positives or unlabelled texts.

    Of the rated documents that are not held out, those with quality 1 are
    trusted (with several ratings: if all are 1).  At most ``sample_rows`` of
    them, the first by a hash of the id, are the positives; as many documents
    taken by another hash are the web text:

    * ``web="all"``: of all documents that are not held out, rated or not.  The
      prior is estimated from the two samples and no rating but the trusted
      positives' is used.
    * ``web="rated"``: of the rated ones, whose ratings are not used; the prior
      is the share of positives among them.  For a few hundred documents, too
      few to estimate a prior.

    Rows without an id are in neither sample.
    """
    if web not in ("all", "rated"):
        raise ValueError("web must be 'all' or 'rated'")
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("bigint").alias("id")).agg((F.min("quality") == 1).alias("good")))
    prior = known.agg(F.avg(F.col("good").cast("double"))).first()[0]
    if not prior:
        return None
    positives = known.filter("good").orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("id", F.lit(True).alias("trusted"))
    ids = known if web == "rated" else (pick(docs, doc_id="doc_id").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
                                        .select(F.col("doc_id").cast("bigint").alias("id")).distinct())
    unrated = ids.orderBy(F.xxhash64("id", F.lit("web")), "id").limit(sample_rows).select("id", F.lit(False).alias("trusted"))
    texts = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # Two samples of bounded size: small enough to send to every task.
    chosen = texts.join(F.broadcast(positives.union(unrated)), F.col("doc_id") == F.col("id")).select("id", "trusted", "text")
    rows = (chosen.mapInArrow(_features, "id BIGINT, trusted BOOLEAN, features BINARY")
            .groupBy("id", "trusted").agg(F.min("features").alias("features")).orderBy("id", "trusted").collect())
    parts = [[np.frombuffer(r["features"], np.float32) for r in rows if r["trusted"] == kind] for kind in (True, False)]
    if not all(parts):
        return None
    positive, unlabelled = np.array(parts[0]), np.array(parts[1])
    return fit(positive, unlabelled, float(prior) if web == "rated" else estimate_prior(positive, unlabelled))


def _score(scorer: Scorer | None, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                scores = np.ones(some.num_rows) if scorer is None else scorer.score(text_features(some.column(text_at)))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(scores)], [*some.schema.names, "quality_score"])

    return run


def with_scores(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """All columns and rows of ``docs`` with ``quality_score`` of the column ``text``.

    A null text counts as empty; an empty text is scored like any other.
    Without a scorer nothing speaks against a text and every score is 1.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_score(scorer, docs.columns.index("text")), f"{fields}, quality_score DOUBLE")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, web: str = "rated") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    The scorer is that of ``learn``.  ``labels`` has doc_id and quality; other columns of both are ignored.
    Repeated rows are scored alike; null ids stay null and are not held out.
    """
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    scored = with_scores(rows, learn(docs, labels, sample_rows, web))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= threshold).cast("int").alias("predicted"))
