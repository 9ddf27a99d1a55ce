"""Small inputs and plain re-implementations for the tests of countwise.llm."""

import os
import random
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id BIGINT, text STRING"


def words(text, fold=False):
    text = text or ""
    if fold:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return WORD.findall(text)


def prose(rng, n, vocabulary=400):
    """n words with line ends and a few capitals, commas and accents."""
    out = []
    for _ in range(n):
        w = f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiouéü')}{rng.randrange(vocabulary)}"
        out.append(w.capitalize() if rng.random() < 0.1 else w)
        if rng.random() < 0.08:
            out[-1] += ".\n" + f"Line{rng.randrange(vocabulary)}"
    return " ".join(out)


def corpus(seed=5):
    """(doc_id, text) with copies, near copies, shared passages, long, short, empty and null texts."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 160)) for _ in range(40)]
    texts += texts[:6]
    for t in texts[6:14]:
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    passage = prose(rng, 60)
    texts += [prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 15) for _ in range(5)]
    texts += [None, "", " \n\t ", "one", "one two three four", "one two three four", "same " * 90, prose(rng, 6000)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows


def frame(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


#: Names that the operators use themselves.
CLASHING = ["a", "b", "h", "n", "key", "rep", "doc", "item", "label", "lines", "line_no", "place", "start", "tile", "bucket", "chunk",
            "tokens", "token", "component", "node", "row", "text_hash", "id", "score", "group", "deal", "part", "bits", "kept"]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING if c not in df.columns])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shingles_alike(a, b):
    sets = []
    for t in (a, b):
        w = words(t, True)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    n = len(sets[0] & sets[1])
    return bool(sets[0]) and 100 * n >= 75 * (len(sets[0]) + len(sets[1]) - n)
