"""Ranked search, token counts and hard negatives against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import corpus, frame, prose, rows_of, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from countwise.llm import hard_negatives, lexical, token_counts
from countwise.llm.queries import tokenizer_file

BYTE_FILE = tokenizer_file("byte_bpe_50k.json")
ITEMS = "item_id BIGINT, text STRING"
VECTOR = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# -- ranked search -----------------------------------------------------------

def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, top=20):
    own = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in own:
            n, score = sum(c.values()), 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // total)))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def items_for(docs, rng):
    texts = [t for _, t in docs if t and len(t) > 100]
    cuts = [" ".join(rng.choice(texts).split(" ")[3:40]) for _ in range(12)]
    return [*enumerate(cuts), (90, None), (91, " .,; "), (92, "word that none has: zzzq"), (93, "same same SAME"), (2, cuts[0]), (None, cuts[1]), (94, prose(rng, 900))]


@pytest.mark.parametrize("top", [1, 5, 20])
def test_search_finds_the_best_documents(spark, top):
    rng = random.Random(top)
    docs = corpus(top) + [(200, "same " * 40 + "rare"), (200, "same rare"), (None, "same rare"), (None, None), (7, "Same, same!")]
    items = items_for(docs, rng)
    out = rows_of(lexical.search(frame(spark, docs), frame(spark, items, ITEMS), top))
    assert out == plain_search(docs, items, top)
    again = lexical.search(with_clashes(frame(spark, docs[::-1]).repartition(5)), with_clashes(frame(spark, items[::-1], ITEMS)), top)
    assert rows_of(again) == out


def test_search_for_items_in_blocks_and_candidates_by_shuffle(spark, monkeypatch):
    docs = corpus(3)
    items = items_for(docs, random.Random(3))
    monkeypatch.setattr(lexical, "QUERY_ITEMS", 4)
    monkeypatch.setattr(lexical, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 8)
    assert rows_of(lexical.search(frame(spark, docs), frame(spark, items, ITEMS))) == plain_search(docs, items)


def test_search_in_nothing_and_for_nothing(spark):
    docs, items = corpus(), items_for(corpus(), random.Random(1))
    assert lexical.search(frame(spark, []), frame(spark, items, ITEMS)).count() == 0
    assert lexical.search(frame(spark, docs), frame(spark, [], ITEMS)).count() == 0
    assert lexical.search(frame(spark, [(1, None), (2, "")]), frame(spark, items, ITEMS)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([f"t{i}" for i in range(60)]), min_size=1, max_size=90), min_size=1, max_size=30), st.integers(0, 99))
def test_bounds_are_never_below_scores(texts, seed):
    """Also with signatures so narrow that most bits are set."""
    rng = random.Random(seed)
    import pyarrow as pa

    vocabulary, _ = lexical.terms_of(pa.array([f"t{i}" for i in range(60)]))
    known = np.sort(vocabulary)
    entry = sorted({(rng.randrange(60), rng.randrange(14)) for _ in range(200)})
    n_terms = sum(map(len, texts))
    query = lexical.Query(known, np.array([rng.randrange(9000) for _ in known]), np.array([q for _, q in entry]), np.array([t for t, _ in entry]),
                          np.array([rng.randrange(1, 4) for _ in entry]), 14, len(texts), n_terms)
    block = lexical._Block(rng.choice([8, 64, 1024]))
    exact = np.zeros((14, len(texts)))
    sizes = np.array([len(t) for t in texts])
    damping = query.damping(sizes)
    for d, text in enumerate(texts):
        _, term, count = lexical._counted(*lexical.terms_of(pa.array([" ".join(text)])))
        block.add(d, len(text), term, count)
        tf = dict(zip(np.searchsorted(known, term).tolist(), count.tolist()))
        for (t, q), r in zip(entry, query.repeats):
            if t in tf:
                exact[q, d] += r * query.weights[t] * (1000000000 * tf[t] // (1000 * tf[t] + damping[d]))
    bounds = lexical.upper_bounds(query, block.width, sizes, block.slices())
    assert (bounds >= exact).all()
    if block.width == 1024 * lexical.BITS:
        assert (bounds[exact == 0] == 0).mean() > 0.9


# -- token counts ------------------------------------------------------------

def plain_counts(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTE_FILE)
    out = []
    for d, t in docs:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        out.append((d, len((t or "").encode()), n, n > 512))
    return sorted(out, key=repr)


def odd_text(rng, n):
    parts = [" ", "  ", "\n", "\n\n  ", "'ll", "'", "it's", "<|endoftext|>", "<|endof", "text|>", "été", "日本", "\U0001F600", "　", "12345", "!!!", "a", "Word", "\t"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_token_counts(spark):
    rng = random.Random(12)
    docs = corpus() + [(300 + i, odd_text(rng, 3000)) for i in range(12)] + [(500, "a <|endoftext|> b"), (500, "other"), (None, "no id"), (None, None),
                                                                            (600, "ab" * 20000), (601, " " * 9000), (602, prose(rng, 9000)), (603, prose(rng, 9000) + "x" * 5000)]
    docs += docs[-3:]
    plain = plain_counts(docs)
    assert rows_of(token_counts.count_tokens(frame(spark, docs), BYTE_FILE)) == plain
    for chunk, overlap in ((64, 32), (300, 40), (5000, 500)):
        assert rows_of(token_counts.count_tokens(with_clashes(frame(spark, docs).repartition(3)), BYTE_FILE, chunk=chunk, overlap=overlap)) == plain
    assert token_counts.count_tokens(frame(spark, []), BYTE_FILE).count() == 0


def test_chunks_of_one_text_are_counted_in_several_tasks_and_widened(spark, monkeypatch):
    """A run without a boundary, longer than several chunks, needs wider overlaps."""
    rounds = []
    encode = token_counts._encode
    monkeypatch.setattr(token_counts, "_encode", lambda path, chunk, overlap: rounds.append((chunk, overlap)) or encode(path, chunk, overlap))
    rng = random.Random(4)
    docs = [(1, prose(rng, 400) + " " + "z" * 3000 + " " + prose(rng, 400)), (2, prose(rng, 1000))]
    assert rows_of(token_counts.count_tokens(frame(spark, docs), BYTE_FILE, chunk=400, overlap=50)) == plain_counts(docs)
    assert rounds == [(400, 50), (800, 200), (3200, 800)]


def test_files_whose_chunks_cannot_be_spliced_raise(spark):
    with pytest.raises(ValueError):
        token_counts.count_tokens(frame(spark, corpus()), tokenizer_file("word_bpe_49k.json"))
    with pytest.raises(ValueError):
        token_counts.count_tokens(frame(spark, corpus()), BYTE_FILE, chunk=64, overlap=10)


# -- hard negatives ----------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.integers(0, 2 ** 27), st.integers(0, 10 ** 6))
def test_products_are_exact(dims, size, seed):
    rng = np.random.default_rng(seed)
    x, y = (rng.integers(-size, size + 1, (n, dims)) for n in (5, 7))
    bound = max((m.astype(object) ** 2).sum(axis=1).max() for m in (x, y))
    if bound >= 1 << 57:
        return
    primes = hard_negatives.primes_for(float(bound) * 1.0001)
    assert len(primes) >= 2
    assert (hard_negatives.exact_products(x, y, primes) == x.astype(object) @ y.T.astype(object)).all()


def plain_negatives(rows, every, scale=256):
    best = {}
    for v, x, label in rows:
        if v is None or x is None or label is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        codes = [math.floor(scale * float(np.float32(c))) for c in x]
        best[v] = min(best.get(v, (label, codes)), (label, codes))
    out = []
    for a in sorted(best):
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(best[a][1], c)), v, label) for v, (label, c) in best.items() if v != a)
        same = [s for s in scored if s[2] == best[a][0]][:5]
        for ps, p, _ in same:
            ps = -ps
            inside = [s for s in scored if s[2] != best[a][0] and 50 * ps <= 100 * -s[0] <= 95 * ps][:3]
            out += [(a, p, k, s[1], ps, -s[0]) for k, s in enumerate(inside, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [4096, 16, 3])
def test_hard_negatives(spark, tile):
    rng = random.Random(tile)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.5, 0.7, 2.0]) for _ in range(rng.choice([3, 6, 6, 6]))], rng.randrange(4)) for i in range(120)]
    inf, nan = float("inf"), float("nan")
    rows += [(0, [0.5] * 6, 1), (5, [3.0] * 6, 0), (200, None, 1), (205, [], 1), (210, [None, 1.0], 1), (215, [inf], 1), (220, [nan, 1.0], 2), (225, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    rows += [rows[7]] * 3 + [(300 + i, [2.0] * 6, 0) for i in range(40)]
    plain = plain_negatives(rows, 5)
    assert plain
    every = F.col("vec_id") % 5 == 0
    assert rows_of(hard_negatives.mine(frame(spark, rows, VECTOR), every, tile_rows=tile)) == plain
    assert rows_of(hard_negatives.mine(with_clashes(frame(spark, rows[::-1], VECTOR).repartition(4)).withColumn("label", F.col("label")), every, tile_rows=tile)) == plain


def test_no_vectors_no_anchors_and_scores_beyond_the_primes(spark):
    every = F.col("vec_id") % 5 == 0
    assert hard_negatives.mine(frame(spark, [], VECTOR), every).count() == 0
    assert hard_negatives.mine(frame(spark, [(1, [1.0], 1), (2, [1.0], 1)], VECTOR), every).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.mine(frame(spark, [(5, [1e30], 1)], VECTOR), every)
