"""Every operator against a plain version on small inputs."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import corpus, frame, prose, rows_of, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from countwise.llm import decontamination, embeddings, line_dedup, minhash, packing, quality, substrings, token_codes, url_filter
from countwise.llm.components import components, local_roots
from countwise.llm.queries import tokenizer_file
from countwise.llm.tokenizing import Encoder
from countwise.llm.word_hashes import column_words, run_hashes
from countwise.session import scratch_path


def least_members(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


# -- helpers -----------------------------------------------------------------

def test_word_hashes_tell_words_apart_and_runs_follow_words():
    texts = [t for _, t in corpus()] + ["x\ty\x0bz", "Ä ä", " lead", "trail "]
    for fold in (False, True):
        hashes, offsets = column_words(pa.array(texts), fold)
        own = [words(t, fold) for t in texts]
        assert np.diff(offsets).tolist() == [len(w) for w in own]
        names = {}
        for h, w in zip(hashes.tolist(), sum(own, [])):
            assert names.setdefault(h, w) == w
        assert len(names) == len({w for ws in own for w in ws})
    flat = sum(own, [])
    runs = {}
    for k, h in enumerate(run_hashes(hashes, 3).tolist()):
        assert runs.setdefault(h, flat[k:k + 3]) == flat[k:k + 3]
    sliced = pa.array(["drop", None, "keep this", ""]).slice(1, 3)
    assert np.diff(column_words(sliced)[1]).tolist() == [0, 2, 0]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(7, 7), (None, 3), (200, 199)]
    got = dict(rows_of(components(frame(spark, links, "a BIGINT, b BIGINT"))))
    real = [(a, b) for a, b in links if a is not None]
    want = least_members({x for l in real for x in l}, real)
    assert got == {n: c for n, c in want.items() if n != c}
    i, j = (np.array([x[k] for x in real if max(x) < 100]) for k in (0, 1))
    roots = local_roots(100, i, j)
    assert all(roots[n] == c for n, c in want.items() if n < 100)


ODD_TEXTS = ["", None, "  a", "a  b\n\n c", "a\n\nb", "x ", "\n", "é́ a", "A'S b's 's 12 1a", "日本 語　x", "a\tb", "<|endoftext|> hi", "\x1ca b",
             "a\r\nb", "İstanbul ΑΣ Σ", "a\xa0b", "a b", "a|b | c", "x’s “q”", "́a b", " ", "a\x1cb", "don't we'll THE The the"]


@pytest.mark.parametrize("name,kind", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_encoder_equals_the_library(name, kind):
    e = Encoder(tokenizer_file(name), kind)
    texts = ODD_TEXTS + [t for _, t in corpus()] + ODD_TEXTS
    for _ in range(2):  # from the library, then from the cache
        ids, offsets = e.encode(pa.array(texts))
        for t, lo, hi in zip(texts, offsets[:-1], offsets[1:]):
            assert ids[lo:hi].tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)[:60]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1 \n\t'|.,éß ́", max_size=30), max_size=6))
def test_encoder_on_any_text(texts):
    for name, kind in (("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")):
        e = ENCODERS.setdefault(kind, None) or ENCODERS.update({kind: Encoder(tokenizer_file(name), kind)}) or ENCODERS[kind]
        ids, offsets = e.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


ENCODERS = {}


# -- 1 -------------------------------------------------------------------------

@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_automaton(spark, edits):
    rng, rows = random.Random(edits), []
    for _ in range(600):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 9)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k, i = rng.randint(0, 2), rng.randint(0, len(b))
            if k == 0:
                b.insert(i, rng.choice("abé"))
            elif b and k == 1:
                b.pop(min(i, len(b) - 1))
            elif b:
                b[min(i, len(b) - 1)] = rng.choice("abé")
        rows.append((a, "".join(b)))
    got = frame(spark, rows, "a STRING, b STRING").select("a", "b", line_dedup.within_edits(F.col("a"), F.col("b"), edits).alias("near")).collect()
    assert all(r["near"] == (edit_distance(r["a"], r["b"]) <= edits) for r in got)


@pytest.mark.parametrize("edits", [1, 2])
def test_line_dedup(spark, edits):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(5, 30))) for _ in range(60)]
    lines = []
    for _ in range(400):
        line = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            line[rng.randrange(len(line))] = rng.choice(["", "x", "yz"])
        lines.append("".join(line))
    docs, k = [], 0
    while k < len(lines):
        n = rng.randint(1, 6)
        docs.append((rng.randrange(10**6), "\n".join(lines[k:k + n])))
        k += n
    places = [(d, i, line) for d, t in sorted(docs) for i, line in enumerate(t.split("\n"))]
    want = {d: [] for d, _ in docs}
    seen = []
    for d, i, line in places:
        if len(line) < 8 or not any(abs(len(s) - len(line)) <= edits and edit_distance(s, line) <= edits for s in seen):
            want[d].append(line)
        if len(line) >= 8:
            seen.append(line)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(spark, docs), ((8, edits),), 8).collect()}
    for d, t in docs:
        assert got[d]["kept_text"] == "\n".join(want[d])
        assert (got[d]["n_lines"], got[d]["n_removed"]) == (t.count("\n") + 1, t.count("\n") + 1 - len(want[d]))


# -- 2 -------------------------------------------------------------------------

@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_codes_round_trip_and_random_access(ids):
    chunks, bitmaps, ranks = token_codes.encode_codes(np.array(ids, np.uint32))
    assert token_codes.decode_codes(chunks, bitmaps).tolist() == ids
    for i in range(0, len(ids), 37):
        assert token_codes.access(chunks, bitmaps, ranks, i) == ids[i]


def test_token_files(spark):
    e = Encoder(tokenizer_file("word_bpe_49k.json"), "word")
    docs = sorted(corpus())
    every = [e.tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for _, t in docs]
    path = scratch_path(spark, "test-codes")
    token_codes.write_token_files(frame(spark, docs).repartition(5), path, tokenizer_file("word_bpe_49k.json"))
    start, want = 0, []
    for (d, _), ids in zip(docs, every):
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(rows_of(token_codes.read_token_files(spark, path))) == want
    flat = sum(every, [])
    for place in (0, 17, len(flat) // 2, len(flat) - 1):
        assert token_codes.token_at(spark, path, place) == flat[place]
    assert token_codes.token_at(spark, path, len(flat)) is None


# -- 3: by SQL, and the pruning here ---------------------------------------------

def test_mined_rules(spark):
    rows = [(["a", "b"], True)] * 10 + [(["a"], False)] * 10 + [(["b", "c"], True)] * 5 + [(["d"], True)]
    found = url_filter.mine_rules(frame(spark, rows, "tokens ARRAY<STRING>, blocked BOOLEAN"), 0.1, 0.9).collect()
    assert [r["tokens"] for r in found if len(r["tokens"]) == 1] == [["b"], ["c"]] or {tuple(r["tokens"]) for r in found} == {("b",), ("c",)}
    assert {tuple(r["tokens"]) for r in found} == {("b",), ("c",)}  # a+b and b+c add nothing, d is too rare


# -- 4 -------------------------------------------------------------------------

def test_packing(spark):
    e = Encoder(tokenizer_file("byte_bpe_50k.json"), "byte")
    docs = dict(corpus())
    want = {d: e.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t in docs.items()}
    parts = packing.pieces(frame(spark, list(docs.items())), tokenizer_file("byte_bpe_50k.json"), with_ids=True)
    packed = packing.pack(parts, len(docs)).collect()
    back = {}
    for r in sorted(packed, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(back.setdefault(r["doc_id"], [])) and r["length"] == len(r["ids"]) <= 1024
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert r["piece"] == 0 or r["length"] == 1024
        back[r["doc_id"]] += r["ids"]
    assert back == want
    bins = {}
    for r in sorted(packed, key=lambda r: r["offset"]):
        assert r["offset"] == len(bins.setdefault(r["sequence_id"], []))
        bins[r["sequence_id"]] += r["ids"]
    assert max(map(len, bins.values())) <= 1024
    assert len(bins) <= sum(map(len, want.values())) / 1024 * 1.05 + 1
    whole = packing.assemble(packing.pack(parts, len(docs)))
    assert {r["sequence_id"]: r["ids"] for r in whole.collect()} == bins


def test_sum_of_squares_rule():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 41, 300))[::-1]
    bins, offsets = packing.sum_of_squares(lengths, 40)
    gaps = {}
    for s, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        open_gaps = Counter(g for g in gaps.values() if g)

        def total(g):  # of squares, after a sequence of gap g takes s
            after = Counter(open_gaps)
            after[g] -= 1
            after[g - s] += g > s
            return sum(n * n for n in after.values())

        fits = [g for g in open_gaps if g >= s]
        if b in gaps:
            assert o == 40 - gaps[b] and total(gaps[b]) == min(map(total, fits))
        else:
            assert o == 0 and not fits
        gaps[b] = gaps.get(b, 40) - s


# -- 5 -------------------------------------------------------------------------

def shingle_list(text):
    w = [x for x in words((text or "").lower())]
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def test_leaks(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.randint(5, 50))) for i in range(12)] + [(20, "tiny item"), (21, "round and round " * 8)]
    docs = []
    for k in range(60):
        text = prose(rng, rng.randint(0, 80))
        if k % 3 == 0:
            part = rng.choice(items)[1].split(" ")
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                part[rng.randrange(len(part))] = "edit"
            text += " " + " ".join(part).upper() + " " + prose(rng, rng.randint(0, 30))
        docs.append((k, text))
    docs += [(100, "Tiny  item"), (101, "a tiny item here and more"), (102, "round and round " * 30)] + [(103, items[0][1]), (104, " ".join(items[1][1].split(" ")[:-1]))]
    want = {}
    for d, t in docs:
        own = shingle_list(t)
        for i, x in items:
            asked = shingle_list(x)
            w = min(len(own), len(asked))
            best = None
            for s in range(len(own) - w + 1 if w else 0):
                n = sum((Counter(own[s:s + w]) & Counter(asked)).values())
                if 175 * n >= 75 * (w + len(asked)) and (best is None or n > best[1]):
                    best = (s, n, n / (w + len(asked) - n))
            if best:
                want[d, i] = best
    got = decontamination.find_leaks(frame(spark, docs), frame(spark, items, "item_id BIGINT, text STRING"))
    assert {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in got.collect()} == want
    kept = decontamination.without_leaks(frame(spark, docs), frame(spark, items, "item_id BIGINT, text STRING"))
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_simhash_and_blocks(spark):
    rng = random.Random(2)
    rows = [(i, [rng.getrandbits(64) - 2**63 for _ in range(rng.randint(1, 30))]) for i in range(20)]
    got = dict(rows_of(decontamination.simhash(frame(spark, rows, "k INT, v ARRAY<BIGINT>"), ["k"], "v")))
    for k, values in rows:
        bits = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))
        assert got[k] % 2**64 == bits
    masks = decontamination.near_masks(24)
    assert len(masks) == len(set(masks)) == 93 and max(m.bit_count() for m in masks) == 3


# -- 6 -------------------------------------------------------------------------

def shingle_set(text):
    w = words(text, True)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_texts():
    """A large group of near copies at all similarities, beside the usual corpus."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = corpus()
    for k in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        rows.append((1000 + k, " ".join(w)))
    return rows


def check_minhash(got, docs):
    sets = {d: shingle_set(t) for d, t in docs}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if sets[a]
             and 100 * (n := len(sets[a] & sets[b])) >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    want = least_members(ids, links)
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == {d: (len(sets[d]), want[d], want[d] == d) for d in ids}


def test_minhash(spark, monkeypatch):
    docs = near_texts()
    check_minhash(minhash.near_duplicates(frame(spark, docs)), docs)
    monkeypatch.setattr(minhash, "TILE", 16)  # many tiles per group, many groups of tiles
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 50)
    check_minhash(minhash.near_duplicates(frame(spark, docs)), docs)


def test_match_threshold():
    assert minhash.match_threshold(75) == 21
    assert minhash.match_threshold(75) < minhash.match_threshold(90) <= minhash.COORDINATES


# -- 7 -------------------------------------------------------------------------

@pytest.mark.parametrize("web", ["all", "rated"])
def test_quality(spark, web):
    rng = random.Random(4)
    docs, labels = [], []
    for d in range(600):
        bad = d % 6 == 0
        text = prose(rng, rng.randint(5, 80))
        docs.append((d, " ".join(w + "%%%" for w in text.split(" ")) if bad else text))
        labels.append((d, int(not bad), 0))
    out = quality.classify(frame(spark, docs), frame(spark, labels, "doc_id BIGINT, quality INT, toxic INT"), web=web).collect()
    assert len(out) == 600 and all(0 <= r["score"] <= 1 for r in out)
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert sum(r["predicted"] == int(r["doc_id"] % 6 > 0) for r in held) >= 0.95 * len(held)
    # Held-out labels change nothing.
    turned = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q, t) for d, q, t in labels]
    again = quality.classify(frame(spark, docs), frame(spark, turned, "doc_id BIGINT, quality INT, toxic INT"), web=web)
    assert {r["doc_id"]: r["score"] for r in again.collect()} == {r["doc_id"]: r["score"] for r in out}
    if web == "all":
        # Nor do ratings other than the trusted positives'.
        trusted = quality.classify(frame(spark, docs), frame(spark, [x for x in labels if x[1] == 1], "doc_id BIGINT, quality INT, toxic INT"), web=web)
        assert {r["doc_id"]: r["score"] for r in trusted.collect()} == {r["doc_id"]: r["score"] for r in out}


def plain_risk(scorer, positive, unlabelled, prior):
    """The non-negative PU risk with logistic losses, term by term."""
    def margin(x):
        return sum(float(np.clip((v - m) / s, -8, 8)) * w for v, m, s, w in zip(x, scorer.mean, scorer.scale, scorer.weights)) + scorer.bias

    def loss(z):
        return math.log1p(math.exp(-z))

    p, u = [margin(x) for x in positive], [margin(x) for x in unlabelled]
    negative = sum(loss(-z) for z in u) / len(u) - prior * sum(loss(-z) for z in p) / len(p)
    return prior * sum(loss(z) for z in p) / len(p) + max(0.0, negative)


@pytest.mark.parametrize("prior", [0.25, 0.6, 0.9])
def test_quality_prior(prior):
    rng = np.random.default_rng(5)
    positive = rng.normal(1.5, 1, (2000, 3))
    unlabelled = np.where(rng.random((2000, 1)) < prior, rng.normal(1.5, 1, (2000, 3)), rng.normal(-1.5, 1, (2000, 3)))
    assert abs(quality.estimate_prior(positive, unlabelled) - prior) < 0.05
    assert quality.estimate_prior(positive[:20], unlabelled) == quality.FIRST_PRIOR
    assert 0 < quality.estimate_prior(positive, -np.abs(unlabelled) - 5) < 0.01


def test_quality_fit_minimises_the_plain_risk():
    rng = np.random.default_rng(3)
    prior = 0.6
    positive = rng.normal(1, 1.5, (300, 3))
    unlabelled = np.where(rng.random((400, 1)) < prior, rng.normal(1, 1.5, (400, 3)), rng.normal(-1, 1.5, (400, 3)))
    fitted = quality.fit(positive, unlabelled, prior)
    least = plain_risk(fitted, positive, unlabelled, prior)
    # No small step in any direction does better than the weight penalty and the descent's last step account for.
    for _ in range(20):
        other = quality.Scorer(fitted.mean, fitted.scale, fitted.weights + rng.normal(0, 0.2, 3), fitted.bias + rng.normal(0, 0.2))
        assert plain_risk(other, positive, unlabelled, prior) > least - 1e-3
    nothing = quality.Scorer(fitted.mean, fitted.scale, np.zeros(3), 0.0)
    assert least < plain_risk(nothing, positive, unlabelled, prior) - 0.05
    # Scores follow the prior: with few positives among web text they are lower.
    assert quality.fit(positive, unlabelled, 0.2).score(unlabelled).mean() < fitted.score(unlabelled).mean()


# -- 9 -------------------------------------------------------------------------

@pytest.mark.parametrize("tile", [1024, 7])
def test_embeddings(spark, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rng = np.random.default_rng(6)
    rows = []
    for k in range(12):
        centre = rng.normal(size=16)
        for _ in range(10):
            v = centre + rng.normal(size=16) * rng.choice([0, 0.05, 0.12, 0.2])
            rows.append((len(rows), [float(np.float32(x)) for x in v * rng.choice([0.001, 1, 1000])], k % 3))
    rows += [(len(rows) + i, rows[i][1], rows[i][2]) for i in range(5)]
    x = np.array([r[1] for r in rows])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = unit @ unit.T >= 0.98
    links = [(i, j) for i in range(len(rows)) for j in range(i) if close[i, j] and rows[i][2] == rows[j][2]]
    want = least_members(range(len(rows)), links)
    n = Counter(i for link in links for i in link)
    got = embeddings.near_duplicates(frame(spark, rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")).collect()
    assert {r["vec_id"]: tuple(r)[1:] for r in got} == {i: (n[i], want[i], want[i] == i) for i in range(len(rows))}


def test_quantisation_bound():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 24)) * np.exp(rng.normal(size=(80, 24)) * 2)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    q, s, c, e = embeddings.quantise(unit)
    product = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s
    bound = e[:, None] * c + c[:, None] * e + e[:, None] * e
    assert (np.abs(unit @ unit.T - product) <= bound + 1e-12).all()


# -- 10 ------------------------------------------------------------------------

@pytest.mark.parametrize("window", [35, 4])
def test_substrings(spark, monkeypatch, window):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(substrings, "BUCKET_WORDS", 500)
    docs = corpus()
    seen = Counter(tuple(w[i:i + window]) for _, t in docs for w in [words(t)] for i in range(len(w) - window + 1))
    want = {}
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = substrings.remove_repeats(frame(spark, docs), window).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want
    assert any(n for _, n, _ in want.values())
