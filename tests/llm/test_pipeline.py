"""The pipeline's stages, each held against a plain version on its own input."""


import pytest
from helpers import rows_of, shingles_alike, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline as p
    from countwise.llm.frames import stored, table

    docs, out = table(spark, SF, "documents"), []
    for name, stage in p.STAGES:
        after = stored(stage(spark, docs, SF), "test-pipeline")
        out.append((name, docs, after))
        docs = after
    return out


def test_stages(stages):
    assert [n for n, _, _ in stages] == ["quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and 0 < after.count() <= before.count()


def test_quality_keeps_good_documents(spark, stages):
    from countwise.llm.frames import table

    kept = {r["doc_id"] for r in stages[0][2].select("doc_id").collect()}
    labels = table(spark, SF, "labels").collect()
    assert all(r["doc_id"] in kept for r in labels if r["quality"] == 1)
    assert sum(r["doc_id"] in kept for r in labels if r["quality"] == 0) <= 0.1 * sum(r["quality"] == 0 for r in labels)


def test_no_line_is_left_twice(stages):
    from collections import Counter

    lines = Counter(line for r in stages[1][2].collect() for line in r["text"].split("\n") if len(line) >= 20)
    assert max(lines.values()) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in stages[1][2].collect())


def test_no_near_duplicates_are_left(stages):
    texts = [r["text"] for r in stages[2][2].collect()]
    assert not any(shingles_alike(a, b) for i, a in enumerate(texts) for b in texts[:i])


def test_no_benchmark_passage_is_left(spark, stages):
    from countwise.llm.frames import table

    items = [" ".join(words(r["text"].lower())) for r in table(spark, SF, "benchmark").collect()]
    for r in stages[3][2].collect():
        text = " ".join(words(r["text"].lower()))
        assert not any(item in text for item in items)


def test_every_document_is_packed(spark, stages):
    import corpus_pipeline as p

    ids = {r["doc_id"] for r in stages[3][2].select("doc_id").collect()}
    assert {r["doc_id"] for r in stages[4][2].select("doc_id").collect()} == ids
    assert len(rows_of(p.run(spark, SF))) == stages[4][2].count()
