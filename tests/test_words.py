import pytest

from conftest import SF_SMALL
from countwise.operators import words as W
from countwise.plans.reports import report_words
from countwise.sources import document_lines, documents


def lines_df(spark, texts):
    rows = [(i, 0, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id BIGINT, line_no INT, text STRING")


def test_blank_docs_tokens(spark):
    df = lines_df(spark, ["", "  ", " a  b "])
    got = {}
    for r in W.tokenize(df).collect():
        got.setdefault(r["doc_id"], []).append(r["word"])
    assert got.get(0) == [""]
    assert 1 not in got
    assert got.get(2) == ["", "a", "", "b"]


def test_tabs_stay_in_tokens(spark):
    df = lines_df(spark, ["a\tb c "])
    assert [r["word"] for r in W.tokenize(df).collect()] == ["a\tb", "c"]


def test_document_lines_split(spark):
    docs = spark.createDataFrame([(7, "x y\nz\n")], "doc_id BIGINT, text STRING")
    rows = [(r["doc_id"], r["line_no"], r["text"]) for r in document_lines(docs).collect()]
    assert rows == [(7, 0, "x y"), (7, 1, "z"), (7, 2, "")]


@pytest.fixture(scope="module")
def doc_lines(spark):
    df = document_lines(documents(spark, SF_SMALL)).cache()
    yield df
    df.unpersist()


def test_four_word_counts_agree(doc_lines):
    base = sorted(map(tuple, W.word_count(doc_lines).collect()))
    assert sorted(map(tuple, W.word_count_salted(doc_lines, 8, 3).collect())) == base
    assert sorted(map(tuple, W.word_count_by_partition(doc_lines).collect())) == base
    per_doc = W.doc_word_counts(doc_lines).groupBy("word").sum("n")
    assert sorted(map(tuple, per_doc.collect())) == base


def test_word_stats_and_report(doc_lines):
    wc = W.word_count(doc_lines)
    words = [r["word"] for r in wc.collect()]
    s = W.word_stats(wc).first()
    assert s["n_distinct_words"] == len(words)
    total = sum(len(w) for w in words)
    assert s["total_word_length"] == total
    assert s["avg_word_length"] == total // len(words)
    rep = report_words(doc_lines).first()
    assert rep["n_docs"] == doc_lines.count()
    assert rep["n_distinct_words"] == len(words)


def test_salted_rejects_bad_k(doc_lines):
    with pytest.raises(ValueError):
        W.word_count_salted(doc_lines, 0)


def test_word_count_from_text_file(spark, tmp_path):
    from countwise.sources import read_documents
    f = tmp_path / "docs.txt"
    f.write_text("a b a\nb  c \n\n")
    docs = read_documents(spark, str(f))
    got = {r["word"]: r["n"] for r in W.word_count(docs).collect()}
    # line 2 "b  c " -> ["b", "", "c"]; line 3 "" -> [""]
    assert got == {"a": 2, "b": 2, "c": 1, "": 2}
    rep = report_words(docs).first()
    assert rep["n_docs"] == 3 and rep["n_distinct_words"] == 4


def test_doc_word_counts_shuffle_no_words(spark, monkeypatch):
    """Rows of one key are counted together, all others where they stand: no exchange is keyed by a word."""
    rows = [(1, 0, "b a b  a\ta"), (1, 1, ""), (2, 0, " "), (3, 0, None), (4, 0, "a b"), (4, 0, "b c"), (None, 0, "a"), (None, 0, "a a")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, line_no INT, text STRING")
    want = {(1, 0, "b", 2), (1, 0, "a", 1), (1, 0, "", 1), (1, 0, "a\ta", 1), (1, 1, "", 1),
            (4, 0, "a", 1), (4, 0, "b", 2), (4, 0, "c", 1), (None, 0, "a", 3)}
    for limit in (W.BROADCAST_REPEATED, 0):
        monkeypatch.setattr(W, "BROADCAST_REPEATED", limit)
        got = list(map(tuple, W.doc_word_counts(df).collect()))
        assert len(got) == len(want) and set(got) == want
    single = W.doc_word_counts(df.where("doc_id <= 3"))
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
    assert set(map(tuple, single.collect())) == {r for r in want if r[0] in (1, 2, 3)}
