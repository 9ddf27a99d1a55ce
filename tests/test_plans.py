"""Plan shapes: what the optimizer must keep doing for the scale story.

Physical plans are inspected before execution (AQE may later turn a
shuffle join into a broadcast from measured sizes, never into a cartesian
product)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

STREAMING = {"stream_frequencies", "stream_frequencies_stateful", "stream_count_sketch",
             "stream_distinct_items", "stream_prefix", "batch_counts",
             "stream_report_sketch", "stream_report_distinct", "stream_distinct_set"}


@pytest.fixture(autouse=True)
def no_cached_data(spark):
    # a cached relation would replace the Parquet scan in the plan
    spark.catalog.clearCache()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - STREAMING))
def test_no_cartesian_or_nested_loop(spark, name):
    text = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name,partial", [
    ("item_frequencies", "partial_count"),
    ("count_sketch", "partial_sum"),
    ("word_count", "partial_count"),
    ("word_count_salted", "partial_count"),
    ("canonical_edges", "HashAggregate(keys=[u"),
])
def test_partial_aggregation_before_shuffle(spark, name, partial):
    text = plan(E.queries()[name](spark, SF_SMALL))
    assert partial in text
    # the partial step sits below (is printed after) the first exchange
    assert text.index("Exchange") < text.rindex(partial)


def test_scan_prunes_columns_and_pushes_range(spark):
    text = plan(E.queries()["items_in_range"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint>" in text
    assert "GreaterThanOrEqual(l_partkey" in text and "LessThanOrEqual(l_partkey" in text


def test_triangle_plan_uses_hash_joins_on_vertices(spark):
    text = plan(E.queries()["exact_tc"](spark, SF_SMALL))
    # the neighbour lists are read back, so both sides are shuffle stages
    assert text.count("Join") == text.count("ShuffledHashJoin") == 1
    assert text.count("Exchange hashpartitioning(dst") == 2


def test_sketch_family_is_a_literal_explode(spark):
    text = plan(E.queries()["count_sketch"](spark, SF_SMALL))
    assert "Generate explode(" in text
    assert "Join" not in text


def test_words_take_one_shuffle(spark):
    text = plan(E.queries()["word_count"](spark, SF_SMALL))
    assert text.count("Exchange") == 1


def test_word_report_reads_the_text_once(spark):
    text = plan(E.queries()["report_words"](spark, SF_SMALL))
    assert text.count("FileScan") == 1
