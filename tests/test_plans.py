"""Shapes of physical plans that must hold at any scale."""

import pytest

import __spark_entry__  # noqa: F401
from distaff.operators import losses, sampling
from distaff.operators.ordering import head_slice
from distaff.plans import workload
from distaff.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
# Streams and sinks run their jobs while they are built; their plans are reads.
LAZY = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins(spark, name):
    text = plan(QUERIES[name].build(spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_split_moves_no_payload(spark):
    split = sampling.exact_split(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    text = plan(split)
    assert "Exchange" not in text and "Window" not in text


def test_scores_read_only_their_columns(spark):
    text = plan(workload.scored(spark, SF).select("exact_args"))
    assert "value#" not in text and "ReadSchema: struct<event_id:bigint" in text


def test_top_k_is_limited_before_the_shuffle(spark):
    long = spark.range(100).selectExpr("id % 3 AS p", "id AS token_id", "double(id) AS logprob")
    assert plan(losses.topk_long(long, 5, "p")).count("WindowGroupLimit") == 2


def test_loss_sweep_is_one_scan(spark):
    text = plan(losses.sweep_grid(workload.positions(spark, SF)))
    assert text.count("Scan parquet") == 2  # teacher and student side of one join


def test_head_slice_is_limited_before_the_shuffle(spark):
    rows = spark.range(0, 10_000, 1, 16)
    assert plan(head_slice(rows, 2000, "id")).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name, scans", [("length_stats", 1), ("mode_select", 3), ("class_balance", 3)])
def test_tables_are_read_no_more_often_than_needed(spark, name, scans):
    assert plan(QUERIES[name].build(spark, SF)).count("Scan parquet") <= scans


def test_tokens_are_looked_up_where_the_row_is(spark):
    text = plan(QUERIES["tokenize"].build(spark, SF))
    assert "Exchange" not in text and "Join" not in text


@pytest.mark.parametrize("name", ["fp_overlap", "collect_misses", "multi_model_overlap", "score_calls_v1", "completion_quality"])
def test_a_text_is_parsed_once_and_nothing_filters_below(spark, name):
    optimized = QUERIES[name].build(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    truth = name != "completion_quality"
    assert optimized.count("parseJson") == 1 + truth  # the completion, and the truth it is compared with
    filters = [line for line in optimized.splitlines() if "Filter " in line]
    assert not any("parseJson" in line or "_marked" in line or "_text" in line for line in filters)
