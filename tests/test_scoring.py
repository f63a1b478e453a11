"""Scores against frozen numbers, plain Python and hand-made edge rows."""

import json
import re

import pytest
from pyspark.sql import functions as F

from distaff.operators import misses, quality, scoring
from distaff.operators.examples import eval_examples, scoring_examples
from distaff.operators.filters import classify_completions
from distaff.operators.pairing import missing_predictions, pairing_gaps
from distaff.plans import workload

SF = "/root/testdata/sf0.001"

# model: n, tp, fp, fn, tn, correct_name, exact_args, kept
FROZEN = {
    "base": (795, 237, 238, 160, 160, 237, 157, 397),
    "distilled": (795, 240, 239, 157, 159, 240, 160, 399),
    "sft": (795, 236, 239, 161, 159, 202, 123, 360),
    "teacher": (795, 240, 242, 157, 156, 205, 126, 364),
}


@pytest.fixture(scope="module")
def scored(spark):
    return workload.scored(spark, SF).cache()


def test_frozen_scoreboard(scored):
    for r in scoring.scoreboard(scored).collect():
        assert (r.n, r.tp, r.fp, r.fn, r.tn, r.correct_name, r.exact_args) == FROZEN[r.model][:7]


def test_frozen_kept(spark):
    kept = classify_completions(workload.paired(spark, SF)).filter("expected_behavior IS NOT NULL")
    assert {r["model"]: r["count"] for r in kept.groupBy("model").count().collect()} == {
        m: v[7] for m, v in FROZEN.items()
    }


def test_frozen_overlaps(scored):
    missed = misses.collect_misses(scored)
    r = misses.miss_overlap(missed, "distilled", "sft").first()
    assert (r.n_a, r.n_b, r.n_shared, r.n_only_a) == (237, 274, 171, 66)
    assert misses.identical_wrong(missed, "distilled", "sft").count() == 81
    r = misses.fp_overlap(scored, "distilled", ["teacher"]).first()
    assert (r.n_fp, r.n_reference, r.n_both) == (239, 242, 151)


def test_misses_and_exact_are_all(scored):
    calls = scored.filter(scoring.has_call_truth())
    exact = calls.filter("exact_args").count()
    assert exact + misses.collect_misses(scored).count() == calls.count()


def test_native_equals_exact_reading(spark):
    pairs = workload.scored(spark, SF).select(
        "example_id", "model", "any_json", "correct_name", "exact_args", "exact_match_v1"
    )
    examples = scoring_examples(workload.with_tools(workload.chat_corpus(spark, SF)), exact=True)
    exact = scoring.score_rows(
        workload.score_inputs(examples, workload.predictions(spark, SF)), exact=True
    ).select(pairs.columns)
    assert pairs.exceptAll(exact).count() == 0 and exact.exceptAll(pairs).count() == 0


def python_scores(truth, completion):
    """The scoring rules in plain Python."""
    found = re.search(r"\{.*\}", completion, re.DOTALL)
    try:
        parsed = json.loads(found.group(0)) if found else None
    except ValueError:
        parsed = None
    expected = json.loads(truth)
    lenient = (
        parsed is not None
        and parsed.get("name") == expected.get("name")
        and isinstance(parsed.get("arguments"), dict)
    )
    named = parsed is not None and "name" in parsed and parsed["name"] == expected["name"]
    return (
        parsed is not None,
        lenient,
        lenient and parsed.get("arguments") == expected.get("arguments"),
        named,
        named and parsed.get("arguments", {}) == expected.get("arguments", {}),
    )


EDGE_PAIRS = [
    ('{"name":"f","arguments":{"a":1}}', '{"name":"f","arguments":{"a":1}}'),
    ('{"name":"f","arguments":{"a":1}}', '{"arguments":{"a":1.0},"name":"f"}'),
    ('{"name":"f","arguments":{"a":1}}', '{"name":"f","arguments":{"a":"1"}}'),
    ('{"name":"f","arguments":{}}', '{"name":"f"}'),
    ('{"name":"f"}', '{"name":"f","arguments":{}}'),
    ('{"name":"f"}', '{"name":"f"}'),
    ('{"name":"f"}', '{"name":"f","arguments":null}'),
    ('{"name":"f","arguments":null}', '{"name":"f"}'),
    ('{"name":5,"arguments":{}}', '{"name":"5","arguments":{}}'),
    ('{"name":"f","arguments":{"a":[1,2]}}', '{"name":"f","arguments":{"a":[2,1]}}'),
    ('{"name":"f","arguments":{"a":{"y":1,"x":2}}}', '{"name":"f","arguments":{"a":{"x":2,"y":1}}}'),
    ('{"name":"f","arguments":{}}', '{"name":null,"arguments":{}}'),
    ('{"name":null,"arguments":{}}', '{"arguments":{}}'),
    ('{"name":"f","arguments":{}}', '{"name":"f","arguments":[]}'),
    ('{"name":"f","arguments":{"a":""}}', '{"name":"f","arguments":{}}'),
    ('{"name":"f","arguments":{"a":"é"}}', '{"name":"f","arguments":{"a":"\\u00e9"}}'),
    ('{"name":"f","arguments":{}}', 'call: {"name":"f","arguments":{}} {"x":1}'),
    ('{"name":"f","arguments":{}}', ""),
]


@pytest.mark.parametrize("exact", [False, True])
def test_edge_pairs_equal_python(spark, chats, exact):
    corpus = chats(
        [
            (str(i), "[1]", [("human", "q"), ("function_call", truth)])
            for i, (truth, _) in enumerate(EDGE_PAIRS)
        ]
    )
    outputs = spark.createDataFrame(
        [(str(i), "m", out) for i, (_, out) in enumerate(EDGE_PAIRS)],
        "example_id string, model string, completion string",
    )
    rows = scoring.score_rows(
        scoring_examples(corpus, exact).join(outputs, "example_id"), exact=exact
    ).collect()
    flags = ("any_json", "correct_call_v1", "exact_match_v1", "correct_name", "exact_args")
    got = {int(r.example_id): tuple(r[f] for f in flags) for r in rows}
    assert got == {i: python_scores(t, o) for i, (t, o) in enumerate(EDGE_PAIRS)}


def test_malformed_truth_is_left_out_of_argument_examples(chats):
    corpus = chats(
        [
            ("a", "[1]", [("human", "q"), ("function_call", '{"name": ')]),
            ("b", "[1]", [("human", "q"), ("function_call", '{"arguments": {}}')]),
            ("c", "[1]", [("human", "q"), ("function_call", '{"name": "f"}')]),
            ("d", "[1]", [("gpt", "q"), ("function_call", '{"name": "f"}')]),
            ("e", "[1]", [("human", "q")]),
            ("f", "[1]", []),
            ("g", "[1]", None),
        ]
    )
    assert [r.example_id for r in eval_examples(corpus, "args").collect()] == ["c"]
    decisions = {r.example_id: r.gt_is_call for r in eval_examples(corpus, "decision").collect()}
    assert decisions == {"a": True, "b": True, "c": True}
    with pytest.raises(ValueError):
        eval_examples(corpus, "other")


def counts(spark, *rows):
    schema = "model string, tp bigint, fp bigint, fn bigint, tn bigint"
    return scoring.confusion_rates(spark.createDataFrame(list(rows), schema)).collect()


def test_zero_denominators(spark):
    none, silent = counts(spark, ("none", 0, 0, 0, 0), ("silent", 0, 0, 3, 4))
    assert (none.precision, none.recall, none.f1, none.accuracy) == (0.0, 0.0, 0.0, None)
    assert (silent.precision, silent.recall, silent.f1) == (0.0, 0.0, 0.0)
    assert silent.accuracy == pytest.approx(4 / 7)


def test_published_metrics(spark):
    # n = 240 held-out rows; P / R / F1 / accuracy in percent.
    rows = counts(
        spark, ("base", 121, 118, 0, 1), ("tier2", 120, 3, 1, 116), ("teacher", 121, 59, 0, 60)
    )
    shown = [
        tuple(round(100 * r[c], 1) for c in ("precision", "recall", "f1", "accuracy"))
        for r in rows
    ]
    assert shown == [(50.6, 100.0, 67.2, 50.8), (97.6, 99.2, 98.4, 98.3), (67.2, 100.0, 80.4, 75.4)]


def test_leaderboard_gap(spark):
    metrics = spark.createDataFrame(
        [("base", 0.5), ("mid", 0.75), ("top", 1.0)], "model string, f1 double"
    )
    rows = {r.model: r for r in scoring.leaderboard(metrics, "f1", "base", "top").collect()}
    assert rows["mid"].gap_closed == 0.5 and rows["mid"].place == 2
    assert not rows["base"].beats_baseline and rows["top"].beats_baseline


def test_gaps_and_missing(spark):
    examples = spark.createDataFrame([("a",), ("b",), ("c",)], "example_id string")
    outputs = spark.createDataFrame(
        [("a", "m1"), ("a", "m2"), ("b", "m2"), ("x", "m1")], "example_id string, model string"
    )
    gaps = pairing_gaps(examples, outputs).first()
    assert (gaps.n_without_completion, gaps.n_without_example, gaps.n_paired) == (1, 1, 2)
    missing = missing_predictions(examples, outputs, ["m1", "m2"]).collect()
    assert {(r.example_id, r.model) for r in missing} == {("b", "m1"), ("c", "m1"), ("c", "m2")}


def test_miss_classes(spark):
    schema = (
        "model string, example_id string, gt_args string, pred_args string, "
        "pred_name string, name_matched boolean"
    )
    rows = [
        ("m", "1", '{"a":"cat"}', '{"a":"cats"}', '"f"', True),
        ("m", "2", '{"a":""}', "{}", '"f"', True),
        ("m", "3", '{"d":"2023-10-05"}', '{"d":"2022-01-01"}', '"f"', True),
        ("m", "4", '{"g":"comedy","x":1}', '{"x":1}', '"f"', True),
        ("m", "5", '{"a":1}', '{"a":1,"b":2}', '"f"', True),
        ("m", "6", '{"a":1}', None, None, False),
        ("m", "7", '{"a":1}', '{"a":1}', '"g"', False),
        ("m", "8", '{"a":"x"}', '{"a":"y"}', '"f"', True),
    ]
    found = misses.miss_class(spark.createDataFrame(rows, schema)).collect()
    assert {r.example_id: r.miss_class for r in found} == {
        "1": "singular_plural",
        "2": "placeholder_left_out",
        "3": "date",
        "4": "left_out",
        "5": "added",
        "6": "no_call",
        "7": "other_call",
        "8": "changed",
    }


@pytest.mark.parametrize("n", [1, 2, 9, 10, 20, 97, 100, 200])
def test_percentiles_are_sorted_positions(spark, n):
    lengths = [(i * 7919) % 53 for i in range(n)]
    df = spark.createDataFrame([(x,) for x in lengths], "w bigint")
    got = quality.length_stats(df, F.col("w")).first()
    ordered = sorted(lengths)
    for name, p in quality.PERCENTILES.items():
        assert got[name] == ordered[min(int(n * p), n - 1)]
    assert got["mean"] == pytest.approx(sum(lengths) / n)
