"""Registered queries: pairing, quality checks, scores and misses."""

from pyspark.sql import functions as F

from distaff.operators import filters, misses, pairing, quality, scoring
from distaff.operators.ordering import sorted_rows
from distaff.operators.sampling import exact_split
from distaff.plans import twins
from distaff.plans.registry import query
from distaff.plans.workload import MODELS, chat_corpus, paired, predictions, scored
from distaff.operators.examples import scoring_examples
from distaff.operators.prompts import turn


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _misses(spark, sf):
    return misses.collect_misses(scored(spark, sf))


def _human(spark, sf):
    return filters.with_tools(chat_corpus(spark, sf)).filter(turn(0, "from") == "human")


_BOARD_SQL = """,
board as (
  select model, count(*) as n,
    count(*) filter (gt_is_call and pred_is_call) as tp,
    count(*) filter (not gt_is_call and pred_is_call) as fp,
    count(*) filter (gt_is_call and not pred_is_call) as fn,
    count(*) filter (not gt_is_call and not pred_is_call) as tn,
    count(*) filter (correct_name) as correct_name,
    count(*) filter (exact_args) as exact_args
  from scored group by model),
rates as (
  select *, tp / cast(tp + fp as double) as precision, tp / cast(tp + fn as double) as recall,
    (tp + tn) / cast(n as double) as accuracy from board),
full_board as (
  select *, 2 * precision * recall / (precision + recall) as f1 from rates)
"""


@query(
    "scoreboard",
    twins.SCORED_SQL.rstrip()
    + _BOARD_SQL
    + """select model, n, tp, fp, fn, tn, correct_name, exact_args, round(precision, 6) as precision,
  round(recall, 6) as recall, round(f1, 6) as f1, round(accuracy, 6) as accuracy
from full_board""",
)
def scoreboard(spark, sf):
    board = scoring.scoreboard(scored(spark, sf))
    return _rounded(board, "precision", "recall", "f1", "accuracy")


@query(
    "call_vs_clarify",
    twins.SCORED_SQL.rstrip()
    + _BOARD_SQL
    + """select model, n, tp, fp, fn, tn, round(precision, 6) as precision,
  round(recall, 6) as recall, round(f1, 6) as f1, round(accuracy, 6) as accuracy
from full_board""",
)
def call_vs_clarify(spark, sf):
    return _rounded(
        scoring.call_vs_clarify(scored(spark, sf)), "precision", "recall", "f1", "accuracy"
    )


@query(
    "leaderboard",
    twins.SCORED_SQL.rstrip()
    + _BOARD_SQL
    + """select model, round(f1, 6) as score, rank() over (order by f1 desc) as place,
  round(f1 - (select f1 from full_board where model = 'base'), 6) as over_baseline,
  f1 > (select f1 from full_board where model = 'base') as beats_baseline,
  round((f1 - (select f1 from full_board where model = 'base'))
    / ((select f1 from full_board where model = 'teacher')
       - (select f1 from full_board where model = 'base')), 6) + 0e0 as gap_closed
from full_board""",
)
def leaderboard(spark, sf):
    metrics = scoring.call_vs_clarify(scored(spark, sf))
    board = scoring.leaderboard(metrics, "f1", baseline="base", ceiling="teacher")
    return _rounded(board, "score", "over_baseline", "gap_closed")


@query(
    "score_calls_v1",
    twins.SCORED_SQL
    + """, lenient as (
  select model, any_json, any_json and pred_name = gt_name and pred_args like '{%' as ok,
         any_json and pred_name = gt_name and pred_args like '{%' and pred_args = gt_args as same
  from scored where gt_is_call)
select model, count(*) as n, count(*) filter (any_json) as valid_json,
  count(*) filter (ok) as correct_call, count(*) filter (same) as exact_match,
  round(count(*) filter (any_json) / cast(count(*) as double), 6) as valid_json_rate,
  round(count(*) filter (ok) / cast(count(*) as double), 6) as correct_call_rate,
  round(count(*) filter (same) / cast(count(*) as double), 6) as exact_match_rate
from lenient group by model""",
)
def score_calls_v1(spark, sf):
    return _rounded(
        scoring.score_calls_v1(scored(spark, sf)),
        "valid_json_rate",
        "correct_call_rate",
        "exact_match_rate",
    )


@query(
    "score_calls_v2",
    twins.SCORED_SQL
    + """select model, count(*) as n, count(*) filter (pred_is_call) as valid_json,
  count(*) filter (correct_name) as correct_name, count(*) filter (exact_args) as exact_args,
  round(100e0 * count(*) filter (pred_is_call) / count(*), 1) as valid_json_pct,
  round(100e0 * count(*) filter (correct_name) / count(*), 1) as correct_name_pct,
  round(100e0 * count(*) filter (exact_args) / count(*), 1) as exact_args_pct
from scored where gt_is_call group by model""",
)
def score_calls_v2(spark, sf):
    return scoring.score_calls_v2(scored(spark, sf))


@query(
    "completion_quality",
    twins.PAIRED_SQL
    + """select model, count(*) as n, count(*) filter (any_json) as valid_json,
  count(*) filter (has_name and pred_args like '{%') as correct_call_shape,
  round(100e0 * count(*) filter (any_json) / count(*), 1) as valid_json_pct,
  round(100e0 * count(*) filter (has_name and pred_args like '{%') / count(*), 1)
    as correct_call_shape_pct
from paired group by model""",
)
def completion_quality(spark, sf):
    return quality.completion_quality(filters.call_shape(paired(spark, sf)), "model")


@query(
    "quality_by_expectation",
    twins.PAIRED_SQL
    + """select model, expects_call, count(*) as n,
  count(*) filter (case when expects_call then has_name else any_json end) as n_json,
  round(100e0 * count(*) filter (case when expects_call then has_name else any_json end)
    / count(*), 1) as json_pct,
  case when expects_call then 'valid_call' else 'over_trigger' end as measure
from paired group by model, expects_call""",
)
def quality_by_expectation(spark, sf):
    return quality.quality_by_expectation(filters.call_shape(paired(spark, sf)), "model")


@query(
    "filter_report",
    twins.PAIRED_SQL
    + """, labelled as (
  select case when expected_behavior is not null then 'kept' else 'dropped' end as o,
         coalesce(expected_behavior, drop_reason) as d from classified)
select coalesce(o, 'total') as outcome, coalesce(d, 'all') as detail, count(*) as n
from labelled group by rollup (o, d)""",
)
def filter_report(spark, sf):
    return quality.filter_report(filters.classify_completions(paired(spark, sf)))


@query(
    "keep_completions",
    twins.PAIRED_SQL
    + """select example_id, model, expected_behavior from classified
where expected_behavior is not null""",
)
def keep_completions(spark, sf):
    return filters.keep_completions(paired(spark, sf)).select(
        "example_id", "model", "expected_behavior"
    )


@query(
    "extract_json",
    twins.CALLS_SQL + "select example_id, model, any_json, pred_name, pred_args from calls",
)
def extract_json(spark, sf):
    shaped = filters.call_shape(predictions(spark, sf))
    return shaped.select(
        "example_id",
        "model",
        "any_json",
        F.col("call.name").alias("pred_name"),
        F.col("call.arguments").alias("pred_args"),
    )


@query(
    "call_shape",
    twins.CALLS_SQL
    + """select example_id, model, any_json, coalesce(has_name, false) as has_name,
  coalesce(has_name and pred_args like '{%', false) as name_and_args from calls""",
)
def call_shape(spark, sf):
    return filters.call_shape(predictions(spark, sf)).select(
        "example_id", "model", "any_json", "has_name", "name_and_args"
    )


@query(
    "class_balance",
    twins.with_ctes(twins.EXAMPLES, twins.PREDICTIONS, twins.PARSED, twins.PAIRED, """
usable as (select distinct example_id from classified)""", twins.SPLIT)
    + """, counts as (
  select model, split, case when expects_call then 'function_call' else 'clarify_or_decline' end
      as behaviour, count(*) as n_all,
    count(*) filter (expected_behavior is not null) as n_kept
  from split join classified using (example_id) group by all),
shares as (
  select *, round(100e0 * n_all / sum(n_all) over (partition by model, split), 1) as share_all_pct,
    round(100e0 * n_kept / sum(n_kept) over (partition by model, split), 1) as share_kept_pct
  from counts)
select *, round(share_kept_pct - share_all_pct, 1) as shift_pct from shares""",
)
def class_balance(spark, sf):
    """Each model's filter, and how it shifts the classes of both splits."""
    rows = filters.classify_completions(paired(spark, sf))
    labelled = rows.select(
        "example_id",
        "model",
        F.col("expected_behavior").isNotNull().alias("kept"),
        F.when(F.col("expects_call"), "function_call")
        .otherwise("clarify_or_decline")
        .alias("behaviour"),
    )
    # The base rows are split, not the join, whose histograms would each run it again.
    split = exact_split(_human(spark, sf).select("example_id"), "example_id")
    return quality.class_balance(
        labelled.join(split, "example_id"), "split", "kept", "behaviour", "model"
    )


@query(
    "pair_completions",
    twins.PAIRED_SQL + "select example_id, expects_call, completion from paired where model = 'sft'",
)
def pair_completions(spark, sf):
    expected = _human(spark, sf).select("example_id", filters.expects_call().alias("expects_call"))
    sft = predictions(spark, sf).filter(F.col("model") == "sft").drop("model")
    return pairing.pair_completions(expected, sft)


@query(
    "pairing_gaps",
    twins.with_ctes(twins.EXAMPLES, twins.PREDICTIONS, """
a as (select example_id from examples
  where coalesce(tools, '') not in ('', '[]') and first_from = 'human'),
b as (select example_id from predictions where model = 'sft')""")
    + """select (select count(*) from a anti join b using (example_id)) as n_without_completion,
  (select count(*) from b anti join a using (example_id)) as n_without_example,
  (select count(*) from a semi join b using (example_id)) as n_paired""",
)
def pairing_gaps(spark, sf):
    sft = predictions(spark, sf).filter(F.col("model") == "sft")
    return pairing.pairing_gaps(_human(spark, sf), sft)


@query(
    "select_kept",
    twins.PAIRED_SQL
    + """select e.example_id, e.user_turn from examples e
where e.example_id in (select example_id from classified
                       where model = 'distilled' and expected_behavior is not null)""",
)
def select_kept(spark, sf):
    kept = filters.keep_completions(paired(spark, sf).filter(F.col("model") == "distilled"))
    return pairing.select_kept(chat_corpus(spark, sf), kept).select(
        "example_id", turn(0, "value").alias("user_turn")
    )


@query(
    "score_inputs",
    twins.SCORED_SQL
    + "select example_id, model, user_turn, gt_is_call, gt_name, gt_args, completion from scored",
)
def score_inputs(spark, sf):
    return pairing.score_inputs(scoring_examples(_human(spark, sf)), predictions(spark, sf)).select(
        "example_id", "model", "user_turn", "gt_is_call", "gt_name", "gt_args", "completion"
    )


@query(
    "missing_predictions",
    twins.with_ctes(twins.EXAMPLES, twins.PREDICTIONS, """
answered as (
  select * from predictions where completion <> 'Could you tell me more?')""")
    + """select e.example_id, m.model from examples e join models m on true
anti join answered a on a.example_id = e.example_id and a.model = m.model""",
)
def missing_predictions(spark, sf):
    answered = predictions(spark, sf).filter(F.col("completion") != "Could you tell me more?")
    return pairing.missing_predictions(chat_corpus(spark, sf), answered, MODELS)


@query(
    "side_by_side",
    twins.with_ctes(twins.EXAMPLES, twins.PREDICTIONS)
    + """select a.example_id, a.completion as output_a, b.completion as output_b
from predictions a join predictions b on a.example_id = b.example_id
where a.model = 'base' and b.model = 'sft'""",
)
def side_by_side(spark, sf):
    return pairing.side_by_side(predictions(spark, sf), "base", "sft")


@query("collect_misses", twins.SCORED_SQL + "select * from misses")
def collect_misses(spark, sf):
    return _misses(spark, sf)


@query(
    "miss_class",
    twins.SCORED_SQL
    + """, keyed as (
  select *, unnest(list_distinct(
    coalesce(json_keys(gt_args), []) || coalesce(json_keys(pred_args), []))) as key from misses),
vals as (
  select *, cast(json_extract(gt_args, '$.' || key) as varchar) as gt_value,
    cast(json_extract(pred_args, '$.' || key) as varchar) as pred_value from keyed),
named as (
  select model, example_id, key, gt_value, pred_value,
    case when pred_name is null then 'no_call' when not name_matched then 'other_call'
      when gt_value is not distinct from pred_value then 'equal'
      when pred_value is null then 'left_out' when gt_value is null then 'added'
      else 'changed' end as miss_class
  from vals)
select * from named where miss_class <> 'equal'""",
)
def miss_class(spark, sf):
    return misses.miss_class(_misses(spark, sf))


_OVERLAP_SQL = """
a as (select * from misses where model = 'distilled'),
b as (select * from misses where model = 'sft')
"""


@query(
    "miss_overlap",
    twins.SCORED_SQL.rstrip() + "," + _OVERLAP_SQL
    + """select (select count(*) from a) as n_a, (select count(*) from b) as n_b,
  (select count(*) from a semi join b using (example_id)) as n_shared,
  (select count(*) from a anti join b using (example_id)) as n_only_a,
  (select count(*) from b anti join a using (example_id)) as n_only_b""",
)
def miss_overlap(spark, sf):
    return misses.miss_overlap(_misses(spark, sf), "distilled", "sft")


@query(
    "unique_misses",
    twins.SCORED_SQL.rstrip() + "," + _OVERLAP_SQL
    + "select * from a anti join b using (example_id)",
)
def unique_misses(spark, sf):
    return misses.unique_misses(_misses(spark, sf), "distilled", "sft")


@query(
    "identical_wrong",
    twins.SCORED_SQL.rstrip() + "," + _OVERLAP_SQL
    + """select a.example_id, a.pred_name, a.pred_args from a join b using (example_id)
where a.pred_name is not distinct from b.pred_name
  and a.pred_args is not distinct from b.pred_args""",
)
def identical_wrong(spark, sf):
    return misses.identical_wrong(_misses(spark, sf), "distilled", "sft")


@query(
    "fp_overlap",
    twins.SCORED_SQL
    + """, fps as (select model, example_id from scored where not gt_is_call and pred_is_call),
mine as (select example_id from fps where model = 'distilled'),
per_reference as (
  select r.model as reference, (select count(*) from mine) as n_fp, count(*) as n_reference,
    count(*) filter (r.example_id in (select example_id from mine)) as n_both
  from fps r where r.model in ('teacher', 'sft') group by r.model)
select reference, n_fp, n_reference, n_both, n_fp - n_both as n_only_model,
  round(100e0 * n_both / greatest(1, n_fp), 1) as overlap_pct,
  round(100e0 * (n_fp - n_both) / greatest(1, n_fp), 1) as unique_pct
from per_reference""",
)
def fp_overlap(spark, sf):
    return misses.fp_overlap(scored(spark, sf), "distilled", ["teacher", "sft"])


@query(
    "index_set_ops",
    twins.SCORED_SQL.rstrip() + "," + _OVERLAP_SQL
    + """select example_id, 'both' as side from (
  select example_id from a intersect select example_id from b)
union all
select example_id, 'only_a' as side from (
  select example_id from a except select example_id from b)""",
)
def index_set_ops(spark, sf):
    missed = _misses(spark, sf)
    return misses.index_set_ops(
        missed.filter(F.col("model") == "distilled"), missed.filter(F.col("model") == "sft")
    )


@query(
    "multi_model_overlap",
    twins.SCORED_SQL
    + """, sets as (
  select example_id, array_to_string(list_sort(list(distinct model)), '+') as models
  from misses group by example_id)
select models, count(*) as n_examples from sets group by models""",
)
def multi_model_overlap(spark, sf):
    return misses.multi_model_overlap(_misses(spark, sf))


@query(
    "sorted_misses",
    twins.SCORED_SQL
    + """select example_id, user_turn, pred_name from misses where model = 'sft'
order by example_id""",
)
def listed_misses(spark, sf):
    sft = _misses(spark, sf).filter(F.col("model") == "sft")
    return sorted_rows(sft.select("example_id", "user_turn", "pred_name"), "example_id")
