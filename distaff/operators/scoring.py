"""Row-level scores and the metrics built on them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distaff.functions.jsoncall import with_call_fields
from distaff.functions.text import percent, share


def score_rows(paired: DataFrame, text: str = "completion", exact: bool = False) -> DataFrame:
    """Score each prediction beside its example once, for every metric.

    Lenient flags (``*_v1``) accept any JSON as valid and need an arguments
    object; strict flags need the name key, and read a missing ``arguments``
    as an empty object on both sides.
    """
    return (
        with_call_fields(paired, text, exact=exact)
        .selectExpr(
            "*",
            "call.any_json AS any_json",
            "call.has_name AS pred_is_call",
            # dict.get: an absent key and a JSON null are the same.
            """call.any_json AND call.arguments_is_object
               AND nullif(call.name, 'null') <=> nullif(gt_name, 'null') AS correct_call_v1""",
            "coalesce(call.has_name AND call.name = gt_name, false) AS correct_name",
        )
        .selectExpr(
            "*",
            """correct_call_v1 AND nullif(call.arguments, 'null') <=> nullif(gt_args, 'null')
               AS exact_match_v1""",
            """correct_name AND coalesce(call.arguments, '{}') = coalesce(gt_args, '{}')
               AS exact_args""",
        )
    )


def has_call_truth() -> Column:
    """Rows the argument metrics are defined on."""
    return F.col("gt_name").isNotNull()


def score_calls_v1(scored: DataFrame) -> DataFrame:
    """Any JSON / right name with arguments / equal arguments, by model."""
    n = F.col("n")
    return (
        scored.filter(has_call_truth())
        .groupBy("model")
        .agg(
            F.count("*").alias("n"),
            F.count_if("any_json").alias("valid_json"),
            F.count_if("correct_call_v1").alias("correct_call"),
            F.count_if("exact_match_v1").alias("exact_match"),
        )
        .select(
            "*",
            share(F.col("valid_json"), n).alias("valid_json_rate"),
            share(F.col("correct_call"), n).alias("correct_call_rate"),
            share(F.col("exact_match"), n).alias("exact_match_rate"),
        )
    )


def score_calls_v2(scored: DataFrame) -> DataFrame:
    """Named JSON ⊇ right name ⊇ equal arguments, by model."""
    n = F.col("n")
    return (
        scored.filter(has_call_truth())
        .groupBy("model")
        .agg(
            F.count("*").alias("n"),
            F.count_if("pred_is_call").alias("valid_json"),
            F.count_if("correct_name").alias("correct_name"),
            F.count_if("exact_args").alias("exact_args"),
        )
        .select(
            "*",
            percent(F.col("valid_json"), n).alias("valid_json_pct"),
            percent(F.col("correct_name"), n).alias("correct_name_pct"),
            percent(F.col("exact_args"), n).alias("exact_args_pct"),
        )
    )


def confusion_counts() -> list[Column]:
    return [
        F.expr("count_if(gt_is_call AND pred_is_call) AS tp"),
        F.expr("count_if(NOT gt_is_call AND pred_is_call) AS fp"),
        F.expr("count_if(gt_is_call AND NOT pred_is_call) AS fn"),
        F.expr("count_if(NOT gt_is_call AND NOT pred_is_call) AS tn"),
    ]


def confusion_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 (0 on a zero denominator) and accuracy."""
    return counts.selectExpr(
        "*",
        "coalesce(try_divide(double(tp), tp + fp), 0d) AS precision",
        "coalesce(try_divide(double(tp), tp + fn), 0d) AS recall",
    ).selectExpr(
        "*",
        "coalesce(try_divide(2d * precision * recall, precision + recall), 0d) AS f1",
        "try_divide(double(tp + tn), tp + fp + fn + tn) AS accuracy",
    )


def call_vs_clarify(scored: DataFrame) -> DataFrame:
    """Does the model call exactly where a call is due, by model."""
    return confusion_rates(
        scored.groupBy("model").agg(F.count("*").alias("n"), *confusion_counts())
    )


def scoreboard(scored: DataFrame) -> DataFrame:
    """Decision and argument metrics of every model in one pass."""
    return confusion_rates(
        scored.groupBy("model").agg(
            F.count("*").alias("n"),
            *confusion_counts(),
            F.count_if(has_call_truth() & F.col("correct_name")).alias("correct_name"),
            F.count_if(has_call_truth() & F.col("exact_args")).alias("exact_args"),
        )
    )


def leaderboard(
    metrics: DataFrame, metric: str, baseline: str, ceiling: str
) -> DataFrame:
    """Rank models and place them between a baseline and a ceiling model.

    The windows run over the one-row-per-model table.
    """
    everyone = Window.partitionBy()
    value = F.col(metric)
    of = lambda m: F.max(F.when(F.col("model") == m, value)).over(everyone)
    return metrics.select(
        "model",
        value.alias("score"),
        F.rank().over(Window.orderBy(value.desc())).alias("place"),
        (value - of(baseline)).alias("over_baseline"),
        (value > of(baseline)).alias("beats_baseline"),
        F.try_divide(value - of(baseline), of(ceiling) - of(baseline)).alias("gap_closed"),
    )
