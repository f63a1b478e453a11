"""Evaluation examples from held-out conversations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distaff.functions.jsoncall import with_document_fields
from distaff.operators.filters import expects_call
from distaff.operators.ordering import head_slice
from distaff.operators.prompts import turn


def eval_examples(
    df: DataFrame, kind: str, cap: int | None = None, exact: bool = False
) -> DataFrame:
    """Examples to score models on.

    ``args``: rows whose reply is a parseable, named call, with ``gt_name``
    and ``gt_args`` as canonical JSON (``gt_args`` null if absent).
    ``decision``: all rows that start with a person and have a reply, with
    ``gt_is_call``. ``cap`` keeps the first rows in key order.
    """
    opened = df.filter((turn(0, "from") == "human") & (F.size("conversations") >= 2))
    base = ["example_id", "tools", turn(0, "value").alias("user_turn")]
    if kind == "decision":
        examples = opened.select(*base, expects_call().alias("gt_is_call"))
    elif kind == "args":
        calls = with_document_fields(
            opened.filter(expects_call()), turn(1, "value"), "gt", exact
        )
        examples = (
            calls.select(*base, "gt")
            .filter("gt.has_name")
            .select(
                "example_id",
                "tools",
                "user_turn",
                F.col("gt.name").alias("gt_name"),
                F.col("gt.arguments").alias("gt_args"),
            )
        )
    else:
        raise ValueError(f"unknown kind: {kind}")
    return examples if cap is None else head_slice(examples, cap, "example_id")


def with_truth_reason(df: DataFrame, exact: bool = False) -> DataFrame:
    """Add ``truth_reason``: why a row is no example of the argument metrics; null where it is."""
    call = F.when(expects_call(), turn(1, "value"))
    reason = (
        F.when(F.coalesce(turn(0, "from"), F.lit("")) != "human", "first_not_human")
        .when(F.size("conversations") < 2, "no_reply")
        .when(~expects_call(), "no_call_due")
        .when(~F.coalesce(F.col("gt.any_json"), F.lit(False)), "truth_not_json")
        .when(~F.col("gt.has_name"), "truth_without_name")
    )
    return with_document_fields(df, call, "gt", exact).withColumn("truth_reason", reason).drop("gt")


def scoring_examples(df: DataFrame, exact: bool = False) -> DataFrame:
    """Decision examples that also carry the call to compare with.

    One table serves the decision and the argument metrics: ``gt_name`` is
    null where the reply is not a parseable, named call. ``exact`` must be the
    same here as in ``score_rows``.
    """
    opened = df.filter((turn(0, "from") == "human") & (F.size("conversations") >= 2))
    call = F.when(expects_call(), turn(1, "value"))
    return with_document_fields(opened, call, "gt", exact).select(
        "example_id",
        "tools",
        turn(0, "value").alias("user_turn"),
        expects_call().alias("gt_is_call"),
        F.col("gt.name").alias("gt_name"),
        F.col("gt.arguments").alias("gt_args"),
    )
