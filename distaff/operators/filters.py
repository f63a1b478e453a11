"""Row predicates, the agreement filter and skip counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distaff.constants import CLARIFY_OR_DECLINE, FUNCTION_CALL
from distaff.functions.jsoncall import with_call_fields
from distaff.operators.ordering import head_slice
from distaff.operators.prompts import turn


def with_tools(df: DataFrame) -> DataFrame:
    """Rows with a tool list: not null, not empty, not ``[]``."""
    return df.filter(~F.coalesce(F.col("tools"), F.lit("")).isin("", "[]"))


def expects_call() -> Column:
    """True where the second turn is a function call."""
    return F.coalesce(turn(1, "from") == "function_call", F.lit(False))


def call_shape(df: DataFrame, text: str = "completion", exact: bool = False) -> DataFrame:
    """Add ``call`` (parsed fields) and three ever stricter shape flags."""
    call = F.col("call")
    return with_call_fields(df, text, exact=exact).withColumns(
        {
            "any_json": call["any_json"],
            "has_name": call["has_name"],
            "name_and_args": call["has_name"] & call["arguments_is_object"],
        }
    )


def agreement(expected: Column, any_json: Column, has_name: Column) -> tuple[Column, Column]:
    """(expected_behavior, drop_reason) of a completion; one of them is null.

    Where a call is expected the completion must be a named call; where none
    is expected it must hold no JSON at all.
    """
    kept = F.when(expected & has_name, FUNCTION_CALL).when(
        ~expected & ~any_json, CLARIFY_OR_DECLINE
    )
    dropped = F.when(expected & ~has_name, "failed_call").when(
        ~expected & any_json, "hallucinated_call"
    )
    return kept, dropped


def classify_completions(df: DataFrame, text: str = "completion") -> DataFrame:
    """Add ``expected_behavior`` and ``drop_reason`` to paired rows."""
    shaped = call_shape(df, text)
    kept, dropped = agreement(F.col("expects_call"), F.col("any_json"), F.col("has_name"))
    return shaped.withColumns({"expected_behavior": kept, "drop_reason": dropped})


def keep_completions(df: DataFrame, text: str = "completion") -> DataFrame:
    """Completions that agree with the ground truth."""
    return classify_completions(df, text).filter("expected_behavior IS NOT NULL")


def with_skip_counts(df: DataFrame, reason: Column) -> DataFrame:
    """Rows built (null reason) and skipped, by reason."""
    return df.groupBy(F.coalesce(reason, F.lit("built")).alias("outcome")).agg(
        F.count("*").alias("n")
    )


def preview(df: DataFrame, n: int, width: int, *order) -> DataFrame:
    """First ``n`` rows with every text column cut to ``width`` characters."""
    cut = [
        F.substring(F.col(name), 1, width).alias(name) if kind == "string" else F.col(name)
        for name, kind in df.dtypes
    ]
    return head_slice(df, n, *order).select(*cut)
