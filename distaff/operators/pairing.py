"""Joins of examples with completions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_completions(split: DataFrame, completions: DataFrame, key: str = "example_id"):
    """Rows of both sides with the same key."""
    return split.join(completions, key)


def pairing_gaps(split: DataFrame, completions: DataFrame, key: str = "example_id") -> DataFrame:
    """Counts of keys on one side only; both must be 0 before pairing."""
    sides = split.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        completions.select(key, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    per_key = sides.groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return per_key.agg(
        F.count_if(F.expr("a > b")).alias("n_without_completion"),
        F.count_if(F.expr("b > a")).alias("n_without_example"),
        F.count_if(F.expr("a = b")).alias("n_paired"),
    )


def select_kept(df: DataFrame, kept: DataFrame, key: str = "example_id") -> DataFrame:
    """Rows whose key was kept."""
    return df.join(kept.select(key), key, "left_semi")


def score_inputs(
    examples: DataFrame, predictions: DataFrame, key: str = "example_id"
) -> DataFrame:
    """Every prediction with its example."""
    return examples.join(predictions, key)


def missing_predictions(
    examples: DataFrame, predictions: DataFrame, models: list[str], key: str = "example_id"
) -> DataFrame:
    """(example, model) pairs without a prediction.

    One grouped pass over predictions collects the few models of each
    example; no table of all pairs is built.
    """
    present = predictions.groupBy(key).agg(F.collect_set("model").alias("present"))
    wanted = F.array(*[F.lit(m) for m in models])
    held = F.coalesce(F.col("present"), F.array().cast("array<string>"))
    return (
        examples.select(key)
        .join(present, key, "left")
        .select(key, F.explode(F.array_except(wanted, held)).alias("model"))
    )


def side_by_side(
    predictions: DataFrame, a: str, b: str, key: str = "example_id", text: str = "completion"
) -> DataFrame:
    """Outputs of two models per example, one column each."""
    pick = lambda m: F.max(F.when(F.col("model") == m, F.col(text)))
    return (
        predictions.filter(F.col("model").isin(a, b))
        .groupBy(key)
        .agg(pick(a).alias("output_a"), pick(b).alias("output_b"))
    )
