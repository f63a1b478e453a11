"""Completion checks, filter reports, class balance and length statistics."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distaff.functions.text import percent

PERCENTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def completion_quality(shaped: DataFrame, *by: str) -> DataFrame:
    """Share of completions that are JSON, and that have the call shape."""
    n = F.col("n")
    return (
        shaped.groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            F.count_if("any_json").alias("valid_json"),
            F.count_if("name_and_args").alias("correct_call_shape"),
        )
        .select(
            "*",
            percent(F.col("valid_json"), n).alias("valid_json_pct"),
            percent(F.col("correct_call_shape"), n).alias("correct_call_shape_pct"),
        )
    )


def quality_by_expectation(shaped: DataFrame, *by: str) -> DataFrame:
    """Valid calls where one is due, JSON anyway where none is."""
    hit = F.when(F.col("expects_call"), F.col("has_name")).otherwise(F.col("any_json"))
    return (
        shaped.groupBy(*by, "expects_call")
        .agg(F.count("*").alias("n"), F.count_if(hit).alias("n_json"))
        .withColumn("json_pct", percent(F.col("n_json"), F.col("n")))
        .withColumn(
            "measure", F.when(F.col("expects_call"), "valid_call").otherwise("over_trigger")
        )
    )


def filter_report(classified: DataFrame) -> DataFrame:
    """Rows kept and dropped, by behaviour or reason, with totals.

    ``outcome`` is kept, dropped or total; ``detail`` is ``all`` on totals.
    """
    labelled = classified.select(
        F.when(F.col("expected_behavior").isNotNull(), "kept").otherwise("dropped").alias("_o"),
        F.coalesce("expected_behavior", "drop_reason").alias("_d"),
    )
    return (
        labelled.rollup("_o", "_d")
        .agg(F.count("*").alias("n"))
        .select(
            F.coalesce("_o", F.lit("total")).alias("outcome"),
            F.coalesce("_d", F.lit("all")).alias("detail"),
            "n",
        )
    )


def class_balance(df: DataFrame, split: str, kept: str, behaviour: str, *by: str) -> DataFrame:
    """Class counts per split (and ``by``) before and after a filter, with the shift.

    ``kept`` is a boolean column; counts of all rows and of kept rows come
    from one grouped pass, shares from the small result.
    """
    within = Window.partitionBy(*by, split)
    counts = df.groupBy(*by, split, behaviour).agg(
        F.count("*").alias("n_all"), F.count_if(kept).alias("n_kept")
    )
    return counts.select(
        *by,
        split,
        behaviour,
        "n_all",
        "n_kept",
        percent(F.col("n_all"), F.sum("n_all").over(within)).alias("share_all_pct"),
        percent(F.col("n_kept"), F.sum("n_kept").over(within)).alias("share_kept_pct"),
    ).withColumn("shift_pct", F.round(F.col("share_kept_pct") - F.col("share_all_pct"), 1))


def length_stats(df: DataFrame, length: Column, *by: str) -> DataFrame:
    """Count, extremes, mean and percentiles of a length.

    A percentile is the sorted value at index ``min(int(n * p), n - 1)``,
    found on the histogram of lengths: the first length whose running count
    exceeds that index. Base rows are only counted, never sorted.
    """
    histogram = df.groupBy(*by, length.alias("_length")).agg(F.count("*").alias("_rows"))
    return _histogram_stats(histogram, *by)


def length_stats_with_total(df: DataFrame, length: Column, by: str, total: str) -> DataFrame:
    """``length_stats`` by one column and, under the name ``total``, of all rows.

    The rows are read and measured once; the totals come from the histogram.
    """
    histogram = df.groupBy(by, length.alias("_length")).agg(F.count("*").alias("_rows"))
    both = histogram.withColumn(by, F.explode(F.array(F.col(by), F.lit(total))))
    return _histogram_stats(both.groupBy(by, "_length").agg(F.sum("_rows").alias("_rows")), by)


def _histogram_stats(histogram: DataFrame, *by: str) -> DataFrame:
    group = Window.partitionBy(*by)
    running = histogram.withColumn(
        "_upto", F.sum("_rows").over(group.orderBy("_length"))
    ).withColumn("_n", F.sum("_rows").over(group))

    def at(p):
        index = F.least(F.floor(F.col("_n") * F.lit(p)), F.col("_n") - 1)
        return F.min(F.when(F.col("_upto") > index, F.col("_length")))

    return running.groupBy(*by).agg(
        F.sum("_rows").alias("n"),
        F.min("_length").alias("min"),
        F.max("_length").alias("max"),
        (F.sum(F.col("_rows") * F.col("_length")) / F.sum("_rows")).alias("mean"),
        *[at(p).alias(name) for name, p in PERCENTILES.items()],
    )


def generation_budget(df: DataFrame, length: Column, margin: float, step: int) -> DataFrame:
    """Longest length plus a margin, rounded up, and what a cap would cut."""
    return df.agg(
        F.max(length).alias("longest"),
        (F.ceil(F.max(length) * F.lit(1 + margin) / step) * step).alias("max_new_tokens"),
    )


def share_over_cap(df: DataFrame, length: Column, cap: int) -> DataFrame:
    """Rows longer than ``cap``."""
    return df.agg(
        F.count("*").alias("n"), F.count_if(length > cap).alias("n_over")
    ).withColumn("over_pct", percent(F.col("n_over"), F.col("n")))


def steps_plan(df: DataFrame, batch: int, accumulate: int) -> DataFrame:
    """Full optimiser steps of one pass, and rows left for a last short one."""
    per_step = batch * accumulate
    n = F.count("*")
    return df.agg(
        n.alias("n_examples"),
        F.floor(n / per_step).alias("full_steps"),
        (n % per_step).alias("rows_left"),
    )
