"""Distillation losses over rows of (position, logits, label).

Tables hold ``teacher`` and ``student`` logits as arrays and the hard
``label`` of the position. Losses are computed row by row and averaged over
positions whose label is not ignored; the mean of no position is null.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distaff.constants import IGNORE_LABEL, SWEEP_ALPHAS, SWEEP_TEMPERATURES, TOP_K
from distaff.functions.distributions import (
    bind,
    jensen_shannon,
    log_softmax,
    top_entries,
)


def causal_shift(df: DataFrame, logits: list[str], labels: str = "labels") -> DataFrame:
    """Per-sequence arrays: drop the last logits and the first label."""
    for c in logits:
        df = df.withColumn(c, F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))))
    return df.withColumn(
        labels, F.slice(labels, F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0)))
    )


def causal_shift_long(
    df: DataFrame, seq: str = "seq", pos: str = "pos", label: str = "label"
) -> DataFrame:
    """Per-position rows: each position is judged by the next one's label.

    The window spans one sequence, whose length the model bounds.
    """
    after = Window.partitionBy(seq).orderBy(pos)
    return (
        df.withColumn("_next", F.lead(label).over(after))
        .filter("_next IS NOT NULL")
        .withColumn(label, F.col("_next"))
        .drop("_next")
    )


def truncate_vocab(df: DataFrame, width: int, *columns: str) -> DataFrame:
    """Cut logits to the vocabulary both models share."""
    return df.withColumns({c: F.slice(F.col(c), 1, width) for c in columns})


def or_fail(value: Column, problem: str) -> Column:
    """``value``, or a failing query where it is null: a mean would leave it out."""
    return F.coalesce(value, F.raise_error(F.lit(problem)).cast("double"))


def divergence(temperature: float, beta: float = 0.0) -> Column:
    """Per-position divergence of student from teacher.

    Missing distributions and unequal widths fail the query; ``truncate_vocab``
    is the way to compare models with padded heads.
    """
    value = bind(
        log_softmax(F.col("teacher"), temperature),
        lambda t: bind(
            log_softmax(F.col("student"), temperature), lambda s: jensen_shannon(t, s, beta)
        ),
    )
    same = F.size("teacher") == F.size("student")
    return or_fail(F.when(same, value), "teacher and student differ in width")


def counted() -> Column:
    """Positions that count; a missing label does, and fails where it is used."""
    return F.coalesce(F.col("label") != IGNORE_LABEL, F.lit(True))


def masked_mean(value: Column) -> Column:
    return F.avg(F.when(counted(), value))


def label_nll() -> Column:
    """Per-position −ln q(label); null on ignored positions.

    A label outside the student's width fails the query.
    """
    value = bind(log_softmax(F.col("student")), lambda q: -F.get(q, F.col("label")))
    return F.when(counted(), or_fail(value, "label outside the student's vocabulary"))


def kl_forward(df: DataFrame, temperature: float, *by: str) -> DataFrame:
    """Masked mean of KL(teacher‖student), times T²."""
    return (
        df.filter(counted())
        .groupBy(*by)
        .agg((F.avg(divergence(temperature)) * F.lit(temperature**2)).alias("kl"))
    )


def cross_entropy(df: DataFrame, *by: str) -> DataFrame:
    """Masked mean of −ln q(label) at temperature 1."""
    return df.filter(counted()).groupBy(*by).agg(F.avg(label_nll()).alias("ce"))


def kd_loss(
    df: DataFrame, temperature: float = 2.0, alpha_soft: float = 0.5, *by: str
) -> DataFrame:
    """α·KD + (1−α)·CE with both parts; α weights the soft part."""
    parts = (
        df.filter(counted())
        .groupBy(*by)
        .agg(
            (F.avg(divergence(temperature)) * F.lit(temperature**2)).alias("kd"),
            F.avg(label_nll()).alias("ce"),
        )
    )
    return parts.withColumn(
        "loss", F.col("kd") * F.lit(alpha_soft) + F.col("ce") * F.lit(1.0 - alpha_soft)
    )


def generalized_jsd(df: DataFrame, beta: float, temperature: float = 1.0, *by: str) -> DataFrame:
    """Masked mean of the generalised Jensen–Shannon divergence."""
    return (
        df.filter(counted()).groupBy(*by).agg(F.avg(divergence(temperature, beta)).alias("jsd"))
    )


def sweep_grid(
    df: DataFrame, temperatures=SWEEP_TEMPERATURES, alphas=SWEEP_ALPHAS
) -> DataFrame:
    """Loss at every (T, α), from one pass over the positions.

    The soft part depends on T only, so each T is one aggregate; the grid is
    laid out on the single result row.
    """
    soft = [
        (F.avg(divergence(t)) * F.lit(t**2)).alias(f"kd_{i}") for i, t in enumerate(temperatures)
    ]
    parts = df.filter(counted()).agg(F.avg(label_nll()).alias("ce"), *soft)
    points = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("temperature"),
                F.lit(float(a)).alias("alpha_soft"),
                F.col(f"kd_{i}").alias("kd"),
                (F.col(f"kd_{i}") * F.lit(a) + F.col("ce") * F.lit(1.0 - a)).alias("loss"),
            )
            for i, t in enumerate(temperatures)
            for a in alphas
        ]
    )
    return parts.select("ce", F.inline(points))


def topk_logprobs(df: DataFrame, logits: str, k: int = TOP_K, name: str = "top") -> DataFrame:
    """The k largest log-probabilities with token ids, ties to the lower id."""
    return df.withColumn(name, top_entries(log_softmax(F.col(logits)), k))


def topk_logprobs_wide(
    df: DataFrame, logits: str, k: int = TOP_K, name: str = "top"
) -> DataFrame:
    """``topk_logprobs`` for vocabularies of 10⁵ entries.

    Spark has no partial selection on arrays and would sort each whole row;
    numpy selects in Arrow batches instead.
    """

    @F.pandas_udf("array<struct<token_id:int,logprob:double>>")
    def selected(rows: pd.Series) -> pd.Series:
        out = []
        for row in rows:
            x = np.asarray(row, dtype=np.float64)
            x = x - x.max()
            x = x - np.log(np.exp(x).sum())
            width = min(k, len(x))
            floor = np.partition(x, len(x) - width)[len(x) - width]
            candidates = np.flatnonzero(x >= floor)
            order = candidates[np.lexsort((candidates, -x[candidates]))][:width]
            out.append([{"token_id": int(i), "logprob": float(x[i])} for i in order])
        return pd.Series(out)

    return df.withColumn(name, selected(F.col(logits)))


def topk_long(df: DataFrame, k: int = TOP_K, *position: str) -> DataFrame:
    """Top k of (position…, token_id, logprob) rows.

    The rank limit also runs before the shuffle, so a position's whole
    vocabulary never meets in one task.
    """
    best = Window.partitionBy(*position).orderBy(F.desc("logprob"), "token_id")
    return df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def sparse_kl_value(top: Column, student_logprobs: Column) -> Column:
    """Σ p (ln p − ln q) over the stored entries; missing mass counts as 0.

    A stored id outside the student's width, or a missing side, fails the query.
    """
    value = F.aggregate(
        top,
        F.lit(0.0),
        lambda acc, e: acc
        + F.exp(e["logprob"]) * (e["logprob"] - F.get(student_logprobs, e["token_id"])),
    )
    return or_fail(value, "stored entry outside the student's vocabulary")


def sparse_kl(teacher: DataFrame, student: DataFrame, *position: str) -> DataFrame:
    """Masked mean of the divergence from stored top-k teacher rows.

    ``teacher`` has ``top`` and ``label``, ``student`` full logits; both are
    joined on their position and compared inside the row. A position the
    student lacks fails the query.
    """
    return sparse_kl_mean(teacher.filter(counted()).join(student, list(position), "left"))


def sparse_kl_mean(df: DataFrame) -> DataFrame:
    """``sparse_kl`` where ``top`` and ``student`` already share a row."""
    value = bind(log_softmax(F.col("student")), lambda q: sparse_kl_value(F.col("top"), q))
    return df.filter(counted()).agg(F.avg(value).alias("sparse_kl"))


def composite_loss(df: DataFrame, weights: dict[str, float], name: str = "loss") -> DataFrame:
    """Weighted sum of loss columns."""
    weighted = sum((F.col(c) * F.lit(w) for c, w in weights.items()), F.lit(0.0))
    return df.withColumn(name, weighted)
