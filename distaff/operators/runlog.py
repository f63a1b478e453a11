"""Audits of training run logs: rows of (run, step, ts, loss, lr)."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from distaff.constants import SAVE_EVERY_STEPS, SAVES_KEPT
from distaff.functions.schedules import SCHEDULES
from distaff.functions.text import is_finite_loss
from distaff.operators.ordering import previous_value

STEP_CHUNK = 1_000_000


def run_summary(log: DataFrame) -> DataFrame:
    """Final and mean loss, finiteness, runtime and first rate of each run."""
    finite = is_finite_loss(F.col("loss"))
    return log.groupBy("run").agg(
        F.count("*").alias("n_steps"),
        F.max("step").alias("last_step"),
        F.max_by("loss", "step").alias("final_loss"),
        F.avg(F.when(finite, F.col("loss"))).alias("mean_loss"),
        F.count_if(~finite).alias("n_not_finite"),
        (F.count_if(~finite) == 0).alias("all_finite"),
        (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))).alias("runtime_us"),
        F.min_by("lr", "step").alias("first_lr"),
    )


def lr_trajectory_audit(
    log: DataFrame, peak: float, total: int, warmups: list[int], schedule: str = "linear"
) -> DataFrame:
    """Largest distance of the logged rate from each candidate schedule.

    All candidates are checked in one pass; the best fit of a run is the
    smallest error, ties to the shorter warm-up.
    """
    rate = SCHEDULES[schedule]
    errors = [
        F.max(F.abs(F.col("lr") - rate(F.col("step"), peak, w, total))).alias(f"e_{w}")
        for w in warmups
    ]
    candidates = F.array(
        *[
            F.struct(F.lit(w).cast("bigint").alias("warmup"), F.col(f"e_{w}").alias("max_error"))
            for w in warmups
        ]
    )
    best = F.array_min(
        F.transform(candidates, lambda c: F.struct(c["max_error"], c["warmup"]))
    )["warmup"]
    return (
        log.groupBy("run")
        .agg(*errors)
        .select("run", best.alias("best_warmup"), F.inline(candidates))
        .withColumn("fits_best", F.col("warmup") == F.col("best_warmup"))
    )


def log_gaps(log: DataFrame, chunk: int = STEP_CHUNK) -> DataFrame:
    """Stretches of missing steps inside each run."""
    steps = previous_value(log.select("run", "step"), "run", "step", chunk)
    return steps.filter(F.col("step") - F.col("previous") > 1).select(
        "run",
        (F.col("previous") + 1).alias("missing_from"),
        (F.col("step") - 1).alias("missing_to"),
        (F.col("step") - F.col("previous") - 1).alias("n_missing"),
    )


def common_steps(log: DataFrame, a: str, b: str) -> DataFrame:
    """Steps two runs can be compared on, and the range of each."""
    of = lambda r: F.max(F.when(F.col("run") == r, 1))
    per_step = (
        log.filter(F.col("run").isin(a, b))
        .groupBy("step")
        .agg(of(a).isNotNull().alias("in_a"), of(b).isNotNull().alias("in_b"))
    )
    both = F.col("in_a") & F.col("in_b")
    return per_step.agg(
        F.count_if("in_a").alias("n_a"),
        F.count_if("in_b").alias("n_b"),
        F.count_if(both).alias("n_common"),
        F.min(F.when(both, F.col("step"))).alias("first_common"),
        F.max(F.when(both, F.col("step"))).alias("last_common"),
    )


def checkpoint_plan(
    log: DataFrame, every: int = SAVE_EVERY_STEPS, keep: int = SAVES_KEPT
) -> DataFrame:
    """Checkpoints a run saved, and which of them a limited keeper retains.

    Periodic steps and each run's last step are put together without a join,
    and the newest ``keep`` found by a rank limit that also runs before the
    shuffle.
    """
    periodic = log.filter(F.col("step") % every == 0).select("run", "step")
    last = log.groupBy("run").agg(F.max("step").alias("step"))
    saved = periodic.unionAll(last).distinct()
    newest = Window.partitionBy("run").orderBy(F.desc("step"))
    retained = saved.withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= keep)
    counts = saved.groupBy("run").agg(F.count("*").alias("n_saved"))
    return retained.join(counts, "run").select("run", "step", "age", "n_saved")
