"""Run-log audits on planted faults."""

import math

import pytest
from pyspark.sql import functions as F

from distaff.functions.schedules import cosine_rate, linear_rate
from distaff.functions.text import is_finite_loss
from distaff.operators import quality, runlog

PEAK, TOTAL = 2e-5, 345


def linear(step, warmup):
    if step < warmup:
        return PEAK * step / max(1, warmup)
    return PEAK * max(0.0, 1 - (step - warmup) / max(1, TOTAL - warmup))


def cosine(step, warmup, total):
    if step < warmup:
        return step / max(1, warmup)
    return 0.5 * (1 + math.cos(math.pi * (step - warmup) / max(1, total - warmup)))


@pytest.fixture(scope="module")
def log(spark):
    rows = []
    for step in range(1, TOTAL + 1):
        rows.append(("claimed30", step, float(step), linear(step, 0)))
        if not 50 <= step <= 59 and step != 100:
            loss = float("nan") if step == 7 else 1.0
            rows.append(("warmed", step, loss, linear(step, 30)))
    df = spark.createDataFrame(rows, "run string, step int, loss double, lr double")
    return df.withColumn("ts", F.timestamp_seconds(F.col("step") * 60)).cache()


def test_planted_warmup_fault(log):
    audit = runlog.lr_trajectory_audit(log, PEAK, TOTAL, [0, 30]).filter("fits_best").collect()
    assert {r.run: r.warmup for r in audit} == {"claimed30": 0, "warmed": 30}
    assert all(r.max_error < 1e-18 for r in audit)


def test_schedules(spark):
    steps = spark.range(0, 50)
    got = steps.select(
        "id",
        linear_rate(F.col("id"), PEAK, 30, TOTAL).alias("l"),
        cosine_rate(F.col("id"), 1.0, 5, 50).alias("c"),
    ).collect()
    for r in got:
        assert r.l == pytest.approx(linear(r.id, 30))
        assert r.c == pytest.approx(cosine(r.id, 5, 50))


def test_gaps(log):
    gaps = [(r.run, r.missing_from, r.missing_to, r.n_missing) for r in runlog.log_gaps(log, 16).collect()]
    assert sorted(gaps) == [("warmed", 50, 59, 10), ("warmed", 100, 100, 1)]


def test_summary(log):
    rows = {r.run: r for r in runlog.run_summary(log).collect()}
    assert rows["claimed30"].final_loss == 345.0 and rows["claimed30"].all_finite
    assert rows["warmed"].n_not_finite == 1 and not rows["warmed"].all_finite
    assert rows["warmed"].mean_loss == 1.0
    assert rows["claimed30"].runtime_us == 344 * 60 * 10**6
    # A working warm-up starts far below the peak.
    assert rows["warmed"].first_lr < PEAK / 10 < rows["claimed30"].first_lr


def test_common_steps(log):
    r = runlog.common_steps(log, "claimed30", "warmed").first()
    assert (r.n_a, r.n_b, r.n_common, r.first_common, r.last_common) == (345, 334, 334, 1, 345)


def test_disjoint_windows_have_no_common_step(spark):
    log = spark.createDataFrame([("a", 1), ("a", 2), ("b", 8)], "run string, step int")
    r = runlog.common_steps(log, "a", "b").first()
    assert (r.n_common, r.first_common) == (0, None)


def test_checkpoints(log):
    rows = runlog.checkpoint_plan(log).filter("run = 'claimed30'").orderBy("age").collect()
    assert [(r.step, r.n_saved) for r in rows] == [(345, 35), (340, 35), (330, 35)]


def test_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(is_finite_loss(F.col("x"))).collect()] == [True, False, False]


@pytest.mark.parametrize("n,full,left", [(300, 37, 4), (2760, 345, 0)])
def test_steps(spark, n, full, left):
    r = quality.steps_plan(spark.range(n), 1, 8).first()
    assert (r.full_steps, r.rows_left) == (full, left)
