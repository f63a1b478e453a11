"""Losses against numpy, and the identities they must obey."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from distaff.functions.distributions import log_softmax
from distaff.operators import losses
from distaff.plans import workload


def lsm(x, t=1.0):
    z = np.asarray(x, float) / t
    z = z - z.max()
    return z - np.log(np.exp(z).sum())


def kl(p, q):
    return float((np.exp(p) * (p - q)).sum())


def jsd(p, q, beta):
    if beta == 0:
        return kl(p, q)
    if beta == 1:
        return kl(q, p)
    m = np.log(beta * np.exp(p) + (1 - beta) * np.exp(q))
    return beta * kl(p, m) + (1 - beta) * kl(q, m)


RNG = np.random.default_rng(7)
ROWS = [
    (i, (RNG.normal(size=11) * 3).tolist(), (RNG.normal(size=11) * 3).tolist(), int(label))
    for i, label in enumerate([0, 3, -100, 10, -100, 5])
]
SCHEMA = "i int, teacher array<double>, student array<double>, label int"


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def mean(f):
    return float(np.mean([f(np.array(t), np.array(s), y) for _, t, s, y in ROWS if y != -100]))


def test_log_softmax_is_stable(spark):
    df = spark.createDataFrame([([1000.0, 1001.0, -1000.0],)], "x array<double>")
    got = df.select(log_softmax(F.col("x"), 2.0).alias("y")).first().y
    assert np.allclose(got, lsm([1000.0, 1001.0, -1000.0], 2.0))


@pytest.mark.parametrize("t", [1.0, 2.0, 4.0])
def test_kd_parts(frame, t):
    r = losses.kd_loss(frame, t, 0.7).first()
    kd = mean(lambda a, b, y: kl(lsm(a, t), lsm(b, t))) * t * t
    ce = mean(lambda a, b, y: -lsm(b)[y])
    assert r.kd == pytest.approx(kd) and r.ce == pytest.approx(ce)
    assert r.loss == pytest.approx(0.7 * kd + 0.3 * ce)
    assert losses.kl_forward(frame, t).first().kl == pytest.approx(kd)


@pytest.mark.parametrize("beta", [0.0, 0.25, 0.5, 1.0])
def test_jsd(frame, beta):
    got = losses.generalized_jsd(frame, beta, 2.0).first().jsd
    assert got == pytest.approx(mean(lambda a, b, y: jsd(lsm(a, 2.0), lsm(b, 2.0), beta)))


def test_jsd_symmetric_at_half(frame):
    swapped = frame.select(
        F.col("student").alias("teacher"), F.col("teacher").alias("student"), "label"
    )
    a = losses.generalized_jsd(frame, 0.5).first().jsd
    assert a == pytest.approx(losses.generalized_jsd(swapped, 0.5).first().jsd)


def test_identical_is_zero_and_all_kl_positive(frame):
    same = frame.withColumn("student", F.col("teacher"))
    assert losses.kl_forward(same, 2.0).first().kl == pytest.approx(0.0, abs=1e-12)
    rows = frame.select(losses.divergence(1.0).alias("d")).collect()
    assert all(r.d > 0 for r in rows)


def test_one_hot_has_no_nan(spark):
    df = spark.createDataFrame([([1e4, 0.0, 0.0], [0.0, 1.0, 0.0], 0)], "teacher array<double>, student array<double>, label int")
    got = losses.kl_forward(df, 1.0).first().kl
    assert got == pytest.approx(-lsm([0.0, 1.0, 0.0])[0])
    assert losses.generalized_jsd(df, 0.5).first().jsd == pytest.approx(
        jsd(np.log([1.0, 1e-300, 1e-300]), lsm([0.0, 1.0, 0.0]), 0.5)
    )


def test_all_ignored_is_null(frame):
    none = frame.withColumn("label", F.lit(-100))
    r = losses.kd_loss(none).first()
    assert r.kd is None and r.ce is None and r.loss is None


def test_sweep_equals_single_runs(frame):
    for r in losses.sweep_grid(frame).collect():
        one = losses.kd_loss(frame, r.temperature, r.alpha_soft).first()
        assert r.loss == pytest.approx(one.loss) and r.kd == pytest.approx(one.kd)


def test_padding_columns_change_only_untruncated_losses(frame):
    padded = frame.withColumns(
        {c: F.concat(c, F.array(F.lit(50.0), F.lit(-3.0))) for c in ("teacher", "student")}
    )
    cut = losses.truncate_vocab(padded, 11, "teacher", "student")
    assert losses.kd_loss(cut).first() == losses.kd_loss(frame).first()
    assert losses.kd_loss(padded).first() != losses.kd_loss(frame).first()


@pytest.mark.parametrize("k", [1, 3, 11, 20])
def test_top_k_forms_agree(spark, k):
    rows = [(i, t) for i, t, _, _ in ROWS] + [(50, [1.0, 2.0, 2.0, 2.0, 0.0])]
    df = spark.createDataFrame(rows, "i int, x array<double>")
    expected = {
        i: sorted(range(len(x)), key=lambda j: (-lsm(x)[j], j))[:k] for i, x in rows
    }
    narrow = losses.topk_logprobs(df, "x", k).collect()
    wide = losses.topk_logprobs_wide(df, "x", k).collect()
    assert {r.i: [e.token_id for e in r.top] for r in narrow} == expected
    assert {r.i: [e.token_id for e in r.top] for r in wide} == expected
    long = df.select("i", F.posexplode(log_softmax(F.col("x"))).alias("token_id", "logprob"))
    ranked = losses.topk_long(long, k, "i").orderBy("i", "rank").collect()
    got = {}
    for r in ranked:
        got.setdefault(r.i, []).append(r.token_id)
    assert got == expected
    assert all(sum(np.exp(e.logprob) for e in r.top) <= 1 + 1e-9 for r in narrow)


def test_sparse_equals_dense_at_full_width(frame):
    teacher = losses.topk_logprobs(frame, "teacher", 11).select("i", "label", "top")
    sparse = losses.sparse_kl(teacher, frame.select("i", "student"), "i").first().sparse_kl
    assert sparse == pytest.approx(losses.kl_forward(frame, 1.0).first().kl)


def test_composite(spark):
    df = spark.createDataFrame([(1.0, 3.0)], "ce double, kl double")
    assert losses.composite_loss(df, {"ce": 0.5, "kl": 0.25}).first().loss == 1.25


def test_causal_shift(spark):
    df = spark.createDataFrame([([10, 11, 12], [1, 2, 3]), ([5], [4])], "x array<int>, labels array<int>")
    got = [(r.x, r.labels) for r in losses.causal_shift(df, ["x"]).collect()]
    assert got == [([10, 11], [2, 3]), ([], [])]
    long = spark.createDataFrame([("s", 0, 1), ("s", 1, 2), ("t", 0, 9)], "seq string, pos int, label int")
    assert [(r.pos, r.label) for r in losses.causal_shift_long(long).collect()] == [(0, 2)]


def test_frozen_forward_kl(spark):
    rows = workload.positions(spark, "/root/testdata/sf0.01").select(losses.divergence(2.0).alias("d"))
    assert rows.agg(F.sum("d")).first()[0] == pytest.approx(1.913704, abs=1e-6)


@pytest.mark.parametrize(
    "teacher, student, label",
    [([1.0, 2.0], [1.0], 0), ([1.0], [1.0, 2.0], 0), ([1.0, 2.0], [1.0, 2.0], 5), ([1.0, 2.0], [1.0, 2.0], None), (None, [1.0], 0)],
)
def test_no_position_vanishes_from_a_mean(spark, teacher, student, label):
    rows = [([1.0, 2.0], [2.0, 1.0], 1), (teacher, student, label)]
    df = spark.createDataFrame(rows, "teacher array<double>, student array<double>, label int")
    with pytest.raises(Exception, match="width|vocabulary"):
        losses.kd_loss(df).collect()


def test_stored_ids_must_fit_the_student(spark):
    teacher = spark.createDataFrame([(1, [(0, -0.1), (9, -3.0)], 0)], "p int, top array<struct<token_id:int,logprob:double>>, label int")
    for student in ([(1, [1.0, 2.0])], [(2, [1.0] * 10)]):
        other = spark.createDataFrame(student, "p int, student array<double>")
        with pytest.raises(Exception, match="vocabulary"):
            losses.sparse_kl(teacher, other, "p").collect()
