"""Checks of corpora, logs and distributions on small planted cases."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from distaff.operators import checks, examples, grams, misses
from distaff.operators.ordering import running


def test_shards_follow_the_running_sum(spark):
    sizes = [7, 0, 5, 12, 1, 3, 30, 2, 2, 9, 4] * 9
    df = spark.createDataFrame([(i * 3, n) for i, n in enumerate(sizes)], "k bigint, n int").repartition(5)
    got = {r.k: (r.start, r.shard_id) for r in checks.shard_tokens(df, "k", F.col("n"), 10).collect()}
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()
    assert got == {i * 3: (s, s // 10) for i, s in enumerate(starts)}


def test_shards_keep_null_repeated_and_sparse_keys(spark):
    keys = [None, None, "b", "a", "b", "zz", "b", "é"] + ["hot"] * 300
    rows = [(k, None if i == 5 else i % 4) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(7)
    got = checks.shard_tokens(df, "k", F.col("n"), 25).collect()
    assert sorted((r.k or "", r.n_tokens) for r in got) == sorted((k or "", n or 0) for k, n in rows)
    at = 0
    for r in sorted(got, key=lambda r: (r.start, r.n_tokens, (r.k or "").encode())):
        assert r.start == at and r.shard_id == at // 25
        at += r.n_tokens
    order = [(r.k is not None, (r.k or "").encode()) for r in sorted(got, key=lambda r: r.start) if r.n_tokens]
    assert order == sorted(order)
    assert checks.shard_tokens(df.limit(0), "k", F.col("n"), 10).count() == 0


def test_running_values_of_hot_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(["hot", "cold", None][min(int(g), 2)], int(o), float(v)) for g, o, v in zip(rng.integers(0, 9, 400) // 3, rng.permutation(400), rng.normal(size=400))]
    df = spark.createDataFrame(rows, "g string, o int, v double").repartition(5)
    got = running(df, ["g"], ["o"], {"total": ("sum", F.col("o")), "top": ("max", F.col("v"))}).collect()
    assert len(got) == 400
    for r in got:
        earlier = [(o, v) for g, o, v in rows if g == r.g and o < r.o]
        assert r.total == sum(o for o, _ in earlier)
        assert r.top == (max(v for _, v in earlier) if earlier else None)


def test_grams_of_short_null_and_repeated_rows(spark):
    texts = spark.createDataFrame(
        [(1, "a b c a b c"), (2, "a b"), (3, None), (4, "x a b c y"), (4, "x a b c y"), (None, "a  b\n c"), (5, "")], "k int, t string"
    ).repartition(3)
    other = spark.createDataFrame([("z a b c",), ("a b c",), (None,)], "t string")
    got = sorted((r.k or 0, r.n_grams, r.n_shared) for r in checks.shared_grams(texts, other, "k", "t", 3).collect())
    assert got == [(0, 1, 1), (1, 3, 1), (2, 0, 0), (3, 0, 0), (4, 3, 1), (4, 3, 1), (5, 0, 0)]
    held = checks.holdout_contamination(texts, other, "k", "t", 3).collect()
    assert sorted((r.k or 0, r.n_shared) for r in held) == [(0, 1), (1, 1), (4, 1), (4, 1)]
    for empty in (texts.limit(0), texts.filter("k = 2")):
        assert checks.holdout_contamination(empty, other, "k", "t", 3).count() == 0
    assert {r.share_verbatim for r in checks.regurgitation(texts, other.limit(0), "k", "t", 3).collect()} == {0.0}


def test_grams_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    text = lambda: " ".join(rng.choice(list("abcde"), rng.integers(0, 30)))
    rows, other = [(i, text()) for i in range(300)], [text() for _ in range(60)]
    gram = lambda t, n: {tuple(t.split()[i : i + n]) for i in range(len(t.split()) - n + 1)}
    mine = spark.createDataFrame(rows, "k int, t string").repartition(4)
    theirs = spark.createDataFrame([(t,) for t in other], "t string").repartition(3)
    for n in (1, 4, 7):
        known = set().union(*(gram(t, n) for t in other))
        wanted = {k: (len(gram(t, n)), len(gram(t, n) & known)) for k, t in rows}
        assert {r.k: (r.n_grams, r.n_shared) for r in checks.shared_grams(mine, theirs, "k", "t", n).collect()} == wanted
        held = {r.k: r.n_shared for r in checks.holdout_contamination(mine, theirs, "k", "t", n).collect()}
        assert held == {k: m for k, (_, m) in wanted.items() if m}


def test_few_grams_pass_the_filter(spark):
    """What is shuffled follows the hits, not the corpus."""
    corpus = spark.range(4000).selectExpr("id AS k", "concat_ws(' ', transform(sequence(1, 60), i -> hash(id, i))) AS t")
    held = corpus.filter("k < 5").union(spark.createDataFrame([(0, "a b c d e f g")], "k bigint, t string"))
    passed = grams.gram_table(corpus, ["k"], "t", 7, kept=grams.gram_filter(grams.gram_table(held, ["k"], "t", 7)))
    assert 5 * 54 <= passed.count() <= 5 * 54 + 40
    assert checks.holdout_contamination(corpus, held, "k", "t", 7).agg(F.sum("n_shared")).first()[0] == 5 * 54


def test_overfitting_is_found_at_every_step(spark):
    rng = np.random.default_rng(4)
    bad = [float("nan"), float("inf"), float("-inf"), None]
    rows = []
    for run in ("a", "b", None):
        for step in sorted(rng.choice(300, 150, replace=False).tolist()) + [5000, 5001, 5003]:
            train = bad[rng.integers(0, 4)] if rng.random() < 0.1 else 1000 + float(rng.normal())
            rows.append((run, step, train, float(rng.normal()) if step % 3 == 0 else None))
    rows.append(("a", 5001, 7.0, 1.0))
    log = spark.createDataFrame(rows, "run string, step int, train_loss double, eval_loss double").repartition(4)
    for span in (1, 7, 40):
        found = checks.overfit_check(log, 3, span).collect()
        assert len(found) == len(rows)
        for r in found:
            near = [x for x in rows if x[0] == r.run and r.step - span < x[1] <= r.step]
            slopes, ns, off = [], [], 0
            for i in (2, 3):
                points = [(x[1], x[i]) for x in near if x[i] is not None and np.isfinite(x[i])]
                off += sum(x[i] is not None and not np.isfinite(x[i]) for x in near)
                spread = len({s for s, _ in points}) > 1
                slopes.append(float(np.polyfit(*zip(*points), 1)[0]) if spread else None)
                ns.append(len(points))
            assert (r.n_train, r.n_eval, r.n_not_finite) == (*ns, off)
            for got, wanted in zip((r.train_slope, r.eval_slope), slopes):
                assert (got is None) == (wanted is None) and (got is None or abs(got - wanted) < 1e-6)
            assert (r.overfits is None) == (min(ns) < 3)
            if r.overfits is not None and None not in slopes:
                assert r.overfits == (slopes[0] < 0 < slopes[1])
    planted = [("bad", i, 1.0 - 0.1 * i, 1.0 + 0.1 * i) for i in range(8)] + [("good", i, 1.0 - 0.1 * i, 1.0 - 0.1 * i) for i in range(8)]
    found = checks.overfit_check(spark.createDataFrame(planted, log.schema), 5, 100).filter("step = 7")
    assert {r.run: r.overfits for r in found.collect()} == {"bad": True, "good": False}


def test_distances_against_numpy(spark):
    rng = np.random.default_rng(0)
    t, s = rng.normal(size=(20, 6)), rng.normal(size=(20, 6))
    df = spark.createDataFrame([(a.tolist(), b.tolist(), 0) for a, b in zip(t, s)], "teacher array<double>, student array<double>, label int")
    p, q = (np.exp(x) / np.exp(x).sum(1, keepdims=True) for x in (t, s))
    assert abs(checks.tvd(df).first()[0] - (np.abs(p - q).sum(1) / 2).mean()) < 1e-12
    cosine = 1 - (t * s).sum(1) / np.sqrt((t * t).sum(1) * (s * s).sum(1))
    assert abs(checks.hidden_cosine(df).first()[0] - cosine.mean()) < 1e-12
    rest = np.abs(-np.sort(-p[:, 2:]) + np.sort(-q[:, 2:])).sum(1)
    assert abs(checks.uld(df, 2).first()[0] - (np.abs(p - q)[:, :2].sum(1) + rest).mean()) < 1e-12


def test_unequal_widths_fail_and_states_without_direction_are_counted(spark):
    rows = [([1.0, 2.0], [1.0, 3.0], 0), ([0.0, 0.0], [1.0, 1.0], 0), ([1.0, 1.0], [5.0, 5.0], -100)]
    schema = "teacher array<double>, student array<double>, label int"
    r = checks.hidden_cosine(spark.createDataFrame(rows, schema)).first()
    assert r.n_without_direction == 1 and abs(r.hidden_cosine - (1 - 7 / math.sqrt(50))) < 1e-12
    for bad in (([1.0, 2.0, 3.0], [1.0, 2.0], 0), (None, [1.0], 0), ([1.0], None, None)):
        df = spark.createDataFrame([*rows[:1], bad], schema)
        for loss in (checks.tvd, checks.hidden_cosine):
            with pytest.raises(Exception, match="differ in width"):
                loss(df).collect()
    assert checks.tvd(spark.createDataFrame([*rows[:1], ([1.0], [1.0, 2.0], -100)], schema)).first()[0] > 0


def test_distance_across_vocabularies(spark):
    rng = np.random.default_rng(8)
    mine = {f"t{i}": i for i in rng.permutation(12).tolist()}
    other = dict(zip(["t3", "t9", "x", "t0", "y", "t11", "z"], rng.permutation(9)[:7].tolist()))
    tables = [spark.createDataFrame(list(v.items()), "token string, id int") for v in (mine, other)]
    alignment = checks.align_vocabularies(*tables)
    assert tuple(checks.vocabulary_overlap(alignment).first()) == (12, 7, 4, 4 / 12)
    t, s = rng.normal(size=(15, 14)), rng.normal(size=(15, 9))
    labels = [-100 if i % 5 == 0 else i for i in range(15)]
    df = spark.createDataFrame([(a.tolist(), b.tolist(), y) for a, b, y in zip(t, s, labels)], "teacher array<float>, student array<double>, label int")
    soft = lambda x, ids: dict(zip(ids, np.exp(x[list(ids.values())]) / np.exp(x[list(ids.values())]).sum()))
    wanted = []
    for a, b, y in zip(t.astype(np.float32).astype(float), s, labels):
        p, q = soft(a, mine), soft(b, other)
        left = [sorted((v for k, v in d.items() if k not in e), reverse=True) for d, e in ((p, other), (q, mine))]
        pairs = itertools.zip_longest(*left, fillvalue=0.0)
        if y != -100:
            wanted.append(sum(abs(p[k] - q[k]) for k in mine if k in other) + sum(abs(x - z) for x, z in pairs))
    assert abs(checks.uld_aligned(df, alignment).first()[0] - np.mean(wanted)) < 1e-9
    twice = spark.createDataFrame([("a", 4), ("a", 2), ("b", 0)], "token string, id int")
    found = checks.align_vocabularies(twice, spark.createDataFrame([("a", 1), ("c", 3)], "token string, id int"))
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, [("a", 2, 1), ("a", 4, None), ("b", 0, None), ("c", None, 3)]))
    for bad in (([1.0] * 3, [1.0] * 9, 0), (None, [1.0] * 9, 0)):
        with pytest.raises(Exception, match="out of bounds|missing"):
            checks.uld_aligned(spark.createDataFrame([bad], df.schema), alignment).collect()
    with pytest.raises(ValueError, match="at most 3"):
        checks.uld_aligned(df, alignment, max_vocab=3)


def test_dead_tokens(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "token string, id int")
    ids = spark.createDataFrame([([0, 0],), ([],), (None,), ([2],)], "token_ids array<bigint>")
    assert [tuple(r) for r in checks.dead_tokens(vocab, ids).collect()] == [("b", 1)]


def test_truth_reasons(spark, chats):
    df = chats(
        [
            ("ok", "[]", [("human", "q"), ("function_call", '{"name":"f"}')]),
            ("bad", "[]", [("human", "q"), ("function_call", "{")]),
            ("anonymous", "[]", [("human", "q"), ("function_call", '{"n":1}')]),
            ("prose", "[]", [("human", "q"), ("gpt", "hm")]),
            ("alone", "[]", [("human", "q")]),
            ("other", "[]", [("gpt", "q"), ("human", "x")]),
        ]
    )
    got = {r.example_id: r.truth_reason for r in examples.with_truth_reason(df).collect()}
    assert got == {
        "ok": None, "bad": "truth_not_json", "anonymous": "truth_without_name",
        "prose": "no_call_due", "alone": "no_reply", "other": "first_not_human",
    }


def test_unique_false_positives(spark):
    call = {"name": '"f"', "arguments": "{}"}
    rows = [(1, "a", call, False, True), (1, "b", call, False, True), (2, "a", call, False, True), (3, "a", call, True, True), (2, "b", call, False, False)]
    scored = spark.createDataFrame(
        [(i, m, "q", tuple(c.values()), g, p) for i, m, c, g, p in rows],
        "example_id int, model string, user_turn string, call struct<name:string,arguments:string>, gt_is_call boolean, pred_is_call boolean",
    )
    assert [r.example_id for r in misses.unique_false_positives(scored, "a", "b").collect()] == [2]
