"""Properties of samples and splits."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from distaff.operators import sampling


def ids(df, column="id"):
    return {r[column] for r in df.select(column).collect()}


def lowest(keys, seed, n):
    order = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}-{k}".encode()).hexdigest(), k))
    return set(order[:n])


@pytest.mark.parametrize("rows", [1, 12, 13, 100, 3000])
def test_exact_count_disjoint_complete(spark, rows):
    split = sampling.exact_split(spark.range(rows), "id")
    test = ids(split.filter("split = 'test'"))
    train = ids(split.filter("split = 'train'"))
    assert len(test) == math.ceil(0.08 * rows)
    assert not test & train and test | train == set(range(rows))
    assert test == lowest(range(rows), 3407, len(test))


def test_published_counts(spark):
    sample = sampling.seeded_sample(spark.range(10_000), "id")
    split = sampling.exact_split(sample, "id")
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"train": 2760, "test": 240}


def test_repartitioning_changes_nothing(spark):
    few = sampling.exact_split(spark.range(0, 500, 1, 1), "id")
    many = sampling.exact_split(spark.range(0, 500, 1, 17).repartition(5, "id"), "id")
    assert few.exceptAll(many).count() == 0


def test_frozen_split(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id")
    test = sampling.exact_split(events, "event_id").filter("split = 'test'")
    assert tuple(test.agg(F.count("*"), F.sum("event_id")).first()) == (800, 4_028_669)


@pytest.mark.parametrize("n", [0, 1, 7, 50, 80])
def test_sample_size(spark, n):
    got = ids(sampling.seeded_sample(spark.range(50), "id", n, 1))
    assert got == lowest(range(50), 1, min(n, 50))


@pytest.mark.parametrize("digits, levels", [(1, 1), (2, 3)])
def test_prefix_depth_changes_nothing(spark, monkeypatch, digits, levels):
    plain = ids(sampling.seeded_sample(spark.range(3000), "id", 1234))
    monkeypatch.setattr(sampling, "DIGITS_PER_LEVEL", digits)
    monkeypatch.setattr(sampling, "LEVELS", levels)
    assert ids(sampling.seeded_sample(spark.range(3000), "id", 1234)) == plain


def test_sizes_are_exact_or_refused(spark):
    hot = spark.range(90).select(F.when(F.col("id") < 60, 7).otherwise(F.col("id")).alias("id"))
    exact = refused = 0
    for n in range(1, 90, 4):
        try:
            assert sampling.seeded_sample(hot, "id", n).count() == n
            exact += 1
        except ValueError:
            refused += 1
    assert exact and refused


@pytest.mark.parametrize("n", [1, 13, 30, 49])
def test_null_keys_take_part(spark, n):
    df = spark.range(50).select(F.when(F.col("id") != 17, F.col("id")).alias("id"))
    assert sampling.seeded_sample(df, "id", n).count() == n
    split = sampling.exact_split(df, "id", 0.3)
    assert split.filter("split = 'test'").count() == 15


def test_prompt_overlap_ignores_case_and_white_space(spark):
    side = lambda *p: spark.createDataFrame([(x,) for x in p], "p string")
    got = sampling.prompt_overlap(side("A  b", "c", "c", None), side("a b ", "a\tB", "d"), "p").first()
    assert tuple(got) == (3, 2, 1, 2)


def test_empty_input(spark):
    empty = spark.range(0)
    assert sampling.exact_split(empty, "id").count() == 0
    assert sampling.seeded_sample(empty, "id").count() == 0


def test_copies_of_a_key_stay_together(spark):
    df = spark.range(40).select((F.col("id") % 4).alias("id"))
    split = sampling.exact_split(df, "id", 0.5)
    sides = split.groupBy("id").agg(F.countDistinct("split").alias("n")).collect()
    assert {r.n for r in sides} == {1}


def test_nested_split_only_touches_train(spark):
    split = sampling.exact_split(spark.range(200), "id")
    nested = sampling.nested_split(split, "id")
    assert ids(nested) == ids(split.filter("split = 'train'"))
    assert nested.filter("inner_split = 'test'").count() == math.ceil(0.08 * 184)


def test_audit_finds_planted_leak(spark):
    split = sampling.exact_split(spark.range(100), "id")
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    assert sampling.split_audit(train, test, "id").first().n_leaked_keys == 0
    leaky = train.unionAll(test.limit(2))
    audit = sampling.split_audit(leaky, test, "id").first()
    assert (audit.n_train, audit.n_test, audit.n_leaked_keys) == (94, 8, 2)


def test_stages(spark):
    df = spark.range(1000)
    assert sampling.staged_subset(df, "id", "medium").count() == 300
    assert sampling.staged_subset(df, "id", "full").count() == 1000
    with pytest.raises(ValueError):
        sampling.staged_subset(df, "id", "other")


def test_policy_mix_share(spark):
    share = lambda l: sampling.policy_mix(spark.range(4000), "id", l).filter("on_policy").count()
    assert share(0.0) == 0 and share(1.0) == 4000 and 1850 < share(0.5) < 2150


def test_string_keys(spark):
    keys = [f"k'{i}" for i in range(30)]
    df = spark.createDataFrame([(k,) for k in keys], "id string")
    assert ids(sampling.seeded_sample(df, "id", 10, 5)) == lowest(keys, 5, 10)


def test_filter_never_touches_held_out(spark):
    split = sampling.exact_split(spark.range(100), "id")
    kept = spark.range(0)
    held = sampling.mode_select(split, kept, "id", held_out=True, filtered=True)
    assert held.count() == 8
    assert sampling.mode_select(split, kept, "id", filtered=True).count() == 0
