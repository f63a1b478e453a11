"""Mixing: targets, exact fits, repeatability."""

import random

import numpy as np
import pytest

from distaff.llm.mixing import _knapsack, fit_budget, mix, source_targets

SCHEMA = "doc_id bigint, text string, source string, size string, part int"


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        share = {s: (budget - sum(fixed.values())) * weight[s] / total for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    sources = ["a", "B", "é", "zz", None]
    rows = [(i, " \t".join("w" for _ in range(rng.choice([0, 1, 2, 7, 7, 7, 30, 91]))), rng.choice(sources[: 5 if i % 3 else 2]), "x", 1) for i in range(n)]
    return rows + [(n, None, "a", "x", 1), (3, rows[3][1], rows[3][2], "x", 1), (None, "q r", "a", "x", 1), (n + 1, "long " * 5000, "B", None, None)]


def test_targets_sizes_and_bounds(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = plain_targets(sizes)
    for source, size in sizes.items():
        mine = [r for r in got if r.source == source]
        assert {r.source_size for r in mine} == {size} and abs(mine[0].target - targets[source]) < 1e-6
        assert abs(sum(r.taken for r in mine) - targets[source]) <= 1
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in got)
    again = mix(df.repartition(7)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_one_length_in_one_source(spark):
    rows = [(i, "same words here", "s" if i % 3 else "t", "", 0) for i in range(500)]
    got = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    for source in "st":
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) < 3


def test_empty_and_wordless(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    got = mix(spark.createDataFrame([(1, None, "s", "", 0), (2, " ", None, "", 0)], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("seed", range(6))
def test_knapsack_is_exact(seed):
    rng = random.Random(seed)
    lengths = np.array(rng.sample(range(2, 40), 5))
    counts = np.array([rng.randrange(4) for _ in lengths])
    reach = {0}
    for n, c in zip(lengths.tolist(), counts.tolist()):
        reach = {s + n * k for s in reach for k in range(c + 1)}
    budget = rng.randrange(1, 150)
    taken = _knapsack(lengths, counts, budget)
    assert (taken <= counts).all()
    low = max(s for s in reach if s <= budget)
    assert abs(int((taken * lengths).sum()) - budget) <= budget - low


def test_fit_budget_of_large_counts():
    lengths, counts = np.array([3, 1000, 100_000]), np.array([10, 5_000_000, 70])
    taken = fit_budget(lengths, counts, 2_000_000_007)
    assert (taken <= counts).all() and abs(int((taken * lengths).sum()) - 2_000_000_007) <= 3
    assert fit_budget(lengths, counts, 10**12).tolist() == counts.tolist() and fit_budget(lengths, counts, 0).sum() == 0


def test_targets_without_sources(spark):
    assert source_targets(spark.createDataFrame([], "source string, source_size bigint")).count() == 0
