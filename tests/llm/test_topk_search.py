"""Exact top-k against brute force."""

import math

import numpy as np

from distaff.llm import topk_search
from distaff.llm.topk_search import first_floor, integer_vectors, threshold_search, top_k

SCHEMA = "vec_id bigint, embedding array<float>, label int, score bigint"


def brute(vectors, ids, k):
    out = []
    for q in ids:
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_equals_brute_force_with_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(1).tolist(), 0, 0) for i in range(200)]
    rows += [(i, [0.5] * 6, 0, 0) for i in range(200, 260)]
    bad = [(300, None, 0, 0), (320, [float("nan")] * 6, 0, 0), (340, [None] + [1.0] * 5, 0, 0), (360, [math.inf] * 6, 0, 0), (None, [1.0] * 6, 0, 0)]
    ints = integer_vectors(spark.createDataFrame(rows + bad, SCHEMA))
    vectors = {r.vec_id: r.ints for r in ints.collect()}
    assert len(vectors) == 260
    got = sorted(map(tuple, top_k(ints.filter("vec_id % 20 = 0"), ints, 7, query_block=4, block=50).collect()))
    assert got == brute(vectors, [q for q in vectors if q % 20 == 0], 7)


def test_fewer_candidates_than_k_and_none(spark):
    few = integer_vectors(spark.createDataFrame([(0, [1.0], 0, 0), (1, [-2.0, 1.0], 0, 0)], SCHEMA))
    assert [tuple(r) for r in top_k(few.filter("vec_id = 0"), few).collect()] == [(0, 1, 1, -8192)]
    none = few.filter("vec_id > 5")
    assert top_k(none, none).count() == 0


def exact(own, asked, ids, rows, k):
    out = []
    for q, (i, vector) in enumerate(zip(own, asked)):
        scored = sorted((-int(s), int(j)) for j, s in zip(ids, rows @ vector) if j != i)[:k]
        out += [(q, j, -s) for s, j in scored]
    return sorted(out)


def test_whole_block_search_against_brute_force():
    rng = np.random.default_rng(3)
    for n, width, spread in ((3000, 3, 4), (3000, 3, 60), (700, 8, 2), (40, 5, 9)):
        ids = rng.permutation(n * 2)[:n]
        rows = rng.integers(-spread, spread + 1, (n, width)).astype(float)
        rows[rng.integers(0, n, 30)] *= 3
        asked = np.concatenate([rng.integers(-3, 4, (25, width)).astype(float), np.zeros((1, width))])
        own = np.concatenate([ids[:20], [-1] * 6])
        for dtype in (float, np.int64):
            a, r = asked.astype(dtype), rows.astype(dtype)
            none = np.full(len(a), topk_search._lowest(np.dtype(dtype)), dtype)
            query, vec_id, score, _ = threshold_search(own, a, ids, r, 7, none)
            assert sorted(zip(query.tolist(), vec_id.tolist(), score.tolist())) == exact(own, asked, ids, rows, 7)
            floor = first_floor(own, a, ids[: n // 2], r[: n // 2], 7)
            query, vec_id, score, _ = threshold_search(own, a, ids, r, 7, floor)
            wanted = exact(own, asked, ids, rows, 7)
            assert sorted(zip(query.tolist(), vec_id.tolist(), score.tolist())) == [w for w in wanted if w[2] >= floor[w[0]]] == wanted


def test_rows_read_by_the_kind_of_vectors():
    """The stop acts where vectors differ in length; alike ones are scored by a product."""
    rng = np.random.default_rng(1)
    asked = np.abs(rng.integers(1, 9, (50, 4))).astype(float)
    own, ids = np.full(50, -1), np.arange(20_000)
    none = np.full(50, -np.inf)
    flat = rng.normal(size=(20_000, 4))
    alike = np.floor(64 * flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True)))
    long_tailed = np.floor(alike * rng.pareto(1.0, (20_000, 1)))
    reads = [threshold_search(own, asked, ids, rows, 5, none)[3] / 50 for rows in (alike, long_tailed)]
    assert reads[1] < 0.02 * 20_000 < reads[0]
    longest = np.argsort(-(long_tailed**2).sum(axis=1))[:500]
    floor = first_floor(own, asked, ids[longest], long_tailed[longest], 5)
    others = np.setdiff1d(ids, longest)
    short = others[(long_tailed[others] ** 2).sum(axis=1) < 64**2]
    assert len(short) > 5000 and threshold_search(own, asked, ids[short], long_tailed[short], 5, floor)[3] == 0


def test_one_vector_repeated_without_bound_is_dealt_out(spark):
    rows = [(i, [float(i % 3), 1.0], 0, 0) for i in range(30)] + [(7, [2.0, 2.0], 0, 0)] * 400
    ints = integer_vectors(spark.createDataFrame(rows, SCHEMA))
    got = top_k(ints.filter("vec_id = 0"), ints, 5, block=20)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, r, 7, 8192) for r in range(1, 6)]
