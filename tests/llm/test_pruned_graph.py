"""Graph search against brute force."""

import numpy as np
import pytest

from distaff.llm import pruned_graph as pg

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, vector string, shard int"


def cosines(a, b):
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    return (b @ a) / (np.sqrt(a @ a) * np.sqrt((b * b).sum(axis=1)))


def brute(rows, wanted, k):
    """{query: [(vec_id, score)]} over (vec_id, vector) rows."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    out = {}
    for q in wanted:
        score = cosines(vectors[ids == q][0], vectors)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), score[j]) for j in order]
    return out


def search(spark, rows, every, k, shard_rows=8192, query_block=8192, **how):
    df = spark.createDataFrame([(i, v, 0, 0.5, "x", 7) for i, v in rows], SCHEMA).repartition(3)
    vectors = pg.usable_vectors(df)
    index = pg.build_index(vectors, k, shard_rows=shard_rows, **how)
    found = pg.nearest(vectors.filter(vectors.vec_id % every == 0), index, k, query_block=query_block).collect()
    out = {}
    for r in sorted(found):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, wanted):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in wanted.items()])


def test_small_shards_are_searched_whole(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)]
    rows += [(i, [0.5, 1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(400, 480)]
    bad = [(500, None), (510, [float("nan")] * 6), (520, [None] * 6), (530, [float("inf")] * 6), (540, [0.0] * 6), (None, [1.0] * 6)]
    got = search(spark, rows + bad + rows[:40], 10, 4, shard_rows=60, query_block=9)
    wanted = brute(rows, [i for i, _ in rows if i % 10 == 0], 4)
    assert set(got) == set(wanted)
    for q, found in wanted.items():
        assert [i for i, _ in got[q]] == [i for i, _ in found]
        assert np.allclose([s for _, s in got[q]], [s for _, s in found], rtol=0, atol=1e-15)


@pytest.mark.parametrize("shape", ["isotropic", "clustered"])
def test_recall_over_shards(spark, shape):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 32))
    if shape == "clustered":
        x = rng.normal(size=(20, 32))[rng.integers(0, 20, 4000)] * rng.uniform(0.1, 9, (4000, 1)) + 0.05 * x
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000 + i, x[7].tolist()) for i in range(2000)]
    got, wanted = search(spark, rows, 50, 5, shard_rows=1500), brute(rows, range(0, 4000, 50), 5)
    assert recall(got, {q: w for q, w in wanted.items()}) >= 0.95
    assert got[9000] == brute(rows, [9000], 5)[9000] and [i for i, _ in got[9000]] == [7, 9001, 9002, 9003, 9004]


def test_recall_on_the_given_vectors(spark):
    from distaff.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    table = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {}
    for r in sorted(QUERIES["op13_ann"](spark, sf).collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    wanted = brute(table, [i for i, _ in table if i % 50 == 0], 5)
    assert set(got) == set(wanted) and recall(got, wanted) >= 0.97
    assert all(len(v) == 5 for v in got.values())


def test_few_rows_unequal_lengths_and_none(spark):
    got = search(spark, [(0, [1.0]), (1, [3.0, 4.0]), (2, [-1e-30, 0.0])], 50, 5)
    assert [i for i, _ in got[0]] == [1, 2] and np.allclose([s for _, s in got[0]], [0.6, -1.0], atol=1e-15)
    assert search(spark, [(0, [1.0])], 50, 5) == {} and search(spark, [], 50, 5) == {}
    assert search(spark, [(0, [1.0, 1.0]), (0, [1.0, 0.0]), (3, [0.0, 1.0])], 50, 5)[0] == [(3, pytest.approx(2**-0.5)), (3, 0.0)]


def test_pruning_keeps_what_no_nearer_neighbour_stands_for():
    rng = np.random.default_rng(2)
    units = pg.unit_rows(rng.normal(size=(60, 8)))
    points = np.array([0, 5, 9], dtype=np.int32)
    ids = np.array([rng.permutation(60)[:40] for _ in points], dtype=np.int32)
    ids[0, :7] = -1
    distance = lambda a, b: 2 - 2 * float(units[a] @ units[b])
    for point, given, kept in zip(points, ids, pg.robust_prune(units, points, ids, 6, 1.2)):
        left, wanted = sorted((i for i in given if i >= 0 and i != point), key=lambda i: distance(point, i)), []
        while left and len(wanted) < 6:
            wanted.append(int(left[0]))
            left = [i for i in left if 1.44 * distance(wanted[-1], i) > distance(point, i)]
        assert [int(i) for i in kept if i >= 0] == wanted


def test_every_node_is_reached_and_lists_are_bounded():
    units = pg.unit_rows(np.random.default_rng(3).normal(size=(1500, 16)))
    edges, start = pg.build_graph(units, degree=8, beam=24)
    assert edges.shape == (1500, 16) and all(len(set(e[e >= 0])) == (e >= 0).sum() for e in edges)
    seen, front = {start}, [start]
    while front:
        front = [int(j) for i in front for j in edges[i] if j >= 0 and int(j) not in seen]
        seen.update(front)
    assert len(seen) >= 1495


def test_tiny_and_huge_components():
    assert np.allclose(pg._exact(np.array([[1e-300, 1e-300]]), np.array([[1e300, 0.0]])), 2**-0.5)
    assert np.allclose(pg.unit_rows(np.array([[1e-300, 0.0], [3e300, 4e300]])), [[1, 0], [0.6, 0.8]])
