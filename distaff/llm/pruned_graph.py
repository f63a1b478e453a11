"""Approximate nearest neighbours by cosine over robust-pruned directed graphs.

The distinct vectors are dealt into shards. Each shard grows one directed
graph: a greedy search from a central node proposes neighbours of the next
vectors, and a relaxed distance rule keeps those that no nearer kept neighbour
stands for, so the edges point in diverse directions. Queries walk every
shard's graph with a beam and the beams' ends are scored again exactly.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from distaff.session import materialise

DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
RELAXED = 1.2
WIDTH = 4
SHARD_ROWS = 8192
QUERY_BLOCK = 16384
CELLS = 1 << 23


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in single precision; scaled first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=0.0)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def beam_search(
    units: np.ndarray, edges: np.ndarray, start: int, asked: np.ndarray, beam: int, width: int = WIDTH
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and similarities [asked, beam] of the best nodes that a walk from ``start`` meets.

    All walks go on side by side: in each step every walk opens its ``width``
    best unopened nodes, and ends when its whole beam is open. Unused places
    of a beam have id -1.
    """
    n, m = len(units), len(asked)
    ids = np.full((m, beam), -1, dtype=np.int32)
    sims = np.full((m, beam), -np.inf, dtype=np.float32)
    opened = np.ones((m, beam), dtype=bool)
    ids[:, 0], sims[:, 0], opened[:, 0] = start, asked @ units[start], False
    seen = np.zeros((m, n), dtype=bool)
    seen[:, start] = True
    place = np.zeros((m, n), dtype=np.int16)
    live = np.arange(m)
    while True:
        waiting = np.where(opened[live], -np.inf, sims[live])
        live = live[waiting.max(axis=1) > -np.inf]
        if not len(live):
            return ids, sims
        waiting = waiting[waiting.max(axis=1) > -np.inf]
        pick = np.argpartition(-waiting, min(width, beam) - 1, axis=1)[:, :width]
        valid = np.take_along_axis(waiting, pick, axis=1) > -np.inf
        opened[live[:, None], pick] = True
        met = np.where(valid[:, :, None], edges[ids[live[:, None], pick]], -1).reshape(len(live), -1)
        row, column = np.nonzero(met >= 0)
        node = met[row, column]
        fresh = ~seen[live[row], node]
        row, column, node = row[fresh], column[fresh], node[fresh]
        place[live[row], node] = column
        once = place[live[row], node] == column
        row, column, node = row[once], column[once], node[once]
        seen[live[row], node] = True
        found = np.full(met.shape, -np.inf, dtype=np.float32)
        found[row, column] = np.einsum("ij,ij->i", asked[live[row]], units[node])
        both = np.concatenate([sims[live], found], axis=1)
        best = np.argpartition(-both, beam - 1, axis=1)[:, :beam]
        sims[live] = np.take_along_axis(both, best, axis=1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], met], axis=1), best, axis=1)
        opened[live] = np.take_along_axis(np.pad(opened[live], ((0, 0), (0, met.shape[1]))), best, axis=1)
        ids[sims == -np.inf] = -1
        opened[sims == -np.inf] = True


def robust_prune(
    units: np.ndarray, points: np.ndarray, ids: np.ndarray, degree: int, relaxed: float = RELAXED
) -> np.ndarray:
    """Up to ``degree`` of each point's candidates ``ids`` (-1: none), nearest first, -1 beyond.

    The nearest candidate is kept and strikes out all that are nearer to it,
    ``relaxed`` times, than to the point; then the next one left.
    """
    kept = np.full((len(points), degree), -1, dtype=np.int32)
    step = max(1, CELLS // ids.shape[1] ** 2)
    for at in range(0, len(points), step):
        mine, cand = points[at : at + step], ids[at : at + step]
        alive = (cand >= 0) & (cand != mine[:, None])
        near = units[cand]
        own = np.where(alive, 2 - 2 * np.einsum("ijk,ik->ij", near, units[mine]), np.inf)
        order = np.argsort(own, axis=1, kind="stable")
        own, cand, alive = (np.take_along_axis(x, order, axis=1) for x in (own, cand, alive))
        near = near[np.arange(len(mine))[:, None], order]
        between = np.float32(relaxed**2) * (2 - 2 * (near @ near.transpose(0, 2, 1)))
        count = np.zeros(len(mine), dtype=np.int64)
        for i in range(cand.shape[1]):
            row = np.flatnonzero(alive[:, i] & (count < degree))
            kept[at + row, count[row]] = cand[row, i]
            count[row] += 1
            alive[row] &= between[row, i] > own[row]
    return kept


def _link_back(units: np.ndarray, edges: np.ndarray, target: np.ndarray, source: np.ndarray, degree: int, relaxed: float) -> None:
    """Add the edges target -> source in place; a full list is pruned with what comes in."""
    cap = edges.shape[1]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    while len(target):
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        nth = np.arange(len(target)) - np.repeat(first, counts)
        now = nth < cap
        come = np.full((len(nodes), min(int(counts.max()), cap)), -1, dtype=np.int32)
        come[np.searchsorted(nodes, target[now]), nth[now]] = source[now]
        known = edges[nodes]
        come[(come[:, :, None] == known[:, None, :]).any(axis=2)] = -1
        size = (known >= 0).sum(axis=1)
        fits = size + (come >= 0).sum(axis=1) <= cap
        row, column = np.nonzero((come >= 0) & fits[:, None])
        rank = np.cumsum(come >= 0, axis=1)[row, column] - 1
        edges[nodes[row], size[row] + rank] = come[row, column]
        full = ~fits
        if full.any():
            pruned = robust_prune(units, nodes[full], np.concatenate([known[full], come[full]], axis=1), degree, relaxed)
            edges[nodes[full]] = np.pad(pruned, ((0, 0), (0, cap - degree)), constant_values=-1)
        target, source = target[~now], source[~now]


def build_graph(
    units: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED, batch: int = 512
) -> tuple[np.ndarray, int]:
    """Edges [n, 2 * degree] (-1: none) and the start node of the vectors' graph.

    Vectors enter in a seeded order, in batches of at most a quarter of those
    already there, so that each finds most of its neighbours in place.
    """
    n = len(units)
    edges = np.full((n, 2 * degree), -1, dtype=np.int32)
    start = int(np.argmax(units @ units.mean(axis=0)))
    order = np.random.default_rng(17).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at = 1
    while at < n:
        points = order[at : at + max(1, min(batch, at // 4))]
        ids, _ = beam_search(units, edges, start, units[points], beam)
        kept = robust_prune(units, points, ids, degree, relaxed)
        edges[points, :degree] = kept
        row, column = np.nonzero(kept >= 0)
        _link_back(units, edges, kept[row, column], points[row].astype(np.int32), degree, relaxed)
        at += len(points)
    return edges, start


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, vector) of the rows that take part.

    Rows with a null id or vector, and vectors that are zero or hold a null or
    non-finite component, are left out.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    rows = rows.filter(F.exists(x, lambda v: v != 0))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("vector")).distinct()


def _matrix(column: pa.ChunkedArray, width: int = 1) -> np.ndarray:
    """Rows of a list column, ending in zeros up to the longest or ``width``."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(rows), max(width, int(lengths.max(initial=0)))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = rows.flatten().to_numpy()
    return out


def _lists(values: np.ndarray) -> pa.ListArray:
    """Rows of a matrix without their -1 as a list column."""
    there = values >= 0
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32), values[there])


def build_index(
    vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED
) -> DataFrame:
    """(shard, node, start, ids, vector, edges): the graph of every shard, written to the shared folder.

    ``vectors`` are those of ``usable_vectors``. Equal vectors are one node
    that keeps their ``k + 1`` smallest ids, which is all that a search for
    ``k`` can return of them; the rank limit works before the shuffle, so a
    vector that a third of all rows share moves as a few rows. Shards are
    dealt by hash and grow in number only.
    """
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    nodes = vectors.withColumn("nth", F.row_number().over(smallest)).filter(F.col("nth") <= k + 1)
    nodes = materialise(nodes.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "distinct_vectors")
    shards = -(-nodes.count() // shard_rows) or 1
    dealt = nodes.select(F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), F.xxhash64(F.lit(1), "vector").alias("place"), "ids", "vector")

    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        edges, start = build_graph(unit_rows(_matrix(table["vector"])), degree, beam, relaxed)
        node = np.arange(len(table), dtype=np.int32)
        return pa.table(
            {"shard": table["shard"], "node": node, "start": node == start, "ids": table["ids"], "vector": table["vector"], "edges": _lists(edges)}
        )

    schema = "shard int, node int, start boolean, ids array<bigint>, vector array<double>, edges array<int>"
    return materialise(dealt.groupBy("shard").applyInArrow(grow, schema), "graph_index")


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision; rows are first scaled by powers of two, which loses nothing."""
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None]) for x in (a, b))
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


def search_shard(
    own: np.ndarray, asked: np.ndarray, vectors: np.ndarray, edges: np.ndarray, start: int, ids: pa.ListArray, k: int, beam: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec_id, cosine) of up to ``k`` candidates of each query, best first."""
    units, out = unit_rows(vectors), [[], [], []]
    sizes, offsets, flat = ids.value_lengths().to_numpy(), ids.offsets.to_numpy(), ids.flatten().to_numpy()
    step = max(1, CELLS // len(vectors))
    for at in range(0, len(asked), step):
        mine, exact = own[at : at + step], asked[at : at + step]
        found, sims = beam_search(units, edges, start, unit_rows(exact), beam)
        short = np.argsort(-sims, axis=1, kind="stable")[:, : 4 * (k + 1)]
        row, column = np.nonzero(np.take_along_axis(found, short, axis=1) >= 0)
        node = found[row, short[row, column]]
        score = _exact(exact[row], vectors[node])
        n = sizes[node]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row, score, vec_id = np.repeat(row, n), np.repeat(score, n), flat[np.repeat(offsets[node], n) + inner]
        other = vec_id != mine[row]
        row, score, vec_id = row[other], score[other], vec_id[other]
        order = np.lexsort((vec_id, -score, row))
        row, score, vec_id = row[order], score[order], vec_id[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        for values, part in zip(out, (mine[row], vec_id, score), strict=True):
            values.append(part[best])
    return tuple(np.concatenate([np.empty(0, t), *x]) for t, x in zip((np.int64, np.int64, np.float64), out, strict=True))


def nearest(
    queries: DataFrame, index: DataFrame, k: int = 5, beam: int = SEARCH_BEAM, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query, over an index built for that ``k``.

    ``queries`` are those of ``usable_vectors``; ``score`` is the cosine of the
    original vectors in double precision and equal ones go to smaller ids.
    Rows with the query's own ``vec_id`` are no candidates; rows equal in id
    and vector count once; different vectors that share an id are candidates
    of their own, and as queries share one ranking. Fewer candidates than
    ``k``: all that the walks meet, which is all of a shard not larger than
    the beam. Vectors of unequal length are compared as if the shorter one
    ended in zeros. No queries or an empty index, no rows.

    Every block of queries meets every shard once. A task holds one shard and
    one block, both bounded, and sends ``k`` rows for each query onward.
    """
    blocks = -(-queries.count() // query_block) or 1
    top = index.agg(F.max("shard")).first()[0]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select("*", every(blocks).alias("block"))
    right = queries.select(
        F.col("vec_id").alias("query_id"),
        F.col("vector").alias("asked"),
        F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block"),
        every(1 if top is None else top + 1).alias("shard"),
    )

    def search(graph: pa.Table, asked: pa.Table) -> pa.Table:
        found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        if graph.num_rows and asked.num_rows:
            graph = graph.sort_by("node")
            vectors = _matrix(graph["vector"])
            wanted = _matrix(asked["asked"], vectors.shape[1])
            vectors = np.pad(vectors, ((0, 0), (0, wanted.shape[1] - vectors.shape[1])))
            lists = graph["edges"].combine_chunks()
            edges = np.full((len(vectors), max(1, int(lists.value_lengths().to_numpy().max()))), -1, dtype=np.int32)
            edges[np.arange(edges.shape[1]) < lists.value_lengths().to_numpy()[:, None]] = lists.flatten().to_numpy()
            start = int(np.flatnonzero(graph["start"].to_numpy())[0])
            found = search_shard(asked["query_id"].to_numpy(), wanted, vectors, edges, start, graph["ids"].combine_chunks(), k, beam)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
