"""Exact top-k inner products by the threshold algorithm.

Queries meet the candidates in blocks: every block of candidates keeps one
sorted list of its vectors per dimension. A query reads all lists from the end
that its sign favours, scores each vector when any list first shows it, and
stops when even a vector standing at the read depth of every list at once
could not beat its k-th score. The longest vectors of all give every query a
k-th score to begin with, so that a block whose lists begin below it is not
read at all. A query that would be shown more than a small share of a block
has the rest of it scored by one matrix product with the other such queries.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIRST_DEPTH = 16
#: A block is read through its lists while they can have shown one row of this many.
READ_SHARE = 16
#: Longest candidates that are sent to every task.
SEEDS = 1024
#: Numbers in a block of candidates and of queries: the wider the vectors, the fewer.
BLOCK_CELLS = 1 << 20
QUERY_CELLS = 1 << 21
SCORES = 1 << 22
EXACT_IN_DOUBLE = 2**53


def integer_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, ints): floor(scale * component) of the usable rows.

    Rows whose id or vector is null, and vectors with a null or non-finite
    component, take no part.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(finite)
        .select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.transform(x, lambda v: F.floor(v * scale).cast("bigint")).alias("ints"),
        )
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column; shorter vectors end in zeros."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(rows), max(1, int(lengths.max(initial=0)))), dtype=np.int64)
    at = np.arange(out.shape[1]) < lengths[:, None]
    out[at] = rows.flatten().to_numpy()
    return out


def _lowest(dtype: np.dtype):
    return -np.inf if dtype.kind == "f" else np.iinfo(dtype).min


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best entries of each query; equal scores go to smaller ids."""
    order = np.lexsort((ids, -scores, query))
    sorted_query = query[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_query, sorted_query) < k]


def first_floor(own: np.ndarray, asked: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query among some candidates; the lowest number where they are fewer."""
    floor = np.full(len(asked), _lowest(asked.dtype), dtype=asked.dtype)
    if len(ids) >= k:
        step = max(1, SCORES // len(ids))
        for at in range(0, len(asked), step):
            scores = asked[at : at + step] @ rows.T
            scores[own[at : at + step, None] == ids] = _lowest(asked.dtype)
            floor[at : at + step] = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
    return floor


def threshold_search(
    own: np.ndarray, asked: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, vec_id, score) of the ``k`` best rows of each query that reach its ``floor``, and the rows read.

    ``query`` counts in ``asked``. Rows with the query's ``own`` id take no part.
    """
    n, width = rows.shape
    lists = np.ascontiguousarray(np.argsort(rows, axis=0, kind="stable").T.astype(np.int32))
    dims = np.arange(width)
    up, down = np.maximum(asked, 0), np.minimum(asked, 0)
    # What a vector could score that stands at this depth of every list.
    bound = lambda depth: up @ rows[lists[:, n - depth], dims] + down @ rows[lists[:, depth - 1], dims]
    floor = floor.copy()
    out, read = [], 0
    going = np.flatnonzero(bound(1) >= floor)
    depth = FIRST_DEPTH
    while len(going) and depth * width * READ_SHARE <= n:
        found = {}
        for q in going:
            favoured = np.concatenate([lists[asked[q] > 0, n - depth :].ravel(), lists[asked[q] < 0, :depth].ravel()])
            shown = np.unique(favoured)
            shown = shown[ids[shown] != own[q]]
            scores = rows[shown] @ asked[q]
            read += len(shown)
            best = _best(np.zeros(len(shown), np.int64), ids[shown], scores, k)
            found[q] = (ids[shown[best]], scores[best])
            if len(best) == k:
                floor[q] = max(floor[q], scores[best[-1]])
        # Nothing unseen reaches the floor any more; what ties with it has been seen.
        stopped = bound(depth)[going] < floor[going]
        out += [(np.full(len(found[q][0]), q), *found[q]) for q in going[stopped]]
        going, depth = going[~stopped], depth * 4
    step = max(1, SCORES // max(1, n))
    for at in range(0, len(going), step):
        part = going[at : at + step]
        scores = asked[part] @ rows.T
        read += scores.size
        query, row = np.nonzero((scores >= floor[part, None]) & (own[part, None] != ids))
        reached = scores[query, row]
        best = _best(query, ids[row], reached, k)
        out.append((part[query[best]], ids[row[best]], reached[best]))
    query, vec_id, score = (np.concatenate([np.empty(0, t), *x]) for t, x in zip((np.int64, np.int64, rows.dtype), zip(*out) if out else ((),) * 3))
    reaches = score >= floor[query.astype(np.int64)]
    return query[reaches].astype(np.int64), vec_id[reaches], score[reaches].astype(np.int64), read


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 20, query_block: int | None = None, block: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score) for every query.

    Both sides have (vec_id, ints). A row is never a candidate of a query with
    its own ``vec_id``; repeated query rows count once, different ones that
    share an id share one ranking, and repeated candidates count as often as
    they occur. Fewer candidates than ``k``: all. Vectors of unequal
    length are compared as if the shorter one ended in zeros. Blocks hold so
    many numbers and grow in number with the rows, so each (query block,
    candidate block) is a task of bounded size whatever the table; it sends at
    most ``k`` rows per query onward, and only those that reach the k-th score
    among the ``SEEDS`` longest candidates, which every task has.
    """
    queries = queries.distinct()
    asked_rows, asked_width = queries.agg(F.count("*"), F.coalesce(F.max(F.size("ints")), F.lit(1))).first()
    rows, width = candidates.agg(F.count("*"), F.coalesce(F.max(F.size("ints")), F.lit(1))).first()
    width = max(1, width, asked_width)
    n_q = -(-asked_rows // (query_block or max(1, QUERY_CELLS // width))) or 1
    n_c = -(-rows // (block or max(1, BLOCK_CELLS // width))) or 1
    length = F.aggregate("ints", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    longest = candidates.orderBy(length.desc(), "vec_id", "ints").limit(SEEDS).toArrow()
    seeds = candidates.sparkSession.sparkContext.broadcast((longest["vec_id"].to_numpy(), _matrix(longest["ints"])))
    key = F.xxhash64("vec_id", "ints")
    left = queries.select(
        F.col("vec_id").alias("query_id"),
        F.col("ints").alias("q"),
        F.pmod(key, F.lit(n_q)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("cb"),
    )
    # Equal vectors of one id may repeat without bound, so their number in the scan deals them too.
    right = candidates.select(
        "vec_id",
        "ints",
        F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n_c)).cast("int").alias("cb"),
        F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"),
    )

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        found = (np.empty(0, np.int64),) * 3
        if q.num_rows and c.num_rows:
            ids, rows, asked, own = c["vec_id"].to_numpy(), _matrix(c["ints"]), _matrix(q["q"]), q["query_id"].to_numpy()
            first_ids, first = seeds.value
            width = max(x.shape[1] for x in (rows, asked, first))
            rows, asked, first = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (rows, asked, first))
            largest = max(float(np.abs(rows).max()), float(np.abs(first).max(initial=0)))
            if largest * float(np.abs(asked).max()) * width < EXACT_IN_DOUBLE:
                rows, asked, first = (x.astype(np.float64) for x in (rows, asked, first))
            query, *best, _ = threshold_search(own, asked, ids, rows, k, first_floor(own, asked, first_ids, first, k))
            found = (own[query], *best)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    found = (
        left.groupBy("qb", "cb")
        .cogroup(right.groupBy("qb", "cb"))
        .applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
