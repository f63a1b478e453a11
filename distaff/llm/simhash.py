"""SimHash near-duplicates by a binary trie self-join.

Two fingerprints of 64 bits that differ in at most three agree in one of four
16-bit blocks. Rotated so that this block comes first, both lie below the same
node of a binary trie at depth 16; from there the trie is joined with itself:
pairs of nodes go down together, bit by bit, carrying the bits that differ so
far, and are dropped once these exceed three.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distaff.llm.common import ROW_HASH, ROW_ID, in_slices, keyed_texts
from distaff.llm.components import connected_components
from distaff.session import materialise

BITS, BLOCKS, MAX_BITS, SEED = 64, 4, 3, 42
BLOCK_BITS = BITS // BLOCKS
#: Fingerprints below one node at depth 16 that one task joins; more are cut
#: into pairs of sub-tries SPLIT_BITS deeper. GROUP: what a task of small ones gets.
SUB_TRIE, GROUP = 20_000, 2_000
SPLIT_BITS = 6
#: Node pairs that are taken down together.
FRONTIER = 100_000


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of the ``shingle``-word shingles, repeats included; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)),
        dtype=np.uint64,
        count=len(words) - k + 1,
    )
    bits = np.zeros(BITS, dtype=np.int64)
    for part in np.array_split(hashes, len(hashes) // 65_536 + 1):
        bits += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"]
            )

    return keyed_texts(docs).mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def trie_pairs(
    left: np.ndarray, right: np.ndarray | None, depth: int, budget: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of all pairs within ``budget`` differing bits that agree above ``depth``.

    Both arrays are sorted, distinct unsigned longs; ``right`` None joins
    ``left`` with itself, i < j. A node is a range of the sorted array. Node
    pairs go down one bit at a time, at most FRONTIER together; a pair of
    single fingerprints is settled by counting its bits.
    """
    same = right is None
    other = left if same else right
    shift = np.uint64(BITS - depth)
    heads = [np.flatnonzero(np.r_[True, np.diff(rows >> shift) != 0]) if len(rows) else np.empty(0, int) for rows in (left, other)]
    ends = [np.r_[h[1:], len(rows)] for h, rows in zip(heads, (left, other), strict=True)]
    _, ours, theirs = np.intersect1d(left[heads[0]] >> shift, other[heads[1]] >> shift, return_indices=True)
    begun = [heads[0][ours], ends[0][ours], heads[1][theirs], ends[1][theirs], np.zeros(len(ours), dtype=np.int64)]
    waiting = [(depth, np.stack(begun, axis=1).astype(np.int64))]
    while waiting:
        depth, frontier = waiting.pop()
        if len(frontier) > FRONTIER:
            waiting += [(depth, half) for half in np.array_split(frontier, 2)]
            continue
        single = (frontier[:, 1] - frontier[:, 0] == 1) & (frontier[:, 3] - frontier[:, 2] == 1)
        i, j = frontier[single, 0], frontier[single, 2]
        near = np.bitwise_count(left[i] ^ other[j]) <= budget
        if same:
            near &= i < j
        if near.any():
            yield i[near], j[near]
        a0, a1, b0, b1, diff = frontier = frontier[~single].T
        if not frontier.size:
            continue
        bit = np.uint64(BITS - 1 - depth)
        am, bm = (
            np.clip(np.searchsorted(rows, (rows[lo] >> bit | np.uint64(1)) << bit), lo, hi)
            for rows, lo, hi in ((left, a0, a1), (other, b0, b1))
        )
        below = np.concatenate(
            [
                np.stack([a0, am, b0, bm, diff], axis=1),
                np.stack([am, a1, bm, b1, diff], axis=1),
                np.stack([a0, am, bm, b1, diff + 1], axis=1),
                np.stack([am, a1, b0, bm, diff + 1], axis=1),
            ]
        )
        keep = (below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3]) & (below[:, 4] <= budget)
        if same:  # of two mirrored pairs one is enough
            keep &= below[:, 0] <= below[:, 2]
        waiting.append((depth + 1, below[keep]))


def _hook(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (smallest position reached so far) after linking i with j."""
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            return root


def linked_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, sub_trie: int = SUB_TRIE) -> DataFrame:
    """Edges (u, v) between distinct ``fp`` that keep every link's connection.

    A task joins one sub-trie and sends, for each fingerprint that has a link
    there, one edge to the smallest one it reaches in it, so dense groups give
    as many edges as fingerprints. Small sub-tries share a task; one with more
    than ``sub_trie`` fingerprints is dealt as pairs of its own sub-tries
    within the budget, each a task of its own.
    """
    if max_bits >= BLOCKS:
        raise ValueError(f"max_bits must be below {BLOCKS}")
    rotated = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(r).alias("r"),
                    (F.expr(f"shiftleft(fp, {r * BLOCK_BITS})").bitwiseOR(F.expr(f"shiftrightunsigned(fp, {BITS - r * BLOCK_BITS})")) if r else F.col("fp")).alias("x"),
                )
                for r in range(BLOCKS)
            ]
        )
    )
    distinct = fps.select("fp").distinct()
    groups = min(1 << BLOCK_BITS, 1 << (distinct.count() // GROUP).bit_length())
    placed = distinct.select(rotated.alias("p")).select(
        "p.r", "p.x", F.expr(f"shiftrightunsigned(p.x, {BITS - BLOCK_BITS})").alias("block")
    )
    large = placed.groupBy("r", "block").count().filter(F.col("count") > sub_trie).select("r", "block", F.lit(True).alias("large"))
    parts = 1 << SPLIT_BITS
    part = F.expr(f"CAST(shiftrightunsigned(x, {BITS - BLOCK_BITS - SPLIT_BITS}) & {parts - 1} AS INT)")
    partners = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda y: F.when(F.bit_count(F.col("part").bitwiseXOR(y)) <= max_bits, y)),
        lambda y: y.isNotNull(),
    )
    whole = F.array(F.lit(-1))
    dealt = (
        placed.join(large, ["r", "block"], "left")
        .withColumn("part", F.when(F.col("large"), part).otherwise(F.lit(-1)))
        .withColumn("partner", F.explode(F.when(F.col("large"), partners).otherwise(whole)))
        .select(
            "r",
            F.when(F.col("large"), F.col("block")).otherwise(F.floor(F.col("block") * groups / (1 << BLOCK_BITS))).alias("node"),
            F.least("part", "partner").alias("a"),
            F.greatest("part", "partner").alias("b"),
            "x",
            "part",
        )
    )

    def join(key: tuple, table: pa.Table) -> pa.Table:
        r, _, a, b = (k.as_py() for k in key)
        part, x = table["part"].to_numpy(), table["x"].to_numpy().view(np.uint64)
        if a == b:
            rows, pairs, offset = (every := np.sort(x)), trie_pairs(every, None, BLOCK_BITS, max_bits), 0
        else:
            left, right = np.sort(x[part == a]), np.sort(x[part == b])
            rows, pairs, offset = np.concatenate([left, right]), trie_pairs(left, right, BLOCK_BITS, max_bits), len(left)
        root = np.arange(len(rows))
        for i, j in pairs:
            root = _hook(root, i, j + offset)
        moved = np.flatnonzero(root != np.arange(len(rows)))
        back = rows
        if r:
            back = (rows >> np.uint64(r * BLOCK_BITS)) | (rows << np.uint64(BITS - r * BLOCK_BITS))
        return pa.table({"u": back[moved].view(np.int64), "v": back[root[moved]].view(np.int64)})

    return dealt.groupBy("r", "node", "a", "b").applyInArrow(join, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest id in the component of fingerprints that
    link at ``max_bits`` or fewer differing bits; a component of null ids only
    has a null one. Null and empty texts have fingerprint 0 and link like any
    other. Copies are one fingerprint throughout; other columns are ignored.
    """
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = connected_components(linked_fingerprints(rows, max_bits))
    rooted = least.join(classes, least["fp"] == classes["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    rooted = materialise(rooted, "fingerprint-roots")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without all but one document of each component.

    The smallest id stays; rows that share it differ by text hash, and of rows
    equal in both one stays. Rows with a null id come last in their component.
    """
    found = near_duplicates(docs, shingle, max_bits)
    copies = found.groupBy("root", "doc_id", "text_hash").count()
    best = materialise(
        copies.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "count")).alias("b"))
        .select("b.doc_id", "b.text_hash", "b.count"),
        "representatives",
    )
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    texts = docs.withColumns({ROW_ID: F.col("doc_id").cast("bigint"), ROW_HASH: text_hash})

    def rows_of(chosen: DataFrame) -> DataFrame:
        match = texts[ROW_ID].eqNullSafe(chosen["doc_id"]) & (texts[ROW_HASH] == chosen["text_hash"])
        return texts.join(chosen, match, "left_semi")

    alone = rows_of(best.filter("count = 1"))
    repeated = rows_of(best.filter("count > 1")).dropDuplicates([ROW_ID, ROW_HASH])
    return alone.unionByName(repeated).drop(ROW_ID, ROW_HASH)
