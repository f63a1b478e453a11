"""What each of five document filters removes in every order of applying them.

A document is its mask of failed filters. All orders of the filters stand in
lexicographic order, numbered by their Lehmer code. A mask is removed at step
s by filter f in exactly those orders that begin with s - 1 filters it passes
and then f, and orders with one beginning are an interval of ranks. So counts
are added at the ends of a few intervals, and a prefix sum over the ranks gives
what every step of every order removes.
"""

from collections.abc import Iterable, Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
STEPS = len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ["n", "good", "toxic"]


def removal_intervals(mask: int) -> list[tuple[int, int, int]]:
    """(step, start, stop): ranks of the orders in which a document with this mask goes at that step.

    Steps count from 0. Bit i of ``mask`` is filter i. The mask 0 stays in every order.
    """
    found = []

    def walk(step: int, rank: int, unused: list[int]) -> None:
        below = factorial(STEPS - 1 - step)
        for digit, f in enumerate(unused):
            start = rank + digit * below
            if mask >> f & 1:
                found.append((step, start, start + below))
            else:
                walk(step + 1, start, unused[:digit] + unused[digit + 1 :])

    if mask:
        walk(0, 0, list(range(STEPS)))
    return found


def removed_by_rank(counts: np.ndarray) -> np.ndarray:
    """[part, measure, step, rank] from counts [part, measure, mask]."""
    ends = np.zeros((*counts.shape[:2], STEPS, len(ORDERS) + 1), dtype=np.int64)
    for mask in range(1, 1 << STEPS):
        for step, start, stop in removal_intervals(mask):
            ends[:, :, step, start] += counts[:, :, mask]
            ends[:, :, step, stop] -= counts[:, :, mask]
    return ends.cumsum(axis=3)[..., :-1]


def audit_rows(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Columns [part, rank, step] of the audit from counts [part, measure, mask]."""
    removed = removed_by_rank(counts).transpose(0, 1, 3, 2)
    n, good, toxic = removed[:, 0], removed[:, 1], removed[:, 2]
    used = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
    masks = np.arange(1 << STEPS)
    fails = np.stack([counts[:, 0, masks >> f & 1 == 1].sum(axis=1) for f in range(STEPS)], axis=1)
    alone = counts[:, 0, [1 << f for f in range(STEPS)]]
    total = np.stack([np.where(used == f, n, 0).sum(axis=(1, 2)) for f in range(STEPS)], axis=1)
    return {
        "kept": counts[:, 0].sum(axis=1)[:, None, None] - n.cumsum(axis=2),
        "removed": n,
        "redundant": fails[:, used] - n,
        "unique_fails": alone[:, used],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": total[:, used],
    }


def own_failures(text: Column) -> Column:
    """Bits A to D of a text; copies have the same."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))
    n = F.size(words)
    failed = [
        n < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failed)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each source by the filters they fail.

    Only hashes and masks are shuffled. Equal rows are counted before each
    shuffle and the smallest id of a text comes from partial aggregates, so a
    text that a third of all rows share moves as a few rows. Nothing is joined
    by text: copies have the same bits A to D, so the last window sees one row
    for each source, label and text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        own_failures(text).cast("int").alias("own"),
    )
    rows = rows.groupBy("doc_id", "part", "digest", "own").agg(F.count("*").alias("c"))
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    known = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    rows = rows.join(marks, "doc_id", "left").select("doc_id", "part", "digest", "own", "c", known("good"), known("toxic"))
    by_text = rows.groupBy("digest", "part", "own", "good", "toxic").agg(
        F.sum("c").alias("c"),
        F.min("doc_id").alias("least"),
        F.coalesce(F.min_by("c", "doc_id"), F.lit(0)).alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("c"))), F.lit(0)).alias("nameless"),
    )
    least = F.min("least").over(Window.partitionBy("digest"))
    first = F.when(F.col("least") == least, F.col("at_least")).otherwise(0) + F.col("nameless")
    split = by_text.withColumn("first", first).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct(F.col("own").alias("mask"), F.col("first").alias("n")),
                F.struct((F.col("own") + (1 << 4)).alias("mask"), (F.col("c") - F.col("first")).alias("n")),
            )
        ).alias("x"),
    )
    n = F.col("x.n")
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum(n).alias("n"),
        F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row for each source, order of the filters A to E and step. A: under
    200 words; B: under half of the words distinct; C: over 2 % of the code
    points in A-Z; D: any of ``#$%&*|``; E: a smaller ``doc_id`` has the same
    text.

    Null texts are empty, null sources the part ''. A null ``doc_id`` has no
    label, is smaller than none and has none smaller, so it passes E; rows that
    share the smallest id of their text pass it all. Repeated rows count as
    often as they occur. Where labels repeat an id, one that says 1 is enough.
    Texts of any length are read whole. No documents, no rows. Other columns
    are ignored.
    """
    counts = mask_counts(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("mask", *MEASURES)).alias("counts")
    )

    def audit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                piece = batch.slice(start, 200)
                parts, lists = piece["part"], piece["counts"]
                flat = lists.flatten()
                of = np.repeat(np.arange(len(parts)), lists.value_lengths().to_numpy())
                table = np.zeros((len(parts), len(MEASURES), 1 << STEPS), dtype=np.int64)
                for i, measure in enumerate(MEASURES):
                    table[of, i, flat.field("mask").to_numpy()] = flat.field(measure).to_numpy()
                columns = {name: values.ravel() for name, values in audit_rows(table).items()}
                rows = len(ORDERS) * STEPS
                yield pa.record_batch(
                    {
                        "part": parts.take(pa.array(np.repeat(np.arange(len(parts)), rows))),
                        "filter_order": pa.array([o for _ in range(len(parts)) for o in ORDERS for _ in range(STEPS)]),
                        "step": np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(parts) * len(ORDERS)),
                        **columns,
                    }
                )

    longs = ", ".join(f"{c} bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return counts.mapInArrow(audit, f"part string, filter_order string, step int, {longs}")
