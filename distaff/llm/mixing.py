"""Mixing sources to target weights by subset sums.

A source gives whole rounds of its documents and, for what is then missing,
documents chosen by their exact length: lengths are counted, every length
first gives its share of the rest, and a bounded knapsack over the remaining
counts fits what the shares leave open. Which documents of a length are taken
follows a seeded order.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distaff.operators.ordering import dense_index
from distaff.session import materialise

WEIGHTS = (5, 2, 1)
SHARE, REPEATS, SEED = 1.5, 2, 17
#: Words the dynamic programme may be asked to fit; more are first filled greedily.
KNAPSACK_WORDS = 1 << 16
#: A length's documents are cut by seeded hash into so many parts; only the
#: part that holds the cut is ranked.
PARTS = 1 << 12


def word_count(text: Column) -> Column:
    """Number of runs of other characters than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and divide
    ``share`` of all sizes; no target exceeds ``repeats`` times its source's
    size, the excess being reshared by weight among the others until none is
    above. Each round is one aggregate of the source table.
    """
    ranked = dense_index(sizes, F.col("source").asc_nulls_last(), name="rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = materialise(ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * repeats).cast("double").alias("cap")), "sources")
    budget = share * float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        capped = F.col("cap") <= F.col("w") * level
        n, taken, weight_left = table.agg(
            F.count(F.when(capped, 1)),
            F.sum(F.when(capped, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("w"))),
        ).first()
        if n == full or not weight_left:
            break
        full, level = n, (budget - taken) / weight_left
    return table.select("source", "source_size", F.least("cap", F.col("w") * F.lit(level)).alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, limit: int = KNAPSACK_WORDS) -> np.ndarray:
    """How many of each length to take so that their sum is as near to ``budget`` as found.

    ``lengths`` are positive and distinct. Shares are taken first, then the
    longest lengths while more than ``limit`` words are missing; the rest is
    a bounded knapsack, solved exactly.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(lengths), dtype=np.int64)
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts.tolist()], dtype=np.int64)
    left = budget - int((lengths * taken).sum())
    order = np.argsort(-lengths)
    for i in order:
        if left <= limit:
            break
        more = min(int(counts[i] - taken[i]), (left - limit // 2) // int(lengths[i]))
        if more > 0:
            taken[i] += more
            left -= more * int(lengths[i])
    return taken + _knapsack(lengths, counts - taken, left)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Exact bounded knapsack: the sum nearest to ``budget``, of two the lower.

    Reachable sums are the bits of one integer. Counts are split by powers of
    two; for every sum the first item that reaches it is kept, so the choice
    can be read back.
    """
    out = np.zeros(len(lengths), dtype=np.int64)
    if budget <= 0:
        return out
    usable = np.flatnonzero(counts > 0)
    if not len(usable):
        return out
    top = budget + int(lengths[usable].min())  # one more of the shortest may come nearer
    mask = (1 << (top + 1)) - 1
    reached = 1
    first = np.full(top + 1, -1, dtype=np.int64)
    items: list[tuple[int, int]] = []
    for i in usable.tolist():
        rest, size = min(int(counts[i]), top // int(lengths[i])), 1
        while rest > 0:
            n = min(size, rest)
            fresh = (reached << (n * int(lengths[i]))) & mask & ~reached
            if fresh:
                bits = np.unpackbits(np.frombuffer(fresh.to_bytes(top // 8 + 1, "little"), np.uint8), bitorder="little")
                first[np.flatnonzero(bits)] = len(items)
                reached |= fresh
            items.append((i, n))
            rest -= n
            size *= 2
        if reached >> budget & 1:
            break
    sums = np.flatnonzero(np.unpackbits(np.frombuffer(reached.to_bytes(top // 8 + 1, "little"), np.uint8), bitorder="little"))
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at > 0:  # an earlier item reached what is left without this one
        i, n = items[first[at]]
        out[i] += n
        at -= n * int(lengths[i])
    return out


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, copies, taken) for every row.

    ``docs`` has (doc_id, text, source); other columns are ignored. ``size``
    is the number of words, null texts having none; null sources are one
    source. A document is taken ``copies`` times, at most ``repeats``;
    ``taken`` is ``copies`` times its size. Documents without words are never
    taken. Equal rows may differ in ``copies``, not in how many of them have
    which. The same rows and seed give the same mix.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = materialise(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.xxhash64(text).alias("text_hash"),
            F.col("source").cast("string").alias("source"),
            word_count(text).alias("size"),
        ).withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "text_hash")),
        "sizes",
    )
    targets = materialise(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats), "targets")
    part = F.pmod("draw", F.lit(PARTS)).cast("int")
    counted = rows.filter("size > 0").groupBy("source", "size", part.alias("part")).agg(F.count("*").alias("n"))
    lengths = counted.groupBy("source", "size").agg(F.sum("n").alias("n"))

    def plan(table: pd.DataFrame) -> pd.DataFrame:
        size, target = int(table["source_size"].iloc[0]), float(table["target"].iloc[0])
        rounds = min(int(target // size), repeats)
        budget = round(target) - rounds * size if rounds < repeats else 0
        more = fit_budget(table["size"].to_numpy(np.int64), table["n"].to_numpy(np.int64), budget)
        return table[["source", "size"]].assign(rounds=rounds, more=more)

    same_source = F.col("l.source").eqNullSafe(F.col("t.source"))
    asked = lengths.alias("l").join(targets.alias("t"), same_source).select("l.source", "size", "n", "source_size", "target")
    planned = asked.groupBy("source").applyInPandas(plan, "source string, size bigint, rounds int, more bigint")
    planned = materialise(planned, "mix-plan")
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cuts = counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    parts = (
        cuts.alias("c")
        .join(planned.alias("p"), F.col("c.source").eqNullSafe(F.col("p.source")) & (F.col("c.size") == F.col("p.size")))
        .select("c.source", "c.size", "part", "rounds", F.least(F.greatest(F.col("more") - F.col("before"), F.lit(0)), F.col("n")).alias("chosen"), "n")
    )
    placed = rows.withColumn("part", part).alias("r").join(
        parts.alias("q"),
        F.col("r.source").eqNullSafe(F.col("q.source")) & (F.col("r.size") == F.col("q.size")) & (F.col("r.part") == F.col("q.part")),
        "left",
    ).select("r.doc_id", "r.text_hash", "r.source", "r.size", "r.draw", "r.part", "rounds", "chosen", "n")
    cut = (F.col("chosen") > 0) & (F.col("chosen") < F.col("n"))
    ranked = Window.partitionBy("source", "size", "part").orderBy("draw", "doc_id", "text_hash")
    inside = placed.filter(cut).withColumn("extra", (F.row_number().over(ranked) <= F.col("chosen")).cast("int"))
    outside = placed.filter(~F.coalesce(cut, F.lit(False))).withColumn("extra", F.coalesce((F.col("chosen") == F.col("n")).cast("int"), F.lit(0)))
    copies = F.coalesce(F.col("rounds"), F.lit(0)) + F.col("extra")
    chosen = inside.unionByName(outside).withColumn("copies", copies)
    return chosen.alias("m").join(targets.alias("t"), F.col("m.source").eqNullSafe(F.col("t.source"))).select(
        "doc_id", "text_hash", "m.source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
