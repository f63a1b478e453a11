"""Connected components by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distaff.session import materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v.

    Large: every node hands its smallest neighbour to its larger ones; small:
    to its smaller ones and itself. Minima are partial aggregates and the
    neighbours are joined, never collected, so a node that has a third of all
    edges is only a skewed join key.
    """
    seen = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = seen.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = seen.join(least, "u")
    if large:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter(F.col("u") > F.col("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge (u, v) with the smallest node it reaches.

    Each round is written to the shared folder and compared with the one
    before by its size and a hash of its edges; when neither star moves any
    edge, every node hangs on its root. The rounds grow with the logarithm of
    the longest path. Loops and repeated edges do not matter; no edges, no rows.
    """
    current = materialise(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "edges"
    )
    before = None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        current = materialise(_stars(_stars(current, large=True), large=False), "stars")
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
