"""Top-n rows, dense numbering and neighbours without a one-task sort."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from distaff.session import MAX_SLICE, materialise

TASKS_PER_MERGE = 256


def head_slice(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows in ``order`` (which must be total to be repeatable).

    A plain ``orderBy.limit`` sends n rows of every input partition to one
    task. The extra level keeps the best n of each group of partitions
    first; the rank limit runs inside the map tasks as well. More than
    ``MAX_SLICE`` rows are refused, since that limit stops there.
    """
    if n > MAX_SLICE:
        raise ValueError(f"a head slice has at most {MAX_SLICE} rows")
    groups = F.floor(F.spark_partition_id() / TASKS_PER_MERGE)
    best = Window.partitionBy("_group").orderBy(*order)
    return (
        df.withColumn("_group", groups)
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= n)
        .drop("_group", "_rank")
        .orderBy(*order)
        .limit(n)
    )


def dense_index(df: DataFrame, *order, name: str = "position") -> DataFrame:
    """Number all rows 0, 1, 2, … in ``order``.

    A distributed sort tags each row with its partition and its place there;
    the tagged rows are written once so that counting and numbering see the
    same partitions; every partition's start is the sum of the counts before
    it. The start table has one row per shuffle partition, which is the
    bound that makes broadcasting it safe.
    """
    placed = materialise(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "dense-index"
    )
    part = F.shiftright("_place", 33)
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + within)
        .drop("_place", "_part", "_start")
    )


def stable_index(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    """Position of each row in key order."""
    return dense_index(df, F.col(key), name=name)


def micro_batches(df: DataFrame, size: int, drop_last: bool, *order) -> DataFrame:
    """Consecutive batches of ``size`` rows; an incomplete last one may go."""
    numbered = dense_index(df, *order)
    batch = F.floor(F.col("position") / size).alias("batch_id")
    batched = numbered.select("*", batch, (F.col("position") % size).alias("slot"))
    if not drop_last:
        return batched
    rows = numbered.agg(F.max("position").alias("last")).scalar()
    complete = F.floor((rows + 1) / size)
    return batched.filter(F.col("batch_id") < complete)


def previous_value(
    df: DataFrame, group: str, order: str, chunk: int, name: str = "previous"
) -> DataFrame:
    """Previous ``order`` value inside each group, for integer orders.

    A group may hold a third of all rows, so the window runs inside chunks
    of ``chunk`` order values; the first row of a chunk takes the maximum of
    the group's last non-empty chunk before it.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    inside = Window.partitionBy(group, "_chunk").orderBy(order)
    across = Window.partitionBy(group).orderBy("_chunk")
    ends = (
        chunked.groupBy(group, "_chunk")
        .agg(F.max(order).alias("_end"))
        .select(group, "_chunk", F.lag("_end").over(across).alias("_carried"))
    )
    return (
        chunked.withColumn("_lag", F.lag(order).over(inside))
        .join(ends, [group, "_chunk"])
        .withColumn(name, F.coalesce("_lag", "_carried"))
        .drop("_chunk", "_lag", "_carried")
    )


#: How what a group's earlier partitions carry joins what its own has so far.
CARRY = {
    "sum": (F.sum, lambda carried, inside: F.coalesce(carried, F.lit(0)) + F.coalesce(inside, F.lit(0))),
    "max": (F.max, F.greatest),
}


def running(df: DataFrame, by: list[str], order: list, values: dict[str, tuple[str, object]]) -> DataFrame:
    """Add sums or maxima over the rows before each row of its group.

    ``values`` gives ``name: ("sum" or "max", column)``. ``order`` are any
    sortable columns, nulls first; rows equal in all of them follow each other
    as they were read. The rows are range sorted once by group and order, and
    written, so that retries cannot place them anew. A window then spans one
    group's rows in one range partition, however large the group, and adds the
    end values of that group's partitions before it; of those there is one row
    for each partition a group lies in. Sums of no rows are 0, maxima null.
    """
    placed = materialise(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .orderBy(*by, *order, "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id()),
        "running",
    ).withColumn("_part", F.shiftright("_place", 33))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy("_part", *by).agg(*[CARRY[kind][0](c).alias(f"_end_{n}") for n, (kind, c) in values.items()])
    carried = ends.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)],
        *[CARRY[kind][0](f"_end_{n}").over(before(*by).orderBy("_part")).alias(f"_end_{n}") for n, (kind, _) in values.items()],
    )
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & placed[c].eqNullSafe(F.col(f"_by_{i}"))
    here = before("_part", *by).orderBy("_place")
    inside = placed.withColumns({f"_in_{n}": CARRY[kind][0](c).over(here) for n, (kind, c) in values.items()})
    joined = inside.join(carried, same)
    return joined.select(
        *df.columns, *[CARRY[kind][1](F.col(f"_end_{n}"), F.col(f"_in_{n}")).alias(n) for n, (kind, _) in values.items()]
    )


def sorted_rows(df: DataFrame, key: str) -> DataFrame:
    """Deterministic listing by key."""
    return df.orderBy(key)
