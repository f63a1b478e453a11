"""Reading chat corpora and giving every row a stable identity."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN = T.StructType(
    [T.StructField("from", T.StringType()), T.StructField("value", T.StringType())]
)
CHAT_SCHEMA = T.StructType(
    [
        T.StructField("tools", T.StringType()),
        T.StructField("conversations", T.ArrayType(TURN)),
    ]
)
TEXT_SCHEMA = T.StructType([T.StructField("text", T.StringType())])


def content_hash(columns: list[Column]) -> Column:
    """SHA-256 over the columns: of the text itself, or of the row as JSON."""
    if len(columns) == 1:
        return F.coalesce(F.sha2(columns[0].cast("string"), 256), F.lit("null"))
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def with_example_id(df: DataFrame, content: Column, source: Column) -> DataFrame:
    """Add ``example_id``: content hash plus an occurrence rank for copies.

    Copies of one content may be a third of all rows, so they are numbered
    inside each ``source`` (a block of an input file, which bounds the group),
    and only contents that occur in several sources get an offset from the
    per-source counts. Equal rows are interchangeable, so any numbering gives
    the same table.
    """
    hashed = df.withColumn("_content", content).withColumn("_source", source)
    sources = hashed.groupBy("_content", "_source").agg(F.count("*").alias("_copies"))
    before = Window.partitionBy("_content").orderBy("_source").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        sources.withColumn("_offset", F.sum("_copies").over(before))
        .filter("_offset > 0")
        .select("_content", "_source", "_offset")
    )
    inside = Window.partitionBy("_content", "_source").orderBy("_content")
    return (
        hashed.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, ["_content", "_source"], "left")
        .withColumn(
            "example_id",
            F.concat_ws(
                "-", "_content", (F.col("_rank") + F.coalesce("_offset", F.lit(0))).cast("string")
            ),
        )
        .drop("_content", "_source", "_rank", "_offset")
    )


def read_chat_corpus(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    key: str | None = None,
    schema: T.StructType = CHAT_SCHEMA,
) -> DataFrame:
    """Read a chat or text corpus with a stable ``example_id``.

    ``key`` names the source's own unique column where it has one. Without
    it the id is built from the row's content.
    """
    if key is not None and key not in schema.fieldNames():
        schema = T.StructType([T.StructField(key, T.StringType()), *schema.fields])
    rows = spark.read.schema(schema).format(fmt).load(path)
    if key is not None:
        return rows.withColumn("example_id", F.col(key).cast("string"))
    columns = [F.col(name) for name in schema.fieldNames()]
    block = F.concat_ws(
        ":", F.col("_metadata.file_path"), F.col("_metadata.file_block_start").cast("string")
    )
    return with_example_id(rows, content_hash(columns), block)


def turns_to_conversations(turns: DataFrame) -> DataFrame:
    """All turns of long-form ``(conv_id, turn, role, text)``, in order.

    A conversation is one row of the data model, so its turns meet in one
    group. ``complete`` is false where turn numbers are missing, repeated or
    do not start at 0: there a later turn would pose as an earlier one.
    """
    entry = F.struct("turn", "role", "text")
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("_turns"))
    numbers = F.col("_turns.turn").cast("array<bigint>")
    expected = F.sequence(F.lit(0).cast("bigint"), F.size("_turns").cast("bigint") - 1)
    return ordered.select(
        "conv_id",
        F.transform(
            "_turns", lambda t: F.struct(t["role"].alias("from"), t["text"].alias("value"))
        ).alias("conversations"),
        (numbers == expected).alias("complete"),
    )
