"""Model completions as JSON lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

COMPLETION_SCHEMA = T.StructType(
    [
        T.StructField("example_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("tools", T.StringType()),
        T.StructField("prompt_user_turn", T.StringType()),
        T.StructField("teacher_completion", T.StringType()),
    ]
)
FILTERED_SCHEMA = T.StructType(
    [*COMPLETION_SCHEMA.fields, T.StructField("expected_behavior", T.StringType())]
)


def read_completions(
    spark: SparkSession, path: str, schema: T.StructType = COMPLETION_SCHEMA
) -> DataFrame:
    """Read JSON lines; unreadable lines are kept in ``_corrupt_record``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def corrupt_count(completions: DataFrame) -> DataFrame:
    """Rows read and rows that were not JSON objects."""
    readable = F.col("teacher_completion").isNotNull() | F.col("example_id").isNotNull()
    return completions.agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("n_corrupt"),
        F.count_if(readable).alias("n_read"),
    )


def write_filtered(classified: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the kept completions of classified ones on ``FILTERED_SCHEMA``."""
    kept = classified.filter("expected_behavior IS NOT NULL")
    write_completions(kept.select(*FILTERED_SCHEMA.fieldNames()).to(FILTERED_SCHEMA), path, mode)


def write_completions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one JSON object per row; null fields are written as nulls."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
