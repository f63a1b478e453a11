"""Message tables, captured distributions and their manifest."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from distaff.constants import ROWS_PER_FILE

TOKEN_LOGPROB = T.StructType(
    [T.StructField("token_id", T.IntegerType()), T.StructField("logprob", T.FloatType())]
)
CAPTURE_SCHEMA = T.StructType(
    [
        T.StructField("input_ids", T.ArrayType(T.LongType())),
        T.StructField("labels", T.ArrayType(T.LongType())),
        T.StructField("top_logprobs", T.ArrayType(T.ArrayType(TOKEN_LOGPROB))),
    ]
)
#: Captured rows that can be told apart.
KEYED_CAPTURE_SCHEMA = T.StructType([T.StructField("example_id", T.StringType()), *CAPTURE_SCHEMA.fields])
MANIFEST_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType(), False), T.StructField("value", T.StringType())]
)


def save_messages(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Save nested messages; arrays of structs stay as they are."""
    df.write.mode(mode).parquet(path)


def load_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def fixed_schema(df: DataFrame, schema: T.StructType = CAPTURE_SCHEMA) -> DataFrame:
    """Reorder and convert to ``schema``.

    Missing columns and changes of kind fail, as from fractions to whole
    numbers; whole numbers that are too large fail when they are read.
    Fractions may be rounded to a shorter type.
    """
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing for the fixed schema: {absent}")
    unfit = [f.name for f in schema.fields if not _fits(df.schema[f.name].dataType, f.dataType)]
    if unfit:
        raise ValueError(f"columns of another kind than the fixed schema: {unfit}")
    return df.select(*[f.name for f in schema.fields]).to(schema)


def _fits(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether values stay the same numbers, but for rounding of fractions."""
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return _fits(given.elementType, wanted.elementType)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        found = {f.name: f.dataType for f in given.fields}
        return all(f.name in found and _fits(found[f.name], f.dataType) for f in wanted.fields)
    whole, fraction = T.IntegralType, T.FractionalType
    if isinstance(given, whole):
        return isinstance(wanted, (whole, fraction))
    return given == wanted or (isinstance(given, fraction) and isinstance(wanted, fraction))


def captured_sequences(sequences: DataFrame, positions: DataFrame, seq: str = "example_id") -> DataFrame:
    """Add ``top_logprobs``, the top entries of every position, and ``capture_reason``, to rows with ``input_ids``.

    ``positions`` has (``seq``, pos, top) with pos from 0. A sequence is whole
    when each of its positions is there once; else it keeps its row with null
    entries and the reason ``no_positions``, ``positions_missing``,
    ``position_repeated`` or ``position_outside``. A sequence's positions are
    grouped in one place, as many as the model's context holds.
    """
    places = positions.groupBy(F.col(seq).alias("_seq")).agg(F.sort_array(F.collect_list(F.struct("pos", "top"))).alias("_at"))
    # counted in the list, as distinct positions beside it would take another shuffle of all entries
    places = places.withColumn("_n", F.size(F.array_distinct(F.array_compact(F.transform("_at", lambda p: p["pos"])))))
    joined = sequences.join(places, F.col(seq).eqNullSafe(F.col("_seq")), "left")
    length, n = F.size("input_ids"), F.size("_at")
    reason = (
        F.when(F.col("_at").isNull() & (length > 0), "no_positions")
        .when(n > F.col("_n"), "position_repeated")
        .when((F.get("_at", F.lit(0))["pos"] < 0) | (F.get("_at", n - 1)["pos"] >= length), "position_outside")
        .when(n < length, "positions_missing")
    )
    top = F.coalesce(F.transform("_at", lambda p: p["top"]), F.array().cast(positions.select(F.array("top")).schema[0].dataType))
    return (
        joined.withColumn("capture_reason", reason)
        .withColumn("top_logprobs", F.when(F.col("capture_reason").isNull(), top))
        .drop("_seq", "_at", "_n")
    )


def positions_without_sequence(sequences: DataFrame, positions: DataFrame, seq: str = "example_id") -> DataFrame:
    """Captured positions whose sequence is not known."""
    return positions.join(sequences.select(seq), seq, "left_anti")


def capture_differences(written: DataFrame, read: DataFrame, key: str = "example_id") -> DataFrame:
    """(key, n_written, n_read) of rows whose values are not the same number of times on both sides.

    Rows are compared by a 256-bit hash of all their values as JSON, so
    nothing but keys and hashes is shuffled. Nested numbers stand there as
    Spark prints them, with the same digits in far less time.
    """
    values = [F.col(f.name).cast("string").alias(f.name) if _numeric(f.dataType) else F.col(f.name) for f in written.schema]
    digest = F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256)
    one = lambda df, a, b: df.select(F.col(key), digest.alias("_digest"), F.lit(a).alias("w"), F.lit(b).alias("r"))
    both = one(written, 1, 0).union(one(read.select(*written.columns), 0, 1)).groupBy(key, "_digest")
    sides = both.agg(F.sum("w").alias("n_written"), F.sum("r").alias("n_read"))
    return sides.filter("n_written <> n_read").drop("_digest")


def _numeric(kind: T.DataType) -> bool:
    """Whether a value has no text of its own, so that its printed form is no other value's."""
    if isinstance(kind, T.ArrayType):
        return _numeric(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_numeric(f.dataType) for f in kind.fields)
    return isinstance(kind, T.NumericType)


def write_capped_parquet(
    df: DataFrame, path: str, max_rows: int = ROWS_PER_FILE, mode: str = "errorifexists"
) -> None:
    """Parquet files of at most ``max_rows`` rows each."""
    df.write.mode(mode).option("maxRecordsPerFile", max_rows).parquet(path)


def rows_per_file(spark: SparkSession, path: str) -> DataFrame:
    """Row count of each file of a Parquet table."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_name").alias("file_name"))
        .agg(F.count("*").alias("n_rows"))
    )


def manifest(vocab_size: int, k: int, tokenizer: str, schema: T.StructType = CAPTURE_SCHEMA) -> dict:
    """What a reader of the capture must know: widths, tokenizer and the schema of the files."""
    return {"d": vocab_size, "k": k, "tokenizer": tokenizer, "schema": schema.simpleString()}


def manifest_table(spark: SparkSession, settings: dict) -> DataFrame:
    """Settings as (key, JSON value) rows."""
    rows = [(key, json.dumps(value)) for key, value in settings.items()]
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def manifest_rows(one_row: DataFrame) -> DataFrame:
    """A one-row table of settings as (key, JSON value) rows."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
            for c in one_row.columns
        ]
    )
    return one_row.select(F.inline(pairs))


def write_manifest(manifest_rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the manifest beside its data, as one file."""
    manifest_rows.coalesce(1).write.mode(mode).parquet(path)


def check_manifest(captured: DataFrame, training: DataFrame) -> DataFrame:
    """Settings that differ or exist on one side only."""
    left = captured.select("key", F.col("value").alias("captured"), F.lit(True).alias("_in_a"))
    right = training.select("key", F.col("value").alias("training"), F.lit(True).alias("_in_b"))
    same = (
        F.col("_in_a").isNotNull()
        & F.col("_in_b").isNotNull()
        & F.col("captured").eqNullSafe(F.col("training"))
    )
    return left.join(right, "key", "full").filter(~same).drop("_in_a", "_in_b")
