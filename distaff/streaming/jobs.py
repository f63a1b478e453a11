"""Structured Streaming jobs over growing completions, captures and logs.

Every job takes its checkpoint folder as an argument, runs what is available
and stops; started again it goes on where it stopped.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from distaff.constants import ROWS_PER_FILE
from distaff.functions.text import is_finite_loss
from distaff.operators.filters import classify_completions
from distaff.operators.ordering import running
from distaff.session import materialise, scratch_scope
from distaff.sources.completions import COMPLETION_SCHEMA, CORRUPT
from distaff.streaming.epochs import FAN, EpochTable


def _append(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append")
    return (
        writer.options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def stream_classify(
    spark: SparkSession,
    completions_dir: str,
    examples: DataFrame,
    out: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Classify completions as their JSON lines arrive.

    ``examples`` (example_id, expects_call) is the static side of the join,
    written once so that no batch works it out again. Every line gives a row:
    ``drop_reason`` is ``corrupt_line`` where it is no JSON object and
    ``no_example`` where its example is unknown.
    """
    schema = T.StructType([*COMPLETION_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    arriving = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(completions_dir)
    )
    static = materialise(examples.select("example_id", "expects_call"), "stream-examples")
    classified = classify_completions(arriving.join(static, "example_id", "left"), "teacher_completion")
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), "corrupt_line")
        .when(F.col("expects_call").isNull(), "no_example")
        .otherwise(F.col("drop_reason"))
    )
    return _append(
        classified.select("example_id", "model", "expected_behavior", reason.alias("drop_reason")), out, checkpoint
    )


def stream_capture(
    rows: DataFrame, out: str, checkpoint: str, max_rows: int = ROWS_PER_FILE
) -> StreamingQuery:
    """Write a stream of captured rows to files of bounded row counts."""
    return _append(rows, out, checkpoint, maxRecordsPerFile=str(max_rows))


def run_health(log: DataFrame, window: str = "1 hour") -> DataFrame:
    """Rows, mean finite loss and non-finite losses by run and time window."""
    finite = is_finite_loss(F.col("loss"))
    return (
        log.groupBy("run", F.window("ts", window).alias("window"))
        .agg(
            F.count("*").alias("n"),
            F.avg(F.when(finite, F.col("loss"))).alias("mean_loss"),
            F.count_if(~finite).alias("n_not_finite"),
        )
        .select("run", F.col("window.start").alias("window_start"), "n", "mean_loss", "n_not_finite")
    )


#: Order in which a file source's rows arrive: files by age and name, then rows in the file.
ARRIVAL = ("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index")
PARTIAL_SCHEMA = "run string, window_start timestamp, n bigint, n_finite bigint, loss_sum double, n_not_finite bigint"
NEWEST_SCHEMA = "run string, newest timestamp"


def _summed(partials: DataFrame) -> DataFrame:
    """Partial sums of several batches as one row for each run and window."""
    sums = ("n", "n_finite", "loss_sum", "n_not_finite")
    return partials.groupBy("run", "window_start").agg(*[F.sum(c).alias(c) for c in sums])


def _health(spark: SparkSession, out: str, fan: int = FAN) -> EpochTable:
    return EpochTable(spark, f"{out}/health", PARTIAL_SCHEMA, _summed, fan)


def _late(spark: SparkSession, out: str, fan: int = FAN) -> EpochTable:
    """The late-row sink; its schema is that of the log, kept beside it as an empty table."""
    return EpochTable(spark, f"{out}/late", spark.read.parquet(f"{out}/late_schema").schema, fan=fan)


def judge_lateness(rows: DataFrame, state: DataFrame, lateness: str, arrival: list[str]) -> DataFrame:
    """Add ``newest`` and ``late_reason`` to rows of (run, ts, …).

    ``newest`` is the newest time of the row's run among all rows that arrived
    before it, those that ``state`` (run, newest) stands for included. A row
    is ``late`` where it is more than ``lateness`` older than that, and
    ``no_time`` where it has none. Where batches begin and end does not matter.
    """
    placed = running(rows, ["run"], arrival, {"_before": ("max", F.col("ts"))})
    known = state.select(F.col("run").alias("_run"), F.col("newest").alias("_newest"))
    joined = placed.join(known, F.col("run").cast("string").eqNullSafe(F.col("_run")), "left")
    newest = F.greatest("_before", "_newest")
    behind = F.col("ts") < F.col("newest") - F.expr(f"interval {lateness}")
    reason = F.when(F.col("ts").isNull(), "no_time").when(behind, "late")
    return joined.withColumn("newest", newest).withColumn("late_reason", reason).drop("_before", "_run", "_newest", *arrival)


def stream_run_health(
    log: DataFrame,
    out: str,
    checkpoint: str,
    window: str = "1 hour",
    lateness: str = "1 day",
    arrival=ARRIVAL,
    fan: int = FAN,
) -> StreamingQuery:
    """Keep ``run_health`` up to date as log rows (run, ts, loss, …) arrive.

    Each row is judged by ``judge_lateness`` against its own run, in the order
    of ``arrival`` (columns of ``log``; by default the place in its files), so
    the same rows are late however files fall into batches, and a run that is
    read long after another is not late for that. Rows in time add to partial
    sums of their window, all others go to the late-row sink with their
    reason; both together are the input.

    Every batch writes its partial sums, its late rows and the newest time of
    each run under its own number and reads the newest times of the batch
    before, so a batch that is done again writes the same. ``latest_health``
    and ``late_rows`` read the results, ``EpochTable`` keeps their folders few.
    """
    order = [f"_arrival_{i}" for i in range(len(arrival))]
    arriving = log.select("*", *[F.col(c).alias(o) for c, o in zip(arrival, order, strict=True)])
    sink_schema = log.select("*", F.lit(None).cast("timestamp").alias("newest"), F.lit("").alias("late_reason")).schema

    def save(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        spark.createDataFrame([], sink_schema).write.mode("ignore").parquet(f"{out}/late_schema")
        health, late = _health(spark, out, fan), _late(spark, out, fan)
        times = EpochTable(spark, f"{out}/newest", NEWEST_SCHEMA)
        with scratch_scope(spark):
            state = times.newest(before=epoch)
            judged = materialise(judge_lateness(batch, state, lateness, order), "judged")
            finite = is_finite_loss(F.col("loss"))
            run = F.col("run").cast("string").alias("run")
            in_time = judged.filter("late_reason IS NULL").groupBy(run, F.window("ts", window).alias("window"))
            health.write(
                in_time.agg(
                    F.count("*").alias("n"),
                    F.count_if(finite).alias("n_finite"),
                    F.coalesce(F.sum(F.when(finite, F.col("loss"))), F.lit(0.0)).alias("loss_sum"),
                    F.count_if(~finite).alias("n_not_finite"),
                ).select(
                    "run", F.col("window.start").alias("window_start"), "n", "n_finite", "loss_sum", "n_not_finite"
                ),
                epoch,
            )
            late.write(judged.filter("late_reason IS NOT NULL"), epoch)
            seen = judged.select(run, F.col("ts").alias("newest")).union(state)
            times.write(seen.groupBy("run").agg(F.max("newest").alias("newest")), epoch)
        times.forget(before=epoch - 1)
        health.compact(epoch)
        late.compact(epoch)

    return (
        arriving.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()
    )


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """The log rows that no window counts, with ``newest`` and ``late_reason``."""
    return _late(spark, out).read()


def latest_health(spark: SparkSession, out: str) -> DataFrame:
    """Rows in time, mean finite loss and non-finite losses by run and window."""
    mean = F.try_divide(F.col("loss_sum"), F.col("n_finite"))
    return _summed(_health(spark, out).read()).select("run", "window_start", "n", mean.alias("mean_loss"), "n_not_finite")
