"""Registered queries: generation, streams, run logs and text expressions."""

from pyspark.sql import functions as F

from distaff.functions import text
from distaff.functions.schedules import cosine_rate, linear_rate
from distaff.operators import filters, generate, runlog
from distaff.operators.prompts import turn
from distaff.plans import twins
from distaff.plans.registry import query
from distaff.plans.workload import (
    PEAK_RATE,
    TOTAL_STEPS,
    chat_corpus,
    predictions,
    run_log,
    table,
)
from distaff.session import scratch_path
from distaff.sources import capture, completions
from distaff.streaming import jobs

# ---- batch inference


def _asked(spark, sf):
    return chat_corpus(spark, sf).select("example_id", turn(0, "value").alias("text"))


def _load_upper():
    """Stands in for a model: replies with the prompt in capitals."""
    return lambda prompts: [f" {p.upper()}\n" for p in prompts]


_GENERATED_SQL = """select event_id as example_id,
  upper('user ' || cast(user_id as varchar) || ' asks about ' || event_type) as completion
from events"""


@query("generate", _GENERATED_SQL)
def generated(spark, sf):
    return generate.generate(_asked(spark, sf), _load_upper).select("example_id", "completion")


@query("generate_resumable", _GENERATED_SQL)
def generate_resumable(spark, sf):
    """Two runs into one folder: the second finds ``click`` rows done."""
    path = scratch_path(spark, "generated")
    asked = _asked(spark, sf)
    nothing = asked.select("example_id").limit(0)
    first = asked.filter(F.col("text").endswith("click"))
    generate.generate_resumable(first, nothing, _load_upper, path)
    done = spark.read.schema("example_id bigint").json(path)
    generate.generate_resumable(asked, done, _load_upper, path)
    return spark.read.schema("example_id bigint, completion string").json(path)


@query(
    "map_rows",
    "select event_id, round(value * 2, 6) as doubled from events",
)
def map_rows(spark, sf):
    rows = generate.map_rows(
        table(spark, sf, "events").select("event_id", "value"),
        doubled=F.round(F.col("value") * 2, 6),
    )
    return rows.select("event_id", "doubled")


@query("map_batches", "select event_id, length(event_type) as n from events")
def map_batches(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")

    def lengths(frame):
        return frame[["event_id"]].assign(n=frame["event_type"].str.len())

    return generate.map_batches(events, lengths, "event_id bigint, n bigint")


@query("filter_rows", "select event_id from events where event_type = 'click'")
def filter_rows(spark, sf):
    events = table(spark, sf, "events")
    return generate.filter_rows(events, F.col("event_type") == "click").select("event_id")


# ---- streams


def _teacher_lines(spark, sf):
    return predictions(spark, sf).filter(F.col("model") == "teacher").select(
        F.col("example_id").cast("string").alias("example_id"),
        "model",
        F.lit("[]").alias("tools"),
        F.lit("").alias("prompt_user_turn"),
        F.col("completion").alias("teacher_completion"),
    )


def _expected(spark, sf):
    usable = filters.with_tools(chat_corpus(spark, sf)).filter(turn(0, "from") == "human")
    return usable.select(
        F.col("example_id").cast("string").alias("example_id"),
        filters.expects_call().alias("expects_call"),
    )


_CLASSIFIED_SQL = (
    twins.PAIRED_SQL
    + """select cast(example_id as varchar) as example_id, model, expected_behavior, drop_reason
from classified where model = 'teacher'
union all select cast(example_id as varchar), model, null, 'no_example' from predictions
where model = 'teacher' and example_id not in (select example_id from classified)"""
)


@query("stream_classify", _CLASSIFIED_SQL)
def stream_classify(spark, sf):
    lines, out, checkpoint = (scratch_path(spark, x) for x in ("lines", "classified", "progress"))
    completions.write_completions(_teacher_lines(spark, sf), lines)
    jobs.stream_classify(spark, lines, _expected(spark, sf), out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


@query("stream_resume", _CLASSIFIED_SQL)
def stream_resume(spark, sf):
    """Stopped after the first files, started again when more have come."""
    lines, out, checkpoint = (scratch_path(spark, x) for x in ("lines", "classified", "progress"))
    rows, expected = _teacher_lines(spark, sf), _expected(spark, sf)
    called = F.col("teacher_completion").startswith("{")
    for part in (rows.filter(called), rows.filter(~called)):
        completions.write_completions(part, lines, mode="append")
        jobs.stream_classify(spark, lines, expected, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


@query(
    "stream_capture",
    """select vec_id, round(list_sum(embedding::double[]), 6) as total,
  cast(0 as bigint) as n_over_cap from embeddings""",
)
def stream_capture(spark, sf):
    out, checkpoint = scratch_path(spark, "captured"), scratch_path(spark, "progress")
    schema = table(spark, sf, "embeddings").schema
    arriving = spark.readStream.schema(schema).parquet(f"{sf}/embeddings.parquet*")
    jobs.stream_capture(arriving, out, checkpoint, max_rows=100).awaitTermination()
    over = capture.rows_per_file(spark, out).agg(F.count_if(F.col("n_rows") > 100)).scalar()
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return spark.read.parquet(out).select(
        "vec_id", F.round(total, 6).alias("total"), over.alias("n_over_cap")
    )


@query(
    "stream_run_health",
    twins.RUN_LOG_SQL
    + """select run, date_trunc('hour', ts) as window_start, count(*) as n,
  round(avg(loss) filter (not isnan(loss)), 9) as mean_loss,
  count(*) filter (isnan(loss)) as n_not_finite
from run_log group by all""",
)
def stream_run_health(spark, sf):
    log, out, checkpoint = (scratch_path(spark, x) for x in ("log", "health", "progress"))
    rows = run_log(spark, sf)
    rows.write.parquet(log)
    arriving = spark.readStream.schema(rows.schema).parquet(log)
    jobs.stream_run_health(arriving, out, checkpoint, arrival=["step"]).awaitTermination()
    return jobs.latest_health(spark, out).select(
        "run",
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "n",
        F.round("mean_loss", 9).alias("mean_loss"),
        "n_not_finite",
    )


@query(
    "stream_late_rows",
    """with log as (
  select 'run-' || (event_id % 8) as run, event_id, ts, event_id + (event_id * 7919) % 400 as arrived from events),
judged as (
  select run, event_id, ts, max(ts) over (
    partition by run order by arrived, event_id rows between unbounded preceding and 1 preceding) as newest from log)
select run, event_id, newest, 'late' as late_reason from judged where ts < newest - interval 2 hours""",
)
def stream_late_rows(spark, sf):
    """Log rows that arrive out of order, in two parts: those more than two hours behind their run."""
    log, out, checkpoint = (scratch_path(spark, x) for x in ("log", "health", "progress"))
    i = F.col("event_id")
    rows = table(spark, sf, "events").select(
        F.concat(F.lit("run-"), (i % 8).cast("string")).alias("run"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("loss"),
        (i + i * 7919 % 400).alias("arrived"),
    )
    half = rows.agg(F.expr("max(arrived) div 2")).scalar()
    for part in (rows.filter(F.col("arrived") <= half), rows.filter(F.col("arrived") > half)):
        part.write.mode("append").parquet(log)
        arriving = spark.readStream.schema(rows.schema).parquet(log)
        query = jobs.stream_run_health(arriving, out, checkpoint, lateness="2 hours", arrival=["arrived", "event_id"])
        query.awaitTermination()
    return jobs.late_rows(spark, out).select(
        "run", "event_id", F.col("newest").cast("timestamp_ntz").alias("newest"), "late_reason"
    )


# ---- run logs


@query(
    "run_summary",
    twins.RUN_LOG_SQL
    + """select run, count(*) as n_steps, max(step) as last_step,
  round(max_by(loss, step), 6) as final_loss,
  round(avg(loss) filter (not isnan(loss)), 9) as mean_loss,
  count(*) filter (isnan(loss)) as n_not_finite,
  count(*) filter (isnan(loss)) = 0 as all_finite,
  date_diff('microsecond', min(ts), max(ts)) as runtime_us,
  round(min_by(lr, step), 12) as first_lr
from run_log group by run""",
)
def run_summary(spark, sf):
    return runlog.run_summary(run_log(spark, sf)).withColumns(
        {
            "final_loss": F.round("final_loss", 6),
            "mean_loss": F.round("mean_loss", 9),
            "first_lr": F.round("first_lr", 12),
        }
    )


@query(
    "lr_trajectory_audit",
    twins.RUN_LOG_SQL
    + """, candidates as (select unnest([0, 30]) as warmup),
errors as (
  select run, warmup, max(abs(lr - 2e-5 * case when step < warmup then step / greatest(1, warmup)
    else greatest(0e0, 1e0 - (step - warmup) / (2000e0 - warmup)) end)) as max_error
  from run_log, candidates group by run, warmup)
select run, cast(warmup as bigint) as warmup, round(max_error, 12) as max_error,
  cast(first_value(warmup) over (partition by run order by max_error, warmup) as bigint)
    as best_warmup,
  warmup = first_value(warmup) over (partition by run order by max_error, warmup) as fits_best
from errors""",
)
def lr_trajectory_audit(spark, sf):
    audit = runlog.lr_trajectory_audit(run_log(spark, sf), PEAK_RATE, TOTAL_STEPS, [0, 30])
    return audit.withColumn("max_error", F.round("max_error", 12))


@query(
    "log_gaps",
    twins.GAPPED_LOG_SQL
    + """, previous as (
  select run, step, lag(step) over (partition by run order by step) as p from run_log)
select run, p + 1 as missing_from, step - 1 as missing_to, step - p - 1 as n_missing
from previous where step - p > 1""",
)
def log_gaps(spark, sf):
    return runlog.log_gaps(run_log(spark, sf, gaps=True))


@query(
    "common_steps",
    twins.RUN_LOG_SQL
    + """, a as (select step from run_log where run = 'run-1'),
b as (select step from run_log where run = 'run-5'),
both_runs as (select step from a intersect select step from b)
select (select count(*) from a) as n_a, (select count(*) from b) as n_b,
  count(*) as n_common, min(step) as first_common, max(step) as last_common from both_runs""",
)
def common_steps(spark, sf):
    return runlog.common_steps(run_log(spark, sf), "run-1", "run-5")


@query(
    "checkpoint_plan",
    twins.GAPPED_LOG_SQL
    + """, saved as (
  select run, step from run_log r
  where step % 10 = 0 or step = (select max(step) from run_log s where s.run = r.run)),
aged as (
  select run, step, row_number() over (partition by run order by step desc) as age,
    count(*) over (partition by run) as n_saved from saved)
select * from aged where age <= 3""",
)
def checkpoint_plan(spark, sf):
    return runlog.checkpoint_plan(run_log(spark, sf, gaps=True))


@query(
    "rate_schedules",
    """select event_id, round(1e6 * 2e-5 * case when event_id < 30 then event_id / 30e0
    else greatest(0e0, 1e0 - (event_id - 30) / 1970e0) end, 6) as linear_micro,
  round(1e6 * 2e-5 * case when event_id < 30 then event_id / 30e0
    else 0.5e0 * (1 + cos(pi() * (event_id - 30) / 1970e0)) end, 6) as cosine_micro
from events""",
)
def rate_schedules(spark, sf):
    step = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id",
        F.round(linear_rate(step, PEAK_RATE, 30, TOTAL_STEPS) * 1e6, 6).alias("linear_micro"),
        F.round(cosine_rate(step, PEAK_RATE, 30, TOTAL_STEPS) * 1e6, 6).alias("cosine_micro"),
    )


# ---- text expressions


@query(
    "strip",
    """select conv_id, turn, trim('  ' || text || chr(10) || chr(9) || ' ',
  ' ' || chr(9) || chr(10) || chr(13)) as stripped from conversations""",
)
def strip(spark, sf):
    padded = F.concat(F.lit("  "), F.col("text"), F.lit("\n\t "))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", text.strip(padded).alias("stripped")
    )


@query(
    "drop_prompt_echo",
    twins.EXAMPLES_SQL
    + """select example_id, trim(substr(user_turn || ' ' || second_value,
  length(user_turn) + 1)) as reply from examples""",
)
def drop_prompt_echo(spark, sf):
    prompt, reply = turn(0, "value"), turn(1, "value")
    echoed = F.concat(prompt, F.lit(" "), reply)
    return chat_corpus(spark, sf).select(
        "example_id", text.drop_prompt_echo(echoed, prompt).alias("reply")
    )
