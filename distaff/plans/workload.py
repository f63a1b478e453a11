"""Tool-calling workload derived from the given tables.

``events`` rows become one chat example each and four models' completions of
it; neighbouring ``embeddings`` stand in for teacher and student logits; and
``events`` split by id are the log of eight training runs.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distaff.constants import IGNORE_LABEL
from distaff.functions.schedules import linear_rate
from distaff.operators.examples import scoring_examples
from distaff.operators.filters import expects_call, with_tools
from distaff.operators.pairing import score_inputs
from distaff.operators.prompts import turn
from distaff.operators.scoring import score_rows

MODELS = ["base", "sft", "distilled", "teacher"]
N_RUNS = 8
WARMED_RUNS = 4
WARMUP = 30
PEAK_RATE = 2e-5
TOTAL_STEPS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chat_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(example_id, tools, conversations) of two turns each."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS example_id",
        """CASE WHEN event_id % 11 = 0 THEN '[]' WHEN event_id % 13 = 0 THEN NULL
           ELSE concat('[{"name":"', event_type, '","parameters":{"k":"int"}}]') END AS tools""",
        """array(
           named_struct(
             'from', CASE WHEN event_id % 19 = 0 THEN 'gpt' ELSE 'human' END,
             'value', concat('user ', user_id, ' asks about ', event_type)),
           named_struct(
             'from', CASE WHEN event_id % 2 = 0 THEN 'function_call'
                          WHEN event_id % 23 = 0 THEN 'observation' ELSE 'gpt' END,
             'value', CASE WHEN event_id % 2 = 0
                        THEN concat('{"name":"', event_type, '","arguments":', props, '}')
                        ELSE concat('Which ', event_type, ' do you mean?') END)
           ) AS conversations""",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(example_id, model, completion): ten behaviours, from exact to prose."""
    models = ", ".join(f"named_struct('m', {n}, 'model', '{m}')" for n, m in enumerate(MODELS))
    return (
        table(spark, sf_dir, "events")
        .selectExpr("event_id", "event_type", "props", f"inline(array({models}))")
        .selectExpr(
            "event_id AS example_id",
            "model",
            """CASE (event_id + 3 * m * (event_id % 7)) % 10
               WHEN 0 THEN concat('{"name":"', event_type, '","arguments":', props, '}')
               WHEN 1 THEN concat('{"arguments":', props, ',"name":"', event_type, '"}')
               WHEN 2 THEN concat('Sure: {"name": "', event_type, '", "arguments": ', props,
                                  '} done')
               WHEN 3 THEN concat('{"name":"other","arguments":', props, '}')
               WHEN 4 THEN concat('{"name":"', event_type, '","arguments":{"k":-1}}')
               WHEN 5 THEN concat('{"name":"', event_type, '"}')
               WHEN 6 THEN concat('{"name":"', event_type, '","arguments":')
               WHEN 7 THEN concat('{"name":"', event_type, '"} and {"name":"x"}')
               WHEN 8 THEN '{"note":"no name"}'
               ELSE 'Could you tell me more?' END AS completion""",
        )
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prediction of every scoreable example, scored once."""
    examples = scoring_examples(with_tools(chat_corpus(spark, sf_dir)))
    return score_rows(score_inputs(examples, predictions(spark, sf_dir)))


def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions beside the expectation of their example."""
    usable = with_tools(chat_corpus(spark, sf_dir)).filter(turn(0, "from") == "human")
    expected = usable.select("example_id", expects_call().alias("expects_call"))
    return score_inputs(expected, predictions(spark, sf_dir))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, teacher, student, label): logits of neighbouring vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    teacher = vectors.selectExpr(
        "vec_id",
        "embedding AS teacher",
        f"CASE WHEN vec_id % 5 = 0 THEN {IGNORE_LABEL} ELSE int(vec_id % 64) END AS label",
    )
    student = vectors.selectExpr("vec_id - 1 AS vec_id", "embedding AS student")
    return teacher.join(student, "vec_id")


def run_log(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """(run, step, ts, loss, lr); with ``gaps``, ``error`` events are steps no log kept."""
    i = F.col("event_id")
    run, step = i % N_RUNS, F.floor(i / N_RUNS)
    warm = linear_rate(F.col("step"), PEAK_RATE, WARMUP, TOTAL_STEPS)
    cold = linear_rate(F.col("step"), PEAK_RATE, 0, TOTAL_STEPS)
    return (
        table(spark, sf_dir, "events")
        .filter((F.col("event_type") != "error") | F.lit(not gaps))
        .select(
            F.concat(F.lit("run-"), run.cast("string")).alias("run"),
            step.alias("step"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.when(i % 97 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("loss"),
            (run < WARMED_RUNS).alias("_warmed"),
        )
        .withColumn("lr", F.when(F.col("_warmed"), warm).otherwise(cold))
        .drop("_warmed")
    )
