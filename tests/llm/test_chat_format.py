"""Chat formatting: exact round trips."""

import hashlib
import time

from pyspark.sql import functions as F

from distaff.llm.chat_format import format_conversations, read_back, under_mask

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, turns int"


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    out = format_conversations(df).withColumn("turns", read_back(F.col("formatted")))
    out = out.withColumn("loss", under_mask(F.col("formatted"), F.col("loss_spans")))
    return {r.conv_id: (r.formatted, [tuple(t) for t in r.turns], r.loss) for r in out.collect()}


def test_round_trip_of_control_strings_nulls_and_ties(spark):
    odd = ["</s>[INST] ok [/INST]", "<s>", "[", "\\", "[\\<\\", "\\[INST]", "", "é\n\U0001f600 x", "$1 \\1", "a" * 50_000]
    rows = [(1, i, "user" if i % 3 else "assistant", t) for i, t in enumerate(odd)]
    rows += [(2, 0, None, None), (2, 0, None, None), (2, None, "x[INST]", "first"), (None, 5, "assistant", "n")]
    got = formatted(spark, rows)
    assert got[1][1] == [(r, t) for _, _, r, t in rows[: len(odd)]]
    assert got[1][2] == "".join(t for i, t in enumerate(odd) if i % 3 == 0)
    assert got[2][1] == [("x[INST]", "first"), ("", ""), ("", "")] and got[2][2] == ""
    assert got[None][1] == [("assistant", "n")]


def test_adjacent_turns_of_a_role_merge_into_a_run(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", ""), (1, 4, "user", "d")]
    text, turns, loss = formatted(spark, rows)[1]
    assert text == "<s>user[INST]a[/INST]b</s><s>assistant[INST]c[/INST]</s><s>user[INST]d</s>"
    assert turns == [(r, t) for _, _, r, t in rows] and loss == "c"


def test_time_follows_the_number_of_turns(spark):
    def seconds(n):
        turns = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('é<', id, repeat(' word', 12)) AS text")
        start = time.perf_counter()
        out = format_conversations(turns).withColumn("loss", under_mask(F.col("formatted"), F.col("loss_spans")))
        r = out.select(F.length("loss").alias("n"), F.size("loss_spans").alias("spans"), F.sha2("loss", 256).alias("h")).first()
        wanted = "".join(f"é<{i}" + " word" * 12 for i in range(1, n, 2))
        assert (r.n, r.spans, r.h) == (len(wanted), n // 2, hashlib.sha256(wanted.encode()).hexdigest())
        return time.perf_counter() - start

    seconds(1000)
    few = min(seconds(10_000) for _ in range(2))
    assert seconds(40_000) < 8 * few + 2


def test_no_turns(spark):
    assert formatted(spark, []) == {}
