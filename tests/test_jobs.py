"""Sources, sinks, batch inference and streams."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from distaff.operators import generate, tokens
from distaff.operators.filters import classify_completions
from distaff.session import checkpoint_dir, scratch_path
from distaff.sources import capture, completions
from distaff.streaming import jobs


def test_generation_in_batches(spark):
    def load():
        def predict(prompts):
            assert 1 <= len(prompts) <= 4
            return [f"\n{len(prompts)}:{p} " for p in prompts]

        return predict

    df = spark.createDataFrame([(i, f"p{i}") for i in range(10)], "example_id int, text string")
    rows = generate.generate(df.coalesce(1), load).orderBy("example_id").collect()
    sizes = [r.completion.split(":")[0] for r in rows]
    assert sizes == ["4"] * 8 + ["2"] * 2
    assert all(r.completion.endswith(r.text) for r in rows)


def test_wrong_reply_count_fails(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "example_id int, text string").coalesce(1)
    with pytest.raises(Exception, match="2 prompts gave 1 completions"):
        generate.generate(df, lambda: lambda prompts: prompts[:1]).collect()


def test_resume_has_no_duplicates(spark, tmp_path):
    path = str(tmp_path / "out")
    load_reverse = lambda: lambda prompts: [f" {p[::-1]} " for p in prompts]
    asked = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "example_id bigint, text string")
    done = spark.createDataFrame([], "example_id bigint")
    generate.generate_resumable(asked.filter("example_id < 7"), done, load_reverse, path)
    for _ in range(2):
        done = spark.read.schema("example_id bigint").json(path)
        generate.generate_resumable(asked, done, load_reverse, path)
    rows = spark.read.schema("example_id bigint, completion string").json(path).collect()
    assert sorted(r.example_id for r in rows) == list(range(20))
    assert all(r.completion == f"p{r.example_id}"[::-1] for r in rows)


def test_completions_round_trip(spark, tmp_path):
    path = str(tmp_path / "lines")
    rows = [("1", "m", None, "q\nq", 'say "é"'), ("2", "m", "[]", "", None)]
    df = spark.createDataFrame(rows, completions.COMPLETION_SCHEMA)
    completions.write_completions(df, path)
    back = completions.read_completions(spark, path).drop(completions.CORRUPT)
    assert sorted(map(tuple, back.collect())) == rows


def test_corrupt_lines_are_counted(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = ['{"example_id":"1","teacher_completion":"x"}', '{"example_id":', "plain"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    r = completions.corrupt_count(completions.read_completions(spark, path)).first()
    assert (r.n_lines, r.n_corrupt) == (3, 2)


def test_fixed_schema(spark):
    df = spark.createDataFrame([([1], [2], [[(3, -0.5)]], "x")], "labels array<int>, input_ids array<int>, top_logprobs array<array<struct<token_id:int,logprob:double>>>, extra string")
    assert capture.fixed_schema(df).schema == capture.CAPTURE_SCHEMA
    with pytest.raises(ValueError, match="labels"):
        capture.fixed_schema(df.drop("labels"))
    with pytest.raises(ValueError, match="labels"):
        capture.fixed_schema(df.withColumn("labels", F.array(F.lit(1.7))))


def test_capped_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    capture.write_capped_parquet(spark.range(0, 25, 1, 2), path, max_rows=5)
    rows = capture.rows_per_file(spark, path).collect()
    assert sum(r.n_rows for r in rows) == 25 and max(r.n_rows for r in rows) <= 5


def test_sequences_with_all_positions(spark, tmp_path):
    top = lambda i: [(i, -0.5), (i + 1, -1.25)]
    sequences = spark.createDataFrame(
        [("a", [1, 2, 3], [-100, 2, 3]), ("b", [4, 5], [4, 5]), ("c", [6], [6]), ("d", [7, 8], [7, 8]), ("e", [9], [9]), ("f", [], [])],
        "example_id string, input_ids array<bigint>, labels array<bigint>",
    )
    at = [("a", 2, top(2)), ("a", 0, top(0)), ("a", 1, top(1)), ("b", 1, top(1)), ("d", 0, top(0)), ("d", 0, top(0)), ("e", 1, top(1)), ("lost", 0, top(0))]
    positions = spark.createDataFrame(at, "example_id string, pos int, top array<struct<token_id:int,logprob:float>>").repartition(3)
    rows = capture.captured_sequences(sequences, positions)
    got = {r.example_id: r for r in rows.collect()}
    assert {k: r.capture_reason for k, r in got.items()} == {
        "a": None, "b": "positions_missing", "c": "no_positions", "d": "position_repeated", "e": "position_outside", "f": None,
    }
    assert [[tuple(e) for e in p] for p in got["a"].top_logprobs] == [top(0), top(1), top(2)]
    assert got["f"].top_logprobs == [] and got["b"].top_logprobs is None
    assert [r.example_id for r in capture.positions_without_sequence(sequences, positions).collect()] == ["lost"]
    written = capture.fixed_schema(rows.filter("capture_reason IS NULL"), capture.KEYED_CAPTURE_SCHEMA)
    path = str(tmp_path / "captured")
    capture.write_capped_parquet(written, path)
    read = spark.read.parquet(path)
    assert capture.capture_differences(written, read).count() == 0
    found = {r.column_name: (r.shortest, r.longest, r.n_off) for r in tokens.uniform_length_check(read, ["labels", "top_logprobs"], 3).collect()}
    assert found == {"labels": (0, 3, 1), "top_logprobs": (0, 3, 1)}
    bent = read.withColumn("top_logprobs", F.transform("top_logprobs", lambda p: F.transform(p, lambda e: e.withField("logprob", e["logprob"] - F.lit(0.25).cast("float")))))
    off = capture.capture_differences(written, bent.union(read.filter("example_id = 'f'"))).collect()
    assert sorted((r.example_id, r.n_written, r.n_read) for r in off) == [("a", 0, 1), ("a", 1, 0), ("f", 1, 2)]


def test_manifest_mismatch(spark, tmp_path):
    path = str(tmp_path / "manifest")
    capture.write_manifest(capture.manifest_table(spark, capture.manifest(151_665, 64, "tok")), path)
    captured = spark.read.parquet(path)
    same = capture.manifest_table(spark, capture.manifest(151_665, 64, "tok"))
    assert capture.check_manifest(captured, same).count() == 0
    other = capture.manifest(151_936, 64, "tok") | {"extra": True}
    del other["tokenizer"]
    found = capture.check_manifest(captured, capture.manifest_table(spark, other)).collect()
    assert {r.key: (r.captured, r.training) for r in found} == {
        "d": ("151665", "151936"),
        "extra": (None, "true"),
        "tokenizer": ('"tok"', None),
    }


TEXTS = ['{"name":"f"}', "which?", '{"a":1}', "", '{"name":"f"} {"name":"g"}', 'x {"name":"f"}']


def lines(spark, start, stop):
    rows = [(str(i), "m", "[]", "q", TEXTS[i % len(TEXTS)]) for i in range(start, stop)]
    return spark.createDataFrame(rows, completions.COMPLETION_SCHEMA)


def test_stream_equals_batch_after_restart(spark, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    expected = spark.createDataFrame(
        [(str(i), i % 2 == 0) for i in range(40)], "example_id string, expects_call boolean"
    )
    for start, stop in ((0, 15), (15, 15), (15, 40)):
        completions.write_completions(lines(spark, start, stop), source, mode="append")
        jobs.stream_classify(spark, source, expected, out, progress).awaitTermination()
    batch = classify_completions(
        lines(spark, 0, 40).join(expected, "example_id"), "teacher_completion"
    ).select("example_id", "model", "expected_behavior", "drop_reason")
    stream = spark.read.parquet(out)
    assert stream.count() == 40
    assert batch.exceptAll(stream).count() == 0


def test_stream_counts_corrupt_and_unmatched_lines(spark, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    good = '{"example_id":"1","model":"m","teacher_completion":"which?"}'
    other = good.replace('"1"', '"9"')
    spark.createDataFrame([(x,) for x in (good, good[:20], other)], "value string").write.text(source)
    expected = spark.createDataFrame([("1", False)], "example_id string, expects_call boolean")
    jobs.stream_classify(spark, source, expected, out, progress).awaitTermination()
    got = sorted(str(r.drop_reason) for r in spark.read.parquet(out).collect())
    assert got == ["None", "corrupt_line", "no_example"]


def test_stream_capture_caps_files(spark, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    spark.range(0, 100, 1, 1).write.parquet(source)
    stream = spark.readStream.schema("id bigint").parquet(source)
    jobs.stream_capture(stream, out, progress, max_rows=30).awaitTermination()
    rows = capture.rows_per_file(spark, out).collect()
    assert sum(r.n_rows for r in rows) == 100 and max(r.n_rows for r in rows) <= 30


def log_rows(spark, start, stop):
    return spark.range(start, stop).select(
        F.concat(F.lit("r"), (F.col("id") % 2).cast("string")).alias("run"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 300).alias("ts"),
        F.when(F.col("id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("id") * 0.5).alias("loss"),
    )


def test_stream_health_equals_batch_after_restart(spark, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    for start, stop in ((0, 50), (50, 51), (51, 200)):
        log_rows(spark, start, stop).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log_rows(spark, 0, 1).schema).parquet(source)
        jobs.stream_run_health(stream, out, progress).awaitTermination()
    batch = jobs.run_health(log_rows(spark, 0, 200)).withColumn("mean_loss", F.round("mean_loss", 9))
    stream = jobs.latest_health(spark, out).withColumn("mean_loss", F.round("mean_loss", 9))
    assert stream.count() == batch.count()
    assert batch.exceptAll(stream).count() == 0


def test_checkpoint_folder_is_the_configured_one(spark):
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark))


def test_a_machine_local_warehouse_is_refused_on_a_cluster():
    class Session:
        def __init__(self, master, warehouse):
            self.sparkContext, self.conf = SimpleNamespace(master=master), self
            self.settings = {"spark.sql.warehouse.dir": warehouse}

        def get(self, key, default=None):
            return self.settings.get(key, default)

    assert checkpoint_dir(Session("local[4]", "file:/tmp/w/")) == "file:/tmp/w/checkpoints"
    assert checkpoint_dir(Session("yarn", "hdfs://store/w")) == "hdfs://store/w/checkpoints"
    for master, warehouse in (("yarn", "file:/tmp/w"), ("spark://host:1", "/tmp/w"), ("local-cluster[2,1,1024]", "file:/w")):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(Session(master, warehouse))


def test_filtered_completions_keep_their_label(spark, tmp_path):
    path = str(tmp_path / "kept")
    rows = lines(spark, 0, 6).withColumn("expects_call", F.col("example_id").cast("int") % 2 == 0)
    completions.write_filtered(classify_completions(rows, "teacher_completion"), path)
    got = completions.read_completions(spark, path, completions.FILTERED_SCHEMA).collect()
    assert {(r.example_id, r.expected_behavior) for r in got} == {("0", "function_call"), ("1", "clarify_or_decline"), ("3", "clarify_or_decline")}


def test_conversations_keep_every_turn(spark):
    from distaff.sources import corpus

    rows = [(1, 0, "a", "x"), (1, 1, "b", "y"), (1, 2, "a", None), (2, 1, "b", "z"), (3, 0, "a", "p"), (3, 0, "a", "p")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: ([tuple(t) for t in r.conversations], r.complete) for r in corpus.turns_to_conversations(df).collect()}
    assert got == {
        1: ([("a", "x"), ("b", "y"), ("a", None)], True),
        2: ([("b", "z")], False),
        3: ([("a", "p"), ("a", "p")], False),
    }


def test_positions_of_a_capture_are_shuffled_once_to_their_sequence(spark):
    """Distinct positions are counted in the list; null ones are no positions."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sequences = spark.createDataFrame([(k, [1, 2]) for k in "abcde"], "example_id string, input_ids array<bigint>")
        at = {"a": [0, 1], "b": [1], "c": [0, 1, 1], "d": [0, 2], "e": [None, 0, 1]}
        rows = [(k, p, [p]) for k, places in at.items() for p in places]
        positions = spark.createDataFrame(rows, "example_id string, pos int, top array<int>")
        out = capture.captured_sequences(sequences, positions)
        got = {r.example_id: (r.capture_reason, r.top_logprobs) for r in out.collect()}
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got["a"] == (None, [[0], [1]])
    assert [got[k][0] for k in "bcde"] == ["positions_missing", "position_repeated", "position_outside", "position_repeated"]
    assert "Expand" not in text and text.count("ObjectHashAggregate") == 2


def test_round_trip_reads_documents_only_to_cut_sequences(spark):
    """What is compared with the written capture is not tokenized anew."""
    from distaff.plans.registry import QUERIES

    started = []
    kept = tokens.tokenize
    tokens.tokenize = lambda *a, **k: started.append(a[2:]) or kept(*a, **k)
    compared, differences = [], capture.capture_differences
    capture.capture_differences = lambda written, read, *a: compared.append(written) or differences(written, read, *a)
    try:
        QUERIES["capture_round_trip"].build(spark, "/root/testdata/sf0.001")
    finally:
        tokens.tokenize, capture.capture_differences = kept, differences
    assert started == [("full_text", "full_ids"), ("prompt_text", "prompt_ids")]
    assert "documents.parquet" not in "".join(compared[0].inputFiles())
