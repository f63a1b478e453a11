"""Late log rows by rule, and stream tables that stay few folders."""

import os
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from distaff.session import checkpoint_dir, scratch_path, scratch_scope
from distaff.streaming import jobs
from distaff.streaming.epochs import EpochTable

SCHEMA = "run string, ts timestamp, loss double, id int"
START = datetime(2024, 1, 1)


def log_files(spark, folder, n=240, files=8, seed=1):
    """Rows of three runs, one of them a month behind; files of shuffled times that arrive one after another."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        run = ["a", "b", None][min(rng.randrange(6) // 2, 2)]
        ts = START + timedelta(hours=i - rng.choice([0, 0, 1, 2, 9, 30]), days=-30 if run == "b" else 0)
        loss = [float("nan"), None, 1.5, 2.25, float("inf") if i == 77 else 0.5][rng.randrange(5)]
        rows.append((run, None if i % 41 == 0 else ts, loss, i))
    parts = [rows[i :: files] for i in range(files)]
    for number, part in enumerate(parts):
        rng.shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / f"f{number}"))
        for written in (folder / f"f{number}").glob("part-*"):
            os.utime(written, (1_700_000_000 + number, 1_700_000_000 + number))
    return [r for part in parts for r in part]


def judged(rows, hours):
    """(in time, late) ids by the rule, over rows in order of arrival."""
    newest, out = {}, ([], [])
    for run, ts, _, i in rows:
        late = ts is None or (run in newest and ts < newest[run] - timedelta(hours=hours))
        out[late].append(i)
        if ts is not None:
            newest[run] = max(ts, newest.get(run, ts))
    return out


def run_stream(spark, folder, tmp, per_batch, lateness="6 hours", fan=4):
    out, progress = str(tmp / "out"), str(tmp / "progress")
    log = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch).parquet(f"{folder}/*")
    jobs.stream_run_health(log, out, progress, lateness=lateness, fan=fan).awaitTermination()
    return out


def check(spark, out, rows, hours=6):
    in_time, late = judged(rows, hours)
    found = jobs.late_rows(spark, out).collect()
    assert sorted(r.id for r in found) == sorted(late) and late
    assert {r.late_reason for r in found if r.ts is None} == {"no_time"}
    health = jobs.latest_health(spark, out).collect()
    assert sum(r.n for r in health) == len(in_time) and len(in_time) + len(late) == len(rows)
    wanted = jobs.run_health(spark.createDataFrame([r for r in rows if r[3] in set(in_time)], SCHEMA)).collect()
    plain = lambda rs: sorted((r.run or "", r.window_start, r.n, repr(r.mean_loss), r.n_not_finite) for r in rs)
    assert plain(health) == plain(wanted)


@pytest.mark.parametrize("per_batch", [1, 3, 100])
def test_late_rows_do_not_depend_on_batches(spark, tmp_path, per_batch):
    rows = log_files(spark, tmp_path / "in")
    check(spark, run_stream(spark, tmp_path / "in", tmp_path, per_batch), rows)


def test_late_rows_after_restarts_and_shuffled_files(spark, tmp_path):
    """The first files come last; a stream that is stopped in a batch does it again."""
    rows = log_files(spark, tmp_path / "all", files=6)
    order = [4, 1, 5, 0, 2, 3]
    (tmp_path / "in").mkdir()
    arrived, broken = [], {1, 4}
    for step, number in enumerate(order):
        for written in (tmp_path / "all" / f"f{number}").glob("part-*"):
            os.utime(written, (1_700_000_100 + step, 1_700_000_100 + step))
        os.rename(tmp_path / "all" / f"f{number}", tmp_path / "in" / f"f{number}")
        arrived += rows[number * 40 : number * 40 + 40]
        write = EpochTable.write

        def failing(self, df, epoch):
            if self.path.endswith("newest") and step in broken:
                broken.remove(step)
                raise RuntimeError("lost")
            write(self, df, epoch)

        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(EpochTable, "write", failing)
            try:
                out = run_stream(spark, tmp_path / "in", tmp_path, 2)
            except StreamingQueryException:
                assert step in (1, 4) and step not in broken
                out = run_stream(spark, tmp_path / "in", tmp_path, 2)
        check(spark, out, arrived)


def test_a_batch_leaves_no_scratch_tables(spark, tmp_path):
    home = Path(checkpoint_dir(spark)) / "distaff" / spark.sparkContext.applicationId
    scratch_path(spark, "home")
    before = set(os.listdir(home)) if home.exists() else set()
    log_files(spark, tmp_path / "in", files=2)
    run_stream(spark, tmp_path / "in", tmp_path, 1)
    assert set(os.listdir(home)) == before
    with scratch_scope(spark):
        spark.range(3).write.parquet(scratch_path(spark, "gone"))
    assert set(os.listdir(home)) == before


def total(spark, path, merge=None):
    return EpochTable(spark, str(path), "k int, n bigint", merge, fan=3)


def summed(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n")).coalesce(1)


def one(spark, epoch):
    return spark.createDataFrame([(epoch % 2, epoch)], "k int, n bigint").coalesce(1)


def test_folders_stay_few_and_sums_right(spark, tmp_path):
    table, most = total(spark, tmp_path / "t", summed), 0
    for epoch in range(82):
        table.write(one(spark, epoch), epoch)
        table.compact(epoch)
        most = max(most, len(table.folders()))
        assert len(os.listdir(tmp_path / "t")) <= 3 * 2 * 4 + 4
    assert most <= 2 * 5
    assert {r.k: r.n for r in summed(table.read()).collect()} == {0: sum(range(0, 82, 2)), 1: sum(range(1, 82, 2))}
    assert total(spark, tmp_path / "none").read().count() == 0


@pytest.mark.parametrize("state", ["half written", "written, old folders still there", "old folders gone"])
def test_restart_within_a_merge(spark, tmp_path, state):
    table = total(spark, tmp_path / "t", summed)
    for epoch in range(9):
        table.write(one(spark, epoch), epoch)
        if epoch < 8:
            table.compact(epoch)
    if state == "half written":
        half = tmp_path / "t" / os.path.basename(table._folder(6, 8))
        one(spark, 99).write.parquet(str(half))
        (half / "_SUCCESS").unlink()
    elif state.startswith("written"):
        summed(table._rows([(6, 6), (7, 7), (8, 8)])).write.parquet(table._folder(6, 8))
    else:
        table.compact(8)
        for gone in ((6, 6), (7, 7), (8, 8)):
            table._delete(gone)
    assert summed(table.read()).agg(F.sum("n")).first()[0] == sum(range(9))
    table.write(one(spark, 8), 8)
    table.compact(8)
    assert [os.path.basename(f)[-12:] for f in table.folders()] == ["000000000008"]
    assert {r.k: r.n for r in table.read().collect()} == {0: 20, 1: 16}


def test_newest_batch_alone_counts_for_a_state(spark, tmp_path):
    table = total(spark, tmp_path / "t")
    for epoch in range(4):
        table.write(one(spark, epoch), epoch)
        table.forget(before=epoch - 1)
    assert [r.n for r in table.newest(before=4).collect()] == [3]
    assert [r.n for r in table.newest(before=3).collect()] == [2]
    assert table.newest(before=2).count() == 0 and len(table.folders()) == 2
