"""Substring dedup against a brute-force version."""

import random
import re

import pytest

from distaff.llm.substring_dedup import remove_repeats, without_repeats

SCHEMA = "doc_id bigint, text string, block string, n_words int"


def brute(rows, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    place = lambda d: (d is None, d or 0)
    first = {}
    for (d, _), w in zip(rows, split):
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, (place(d), i)), (place(d), i))
    out = []
    for (d, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if (place(d), i) > first[tuple(w[i : i + window])]:
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "clash", 5) for d, t in rows], SCHEMA)
    out = remove_repeats(df, **options)
    assert out.columns == ["row", "n_words", "n_removed", "kept"]
    return sorted(((r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"p{rng.randrange(50)}" for _ in range(rng.randrange(20, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randrange(5)):
            w += [f"w{rng.randrange(30)}" for _ in range(rng.randrange(25))]
            w += rng.choice(passages) if rng.random() < 0.6 else []
        rows.append((rng.randrange(55), rng.choice([" ", "\n", "\t"]).join(w)))
    rows += [rows[0], rows[1], (None, rows[2][1]), (None, rows[3][1]), (70, None), (71, ""), (72, "x " * 3000), (73, "é b " * 30), (74, "X " * 25)]
    return rows


@pytest.mark.parametrize("size", [1 << 20, 600])
def test_equals_brute_force_in_one_block_and_in_many(spark, size):
    rows = corpus(4)
    got = run(spark, rows, block_bytes=size, range_bytes=2 * size)
    assert got == brute(rows, 20) and sum(r[2] for r in got) > 3000


def test_short_windows_and_empty_table(spark):
    rows = [(1, "a b a b c"), (2, "b c"), (3, "c")]
    assert run(spark, rows, window=2) == brute(rows, 2)
    assert run(spark, []) == []


def test_without_repeats_keeps_untouched_texts_as_they_are(spark):
    rows = [(1, "a  b\nc", "x", 1), (2, "k " * 20 + "z", "y", 2), (3, "q  " + "k " * 20, None, None)]
    out = without_repeats(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "block", "n_words"]
    assert sorted(map(tuple, out.collect())) == [(1, "a  b\nc", "x", 1), (2, "k " * 20 + "z", "y", 2), (3, "q", None, None)]
