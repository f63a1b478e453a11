"""Filter orders against applying the filters one by one."""

import random
import re
from itertools import permutations

import numpy as np

from distaff.llm import filter_interactions as fi

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, source string, part string, mask int, n double, good string"
COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def fails(rows):
    """Failed filters of (doc_id, text, source)."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        bad = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        bad += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + "D" * any(c in text for c in "#$%&*|")
        smaller = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows)
        out.append(bad + "E" * smaller)
    return out


def brute(rows, good, toxic):
    out, bad = [], fails(rows)
    for part in {s or "" for _, _, s in rows}:
        mine = [(r[0], b) for r, b in zip(rows, bad) if (r[2] or "") == part]
        steps = []
        for order in ("".join(p) for p in permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                steps.append([
                    part, order, step, len(left), len(gone), sum(f in b for _, b in mine) - len(gone),
                    sum(b == f for _, b in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ])
        for s in steps:
            out.append((*s, sum(t[4] for t in steps if t[1][t[2] - 1] == s[1][s[2] - 1])))
    return sorted(out)


def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(90):
        vocabulary = [f"w{j}" for j in range(rng.choice([20, 900]))] + ["Été", " x", "É"]
        words = rng.choices(vocabulary, k=rng.choice([0, 1, 150, 199, 200, 201, 400]))
        if rng.random() < 0.3:
            words = [w.upper() for w in words]
        if rng.random() < 0.3:
            words.append(rng.choice("#$%&*|"))
        rows.append((i, rng.choice(" \t\n\x0b").join(words), rng.choice(["a", "b", "é", None])))
    rows += [(i, "same text", "a") for i in range(200, 260)] + [(3, "same text", None), (300, None, "b"), (301, "", "b")]
    rows += [(None, "same text", "b"), (None, "same text", "b"), (None, None, None)]
    rows += [(400, "twice", "a"), (400, "twice", "a"), (401, "twice", "b"), (400, "other", "b")]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    good, toxic = {i for i in range(0, 250, 3)} | {400}, {i for i in range(0, 250, 7)}
    marks = [(i, int(i in good), int(i in toxic), "x") for i in range(0, 401)] + [(400, 0, None, "y"), (None, 1, 1, "z")]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int, source string")
    docs = spark.createDataFrame([(*r, "p", 1, 0.5, "g") for r in rows], DOCS).repartition(6)
    found = fi.filter_audit(docs, labels)
    assert found.columns == COLUMNS
    wanted = brute(rows, good, toxic)
    assert sorted(tuple(r) for r in found.collect()) == wanted and len(wanted) == 600 * 4
    assert fi.filter_audit(docs.limit(0), labels).count() == 0
    alone = [tuple(r) for r in fi.filter_audit(docs, labels.limit(0)).collect()]
    assert sorted(alone) == brute(rows, set(), set())


def test_intervals_cover_every_order_once():
    for mask in range(32):
        at = {rank: step for step, start, stop in fi.removal_intervals(mask) for rank in range(start, stop)}
        assert len(at) == (120 if mask else 0)
        for rank, step in at.items():
            order = ["ABCDE".index(f) for f in fi.ORDERS[rank]]
            assert step == min(s for s, f in enumerate(order) if mask >> f & 1)
    counts = np.random.default_rng(0).integers(0, 2**40, (2, 3, 32))
    assert (fi.removed_by_rank(counts).sum(axis=2) == counts[:, :, 1:].sum(axis=2)[:, :, None]).all()


def test_query_equals_its_twin(spark):
    from compare import difference, oracle
    from distaff.llm.queries import QUERIES, SQL
    from distaff.plans.registry import Query

    sf = "/root/testdata/sf0.001"
    assert difference(spark, oracle(sf), sf, Query(QUERIES["op12_filter_audit"], SQL["op12_filter_audit"])) is None
