"""Boosted trees, quality and toxicity on planted texts."""

import random

import numpy as np
import pytest

from distaff.llm import boosted_trees, quality, toxicity

DOCS = "doc_id bigint, text string, quality int, score string"
LABELS = "doc_id bigint, quality int, toxic int"


def test_trees_learn_an_interaction_and_walk_flat_arrays():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    trees = boosted_trees.fit(x[:2000], y[:2000])
    assert ((trees.probabilities(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95

    def walk(row):
        total = trees.bias
        for node in trees.roots:
            while trees.low[node] != node:
                node = (trees.high if row[trees.feature[node]] > trees.threshold[node] else trees.low)[node]
            total += trees.value[node]
        return total

    assert np.allclose(trees.margins(x[:50]), [walk(r) for r in x[:50]])


@pytest.mark.parametrize("y", [np.zeros(0), np.zeros(5), np.ones(5)])
def test_trees_without_two_classes(y):
    p = boosted_trees.fit(np.zeros((len(y), 3)), y).probabilities(np.zeros((2, 3)))
    assert ((p > 0.5) == (len(y) > 0 and y[0] == 1)).all() or not len(y)


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    syllables = ["an", "be", "chi", "do", "el", "fu", "go", "ha", "in", "jo", "ka", "lu"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(8, 150))]
        bad, junk = i % 5 == 0, i % 7 == 0
        for _ in range(rng.randrange(1, 4) if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["vexwort", "grumschaft", "zyllpest"])
        text = " ".join(w + "###" if junk else w for w in words) + ("" if junk else ".")
        docs.append((i, text, 0, "clash"))
        labels.append((i, 0 if junk else 1, int(bad)))
    odd = [(n, "", 0, None), (n + 1, None, 0, None), (n + 2, "x" * 100_000, 0, None), (None, "an be", 0, None), (4, docs[4][1], 0, None)]
    return docs + odd, labels + [(4, None, None), (None, 1, 1), (9999, 0, 1)]


def accuracy(rows, labels, column):
    known = {d: (q, t)[column] for d, q, t in labels[:-3]}
    held = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    return np.mean([p == k for p, k in held]), sum(k for _, k in held)


def test_held_out_quality_and_toxicity(spark):
    docs, labels = corpus()
    d, known = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    good = quality.score_quality(d, quality.fit_quality(d, known)).collect()
    bad = toxicity.score_toxicity(d, toxicity.fit_toxicity(d, known)).collect()
    for rows, column in ((good, 0), (bad, 1)):
        assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
        share, positives = accuracy(rows, labels, column)
        assert share > 0.95 and positives > 15
    kept = toxicity.without_toxic(d, known)
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in bad if not r.predicted)


def test_no_documents_and_no_labels(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    some = spark.createDataFrame([(1, "a b", 0, None), (2, None, 0, None)], DOCS)
    assert quality.score_quality(docs, quality.fit_quality(docs, labels)).count() == 0
    assert toxicity.without_toxic(docs, labels).count() == 0
    assert quality.score_quality(some, quality.fit_quality(some, labels)).count() == 2
    assert toxicity.score_toxicity(some, toxicity.fit_toxicity(some, labels)).count() == 2


def test_statistics_of_any_text():
    for text in (None, "", " \n", "a", "A. B!\nA. B!\n" * 3, "é" * 1000):
        assert len(quality.statistics(text)) == len(quality.FEATURES) and np.isfinite(quality.statistics(text)).all()
