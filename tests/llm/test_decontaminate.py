"""Decontamination against a brute-force version."""

import random
import re

import pytest

from distaff.llm.decontaminate import contamination, words_of

DOCS = "doc_id bigint, text string, item_id string, words string"
ITEMS = "item_id bigint, text string, doc_id int"


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, window=10):
    wanted = {}
    for item, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wanted.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = plain_words(text)
        hit, ids = set(), set()
        for n in {len(k) for k in wanted}:
            for i in range(len(w) - n + 1):
                if found := wanted.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    ids |= {str(x) for x in found if x is not None}
        out.append((doc, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, "clash", "clash") for d, t in docs], DOCS),
        spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS),
    )


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["the", "a", "of", "été", "x1", *[f"w{i}" for i in range(40)]])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 9, 10, 11, 30])))) for i in range(15)]
    items = [(i, t) for i, t in items if len(t.split()) != 1] + [(50, "Unicorn"), (51, ""), (52, None), (53, "?!"), (54, "unicorn"), (54, "unicorn")]
    docs = []
    for i in range(40):
        w = [word() for _ in range(rng.choice([0, 1, 5, 60, 400]))]
        for _ in range(rng.randrange(3)):
            piece = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(piece) + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = piece[a : a + 14]
        docs.append((i, rng.choice([" ", "--", "\n"]).join(w).upper() if i % 3 else ", ".join(w)))
    docs += [(100, None), (101, ""), (7, "UNICORN unicorn"), (7, "UNICORN unicorn"), (None, "a unicorn"), (103, items[3][1] * 500)]
    got = result(contamination(*frames(spark, docs, items)))
    assert got == brute(docs, items) and sum(r[4] for r in got) > 10


def test_a_full_filter_lets_more_through_but_changes_nothing(spark):
    docs, items = [(1, "a b c d e f g h i j k l"), (2, "z y x w v u")], [(9, "b c d e f g h i j k"), (8, "v u z")]
    from distaff.llm.decontaminate import find_windows

    got = [sorted(map(tuple, find_windows(*frames(spark, docs, items), filter_bits=bits)[1].select("doc_id", "start", "length", "item_id").collect())) for bits in (64, 1 << 24)]
    assert got[0] == got[1] == [(1, 1, 10, 9)]


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], [])])
def test_empty_sides(spark, docs, items):
    assert result(contamination(*frames(spark, docs, items))) == brute(docs, items)


def test_words():
    assert words_of("It's 3x-4Y\x7fé\tÀB_") == [w.encode() for w in plain_words("It's 3x-4Y\x7fé\tÀB_")]
