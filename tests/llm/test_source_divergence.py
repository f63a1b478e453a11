"""Source divergence against brute force in whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from distaff.llm import source_divergence as sd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, term string, value int, n double"


def lowered(term):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term)


def brute(rows, top, least):
    """rows of (text, lang, source); null is empty."""
    docs, langs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in ((t or "", g or "", s or "") for t, g, s in rows):
        words = [lowered(w) for w in TERM.findall(text)]
        docs[lang, source].update(words)
        langs[lang].update(set(words))
    out = []
    for lang in {g for g, _ in docs}:
        kept = [t for t, n in langs[lang].items() if n >= least]
        groups = {s: c for (g, s), c in docs.items() if g == lang}
        whole = sum(groups.values(), Counter())
        p = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[u] for u in kept) + len(kept)) for t in kept}
        q, ps = p(whole), {s: p(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(-sum((ps[s][t] - ps[o][t]) ** 2 // ps[o][t] for t in kept), o.encode()) for o in groups if o != s]
            terms = [(-((ps[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if groups[s][t] and ps[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(found, 1)]
    return sorted(out)


def corpus():
    rng = random.Random(5)
    words = ["Der", "die", "ÉTÉ", "été", "naïve", "it's", "a1b", "x_y", "_", "ZZ", "KelvinK", "日本", "end."] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = []
    for lang, sources in (("en", ["a", "b", None, "é"]), (None, ["a", "B"]), ("fr", ["only"])):
        for _ in range(60):
            text = " \t\n\x1c "[rng.randrange(5)].join(rng.choices(words, k=rng.randrange(0, 25)))
            rows.append((text, lang, rng.choice(sources)))
    rows += [("", "en", "silent"), (None, "en", None), ("rare words", "xx", "p"), ("other", "xx", "q"), (None, None, None)]
    rows += [("Hot hot line", "en", "a")] * 80
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, g, s, "x", 1, 0.5) for i, (t, g, s) in enumerate(rows)], SCHEMA).repartition(5)
    for top, least, cells in ((7, 3, 1 << 20), (200, 1, 16)):
        found = sd.source_divergence(docs, top, least, cells)
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(tuple(r) for r in found.collect()) == brute(rows, top, least)


def test_one_source_no_terms_and_no_rows(spark):
    rows = [("a b", "en", "s"), (None, "en", "s")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sd.source_divergence(docs).count() == 0
    assert sd.source_divergence(docs.limit(0)).count() == 0
    two = docs.union(docs.selectExpr("text", "lang", "'z'")).limit(3)
    assert sorted(tuple(r) for r in sd.source_divergence(two).collect()) == brute([tuple(r) for r in two.collect()], 200, 3)


def test_terms_are_the_pattern_and_long_texts_are_whole():
    rng = random.Random(1)
    text = "".join(rng.choices("aZé 日 \t\n\x00-_@[`{~\x7f9.", k=20_000))
    wanted = Counter(lowered(w).encode() for w in TERM.findall(text))
    for piece in (1, 7, 1 << 20):
        assert sd.document_terms(text.encode(), piece) == wanted


def test_batches_are_flushed_when_full(spark, monkeypatch):
    monkeypatch.setattr(sd, "ENTRIES", 3)
    assert pa.Table.from_batches([sd._merged([("a", "b")], [0], [], [])]).to_pylist() == [
        {"lang": "a", "source": "b", "term": b"", "n": 0, "docs": 0}
    ]
    docs = spark.createDataFrame([("a a b", "x", "y")] * 4, "text string, lang string, source string").coalesce(1)
    assert {r.term: (r.n, r.docs) for r in sd.term_counts(docs).collect()} == {"": (0, 0), "a": (8, 4), "b": (4, 4)}


def test_probabilities_of_huge_counts(spark):
    rng = random.Random(2)
    cases = [(n, n + rng.randrange(1, 10**14)) for n in (rng.randrange(0, 10**13) for _ in range(200))] + [(0, 1), (4, 5)]
    wanted = [1 + 10**9 * (n + 1) // t for n, t in cases]
    n, t = (np.array(x, dtype=np.int64) for x in zip(*cases))
    assert sd.probabilities(n, t).tolist() == wanted
    df = spark.createDataFrame(cases, "n bigint, t bigint")
    assert [r[0] for r in df.select(sd.probability(df.n, df.t)).collect()] == wanted


def test_query_equals_its_twin(spark):
    from compare import difference, oracle
    from distaff.llm.queries import QUERIES, SQL
    from distaff.plans.registry import Query

    sf = "/root/testdata/sf0.001"
    assert difference(spark, oracle(sf), sf, Query(QUERIES["op11_divergence"], SQL["op11_divergence"])) is None
