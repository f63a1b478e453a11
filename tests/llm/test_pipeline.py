"""The pipeline, stage by stage, against brute force on a small corpus."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from distaff.llm import mixing, toxicity
from test_decontaminate import brute as contaminated
from test_simhash import plain_components
from test_substring_dedup import brute as cut

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, copies string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, near copies, shared passages, benchmark passages and toxic words."""
    rng = random.Random(7)
    words = [a + b + c for a in ("an", "be", "chi", "do") for b in ("el", "fu", "go", "ha") for c in ("in", "jo", "ka", "")]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    passage, items = text(60), [text(14), text(30), text(5)]
    docs, labels = [], []
    for i in range(240):
        w = text(rng.choice([30, 80, 200]))
        if i % 8 == 0:
            w[10:10] = passage
        if i % 15 == 1:
            w[5:5] = rng.choice(items)
        if i % 6 == 2:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["vexwort", "grumschaft", "zyllpest"])
        if i % 10 == 3 and docs:
            w = rng.choice(docs)[1].split()
            w = w if i % 20 == 3 else [*w[:-1], "changed"]
        t = " ".join(w)
        docs.append((i, t, "en", f"s{rng.choice([0, 0, 1, 2])}", len(t), "clash"))
        labels.append((i, 1, int(any(x in t for x in ("vexwort", "grumschaft", "zyllpest")))))
    docs += [(300, "", "en", None, 0, None), (301, None, None, "s1", None, None), (None, "lone words here", "en", "s1", 15, None)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder).cache()
        assert sorted(out.columns) == sorted(docs.columns) and out.count() <= docs.count()
        seen[name] = (docs, out)
        docs = out
    before, after = (pairs(df) for df in seen["toxicity"])
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    full, _ = seen["toxicity"]
    scored = toxicity.score_toxicity(full, toxicity.fit_toxicity(full, labels)).filter("predicted = 0")
    assert sorted(map(str, (d for d, _ in after))) == sorted(str(r.doc_id) for r in scored.collect())
    words = ("vexwort", "grumschaft", "zyllpest")
    toxic = {d for d, t in before if any(w in (t or "") for w in words)}
    gone = {d for d, _ in before} - {d for d, _ in after}
    assert len(gone & toxic) >= 0.9 * len(toxic) and not gone - toxic

    before, after = (pairs(df) for df in seen["simhash_near_dedup"])
    best = {}
    for d, fp, root in plain_components(before):
        key = root if root is not None else fp
        best[key] = min(best.get(key, d), d) if d is not None and best.get(key) is not None else d
    assert sorted(map(str, best.values())) == sorted(str(d) for d, _ in after) and len(after) < len(before)

    before, after = (pairs(df) for df in seen["substring_dedup"])
    wanted = {(d, kept if n else None) for d, _, n, kept in cut(before, 20)}
    plain = dict(before)
    assert {(d, t if t != plain[d] else None) for d, t in after} == wanted
    assert all(r.n_chars == len(r.text) for r in seen["substring_dedup"][1].collect() if r.text is not None)

    before, after = (pairs(df) for df in seen["decontamination"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = sorted(str(d) for d, *_, hit in contaminated(before, items) if not hit)
    assert clean == sorted(str(d) for d, _ in after) and len(after) < len(before)

    before, after = seen["mixing"]
    mixed = mixing.mix(before).filter("copies > 0").select("doc_id", "copies")
    assert sorted(map(str, mixed.collect())) == sorted(map(str, after.select("doc_id", "copies").collect()))
    for source in ("s0", "s1", "s2"):
        mine = mixing.mix(before).filter(F.col("source") == source).agg(F.sum("taken"), F.first("target")).first()
        assert abs(mine[0] - mine[1]) <= 30  # the shortest text has 30 words


def test_equal_rows_are_kept_as_often_as_the_mix_takes_them(spark, folder):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choices(["an", "be", "chi"], k=n))
    rows = [(7, "hot words " * 20, "s1", "en", i, "x") for i in range(900)] + [(7, "hot words " * 20, "s2", "en", 0, "x")] * 3
    rows += [(i, text(40), f"s{i % 3}", "en", 0, "y") for i in range(100, 400)] + [(None, None, None, "en", 0, None), (8, "", "s1", "en", 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint, copies string").repartition(5)
    got = corpus_pipeline.mix_sources(spark, docs, folder)
    mixed = mixing.mix(docs).filter("copies > 0")
    count = lambda df: sorted(map(str, df.groupBy("doc_id", "source", "copies").count().collect()))
    assert count(got) == count(mixed)
    assert 0 < mixed.filter("source = 's1' AND doc_id = 7").agg(F.count_if(F.col("copies") == 1)).first()[0] < 900
    assert got.columns == ["doc_id", "text", "source", "lang", "n_chars", "copies"]
    hot = got.filter("source = 's1' AND doc_id = 7").collect()
    assert len({r.n_chars for r in hot}) == len(hot)


def test_run_writes_every_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 50 and corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
