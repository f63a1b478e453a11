"""Lattice scoring against plain recursion, and its sums."""

import math
import zlib

import numpy as np
import pytest

from distaff.llm import lattice_lm as lm

SCHEMA = "doc_id bigint, text string, word string, n int"


@pytest.fixture(scope="module")
def pieces():
    return lm.load_pieces()


def plain_spelling(pieces, weights, word):
    """All segmentations by recursion over texts."""
    text = lm.MARK + word
    texts = {}
    for n, hashes in pieces.hashes.items():
        for start in range(len(text) - n + 1):
            part = text[start : start + n]
            h = lm._hash(np.array([[ord(c) for c in part]], dtype=np.uint32))[0]
            at = np.searchsorted(hashes, h)
            if at < len(hashes) and hashes[at] == h:
                texts[part] = pieces.places[n][at]

    def ways(at):
        if at == len(text):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(text) + 1):
            piece = texts.get(text[at:end])
            if piece is not None and bool(pieces.first[piece]) == (at == 0):
                total += math.exp(weights[piece]) * ways(end)
        if at:
            n = len(text[at].encode())
            total += math.exp(n * (weights[pieces.byte] - math.log(256))) * ways(at + 1)
        return total

    return math.log(ways(0)) + weights[pieces.end_of_word]


def test_forward_sums_all_segmentations(pieces):
    weights = lm.first_weights(pieces)
    words = ["the", "there", "a", "日é", "zzxq", "▁x", "othernd"]
    assert np.allclose(lm.spelling(pieces, weights, words), [plain_spelling(pieces, weights, w) for w in words])


def test_weights_are_distributions_and_estimation_raises_likelihood(pieces):
    words = ["thonnd", "ndthon", "erre", "éelle", "onnd", "thonnd"]
    weights = lm.first_weights(pieces)
    likely = []
    for _ in range(4):
        first = np.exp(weights[:-2][pieces.first]).sum()
        rest = np.exp(weights[:-2][~pieces.first]).sum() + np.exp(weights[-2:]).sum()
        assert abs(first - 1) < 1e-9 and abs(rest - 1) < 1e-9
        likely.append(lm.spelling(pieces, weights, words).sum())
        counts = lm.expected_counts(pieces, weights, words)
        assert counts[pieces.end_of_word] == len(words) and abs(counts[:-2][pieces.first].sum() - len(words)) < 1e-6
        weights = lm.log_weights(pieces, counts, strength=1e-6)
    assert likely == sorted(likely)


def corpus():
    docs = [(i, ("The cat sat on the mat " * (i % 5)) + f"new{i} été") for i in range(60)]
    return docs + [(60, ""), (61, None), (62, "x" * 3000), (3, docs[3][1]), (None, "cat"), (63, "CAT\tcat\ncat cat")]


def test_counts_and_base_equal_plain(spark):
    docs = corpus()
    got = lm.score_documents(spark.createDataFrame([(d, t, "clash", 1) for d, t in docs], SCHEMA)).collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    split = lambda t: (t or "").encode().lower().split()
    counts = {}
    for d, t in docs:
        if not held(d):
            for w in [*split(t), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for d, t in docs:
        words = [*split(t), None]
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        wanted.append((d, held(d), len(words), sum(w in counts for w in words), n, round(base, 6)))
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == sorted(wanted, key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_blocks_do_not_matter(spark):
    docs = spark.createDataFrame([(d, t, "", 0) for d, t in corpus()], SCHEMA)
    model = lm.train(docs.select("text"))
    one, many = (lm.score(docs, model, size) for size in (1 << 20, 100))
    value = lambda df: sorted((str(r["row"].doc_id), r.n_tokens, r.n_known, round(r.score, 6)) for r in df.collect())
    assert value(one) == value(many)


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    rows = lm.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) and len(rows) > 50


def test_no_rows_and_no_training_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lm.score_documents(empty).count() == 0
    alone = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 10 == 0)
    r = lm.score_documents(spark.createDataFrame([(alone, "so new", "", 0)], SCHEMA)).first()
    assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 3) and math.isfinite(r.score) and math.isfinite(r.base_score)


def test_all_texts_decide_the_classes(spark, monkeypatch):
    rng = np.random.default_rng(4)
    tongues = [[f"{c}{i}" for i in range(60)] for c in "abz"]
    texts = [" ".join(rng.choice(tongues[k], 40)) for k in [0, 1] * 150 + [2] * 12]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    monkeypatch.setattr(lm, "CLASS_SAMPLE", 8)
    found = lm.train(docs, classes=3).classes
    assert {w.decode() for w in found.words} == {w for each in tongues for w in each}

    words = lm.common_words(docs)
    counts = np.zeros((len(texts), len(words)))
    for row, text in zip(counts, texts, strict=True):
        np.add.at(row, [words[w] for w in text.encode().split()], 1)

    def another(logs):
        chosen = (counts @ logs).argmax(axis=1)
        return lm._class_logs(np.stack([counts[chosen == k].sum(axis=0) for k in range(3)]))

    assert found.words == words and np.allclose(another(found.logs[:-1]), found.logs[:-1])  # settled on all texts
    start = lm.fit_classes(texts[:8], words, 3)  # has no text of the rare tongue
    logs = start.logs[:-1]
    for _ in range(lm.CLASS_ROUNDS):
        logs = another(logs)
    assert np.allclose(lm.refine_classes(docs, start).logs[:-1], logs)
    empty = lm.common_words(docs.limit(0))
    assert empty == {} and lm.refine_classes(docs, lm.fit_classes([], empty)).words == {}


def test_counts_passed_on_in_parts_add_up(spark):
    """Far more distinct words in one batch than a task keeps."""
    from distaff.llm import lattice_lm

    texts = spark.range(0, 250, 1, 1).selectExpr(
        "concat_ws(' ', 'all all', if(id % 2 = 0, 'half', null), transform(sequence(0, 999), x -> concat('w', id * 1000 + x))) AS text"
    )
    assert 250 * 1000 > 2 * lattice_lm.COUNTED_WORDS
    assert list(lattice_lm.common_words(texts, 3)) == [b"all", b"half", b"w0"]


ODD = ["The CAT  sat", None, "", " \t\n", "\x0b a\x0cB\rc ", "É e\u0085x\x1cy  z", "İI K the the The", "a" * 3000 + " a"]


def test_words_of_a_column_are_those_of_each_text():
    import pyarrow as pa

    for texts in (ODD, ODD[1:4], []):
        column = pa.array([*ODD, *texts], pa.string()).slice(len(ODD))
        sizes, words = lm._words(column)
        split = [lm._tokens(t) for t in texts]
        assert sizes.tolist() == [len(t) for t in split] and words.to_pylist() == [w for t in split for w in t]
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        assert all([t for part in lm._parts([batch], size) for t in part.to_pylist()] == texts for size in (1, 10, 1 << 20))
        coded = words.dictionary_encode()
        held = [sum(w in t for t in split) for w in coded.dictionary.to_pylist()]
        assert all(lm._holders(sizes, coded.indices.to_numpy(), len(held), n).tolist() == held for n in (1, 2, 250))
    assert lm._sums(np.array([1.0, 2.0, 4.0]), np.array([0, 2, 0, 1, 0])).tolist() == [0, 3, 0, 4, 0]


def test_a_round_reads_every_common_word_of_a_text_once():
    import pyarrow as pa

    words = [b"the", b"cat", b"of"]
    texts = ["the " * 5000 + "cat new", *ODD, "of the of"]
    places, counts, sizes = lm.common_counts(pa.array(texts), pa.array(words))
    assert len(places) == 2 + 2 + 1 + 2  # not every occurrence
    plain = [[t.count(w) for w in words] for t in map(lm._tokens, texts)]
    row = np.repeat(np.arange(len(texts)), sizes)
    got = np.zeros((len(texts), 3), dtype=int)
    got[row, places] = counts
    assert got.tolist() == plain
    logs = np.log(np.array([[0.5, 0.2, 0.2], [0.3, 0.4, 0.2], [0.2, 0.4, 0.6], [1, 1, 1]]))
    classes = lm.Classes({w: i for i, w in enumerate(words)}, logs)
    of_words, found = lm._words(pa.array(texts))
    assert classes.of(lm._places(found, classes.listed), of_words).tolist() == (np.array(plain) @ logs[:-1]).argmax(axis=1).tolist()


def test_words_of_all_classes_recurse_together(pieces):
    rng = np.random.default_rng(1)
    words = ["thonnd", "ndthon", "erre", "éelle", "onnd", "日", "a", "erre"]
    kinds = np.array([0, 1, 2, 0, 1, 2, 0, 1])
    weights = np.stack([lm.log_weights(pieces, rng.random(len(pieces.first) + 2)) for _ in range(3)])
    uses = lm.expected_counts(pieces, weights, words, kinds)
    together = lm.spelling(pieces, weights, words, kinds)
    for k in range(3):
        mine = [w for w, kind in zip(words, kinds, strict=True) if kind == k]
        assert np.allclose(uses[k], lm.expected_counts(pieces, weights[k], mine))
        assert np.array_equal(together[kinds == k], lm.spelling(pieces, weights[k], mine))
