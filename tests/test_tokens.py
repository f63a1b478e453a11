"""Token arrays against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from distaff.operators import ordering, tokens


def masked(prompt, full, max_len, pad):
    """Masking rules in plain Python."""
    if len(full) > max_len or len(prompt) >= len(full):
        return None
    padding = max_len - len(full)
    ids = full + [pad] * padding
    return ids, [-100] * len(prompt) + full[len(prompt) :] + [-100] * padding


CASES = [
    ([1, 2], [1, 2, 3]),
    ([1], [1, 2, 3, 4, 5, 6]),
    ([1], [1, 2, 3, 4, 5, 6, 7]),
    ([1, 2], [1, 2]),
    ([], [5]),
    ([], []),
]


def test_mask_and_pad(spark):
    schema = (
        "i int, prompt_text string, full_text string, "
        "prompt_ids array<bigint>, full_ids array<bigint>"
    )
    rows = [(i, "p", "p q", p, f) for i, (p, f) in enumerate(CASES)]
    rows.append((99, "x", "p q", [1], [1, 2]))
    got = {r.i: r for r in tokens.mask_and_pad(spark.createDataFrame(rows, schema), 6, 9).collect()}
    for i, (prompt, full) in enumerate(CASES):
        expected = masked(prompt, full, 6, 9)
        if expected is None:
            assert got[i].skip_reason is not None and got[i].input_ids is None
        else:
            assert (got[i].input_ids, got[i].labels) == expected
    assert got[2].skip_reason == "too_long" and got[3].skip_reason == "empty_reply"
    assert got[99].skip_reason == "prompt_not_prefix"


@pytest.mark.parametrize("mask,fill", [("none", 0), ("pad", -100)])
def test_batch_padding(spark, mask, fill):
    rows = [(0, [1, 2, 3]), (0, [4]), (1, [5] * 9), (1, [])]
    df = spark.createDataFrame(rows, "batch_id int, token_ids array<bigint>")
    got = sorted(
        (r.batch_id, r.input_ids, r.labels)
        for r in tokens.truncate_and_pad_batch(df, max_len=4, mask=mask).collect()
    )
    assert got == sorted(
        [
            (0, [1, 2, 3], [1, 2, 3]),
            (0, [4, 0, 0], [4, fill, fill]),
            (1, [5] * 4, [5] * 4),
            (1, [0] * 4, [fill] * 4),
        ]
    )


@pytest.mark.parametrize("rows,size", [(10, 4), (12, 4), (3, 4), (1, 1)])
def test_micro_batches(spark, rows, size):
    keys = list(range(rows))
    random.Random(0).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(3)
    for drop in (True, False):
        got = {r.k: (r.batch_id, r.slot) for r in ordering.micro_batches(df, size, drop, "k").collect()}
        last = rows // size * size if drop else rows
        assert got == {k: (k // size, k % size) for k in range(last)}


def test_dense_index_with_ties_is_complete(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    rows = ordering.dense_index(df, "k", "id").collect()
    order = [(r.k, r.id) for r in sorted(rows, key=lambda r: r.position)]
    assert [r for r in sorted(x.position for x in rows)] == list(range(500))
    assert order == sorted(order)


def test_head_slice_equals_sorted(spark):
    df = spark.range(0, 5000, 1, 40).select((F.col("id") * 7919 % 5003).alias("k"))
    got = [r.k for r in ordering.head_slice(df, 25, "k").collect()]
    assert got == sorted((i * 7919) % 5003 for i in range(5000))[:25]


def test_previous_value_across_chunks(spark):
    steps = {"a": [0, 1, 2, 9, 10, 11, 57, 58, 300], "b": [4], "c": [25, 99]}
    df = spark.createDataFrame([(r, s) for r, v in steps.items() for s in v], "run string, step int")
    got = {(r.run, r.step): r.previous for r in ordering.previous_value(df, "run", "step", 10).collect()}
    expected = {
        (run, s): ([None] + v)[i] for run, v in steps.items() for i, s in enumerate(v)
    }
    assert got == expected


def test_tokenize_equals_python(spark):
    texts = ["b a b", "", "  c\n\ta ", "zz a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 7)], "token string, id int")
    got = {r.id: r.token_ids for r in tokens.tokenize(docs, vocab, unknown_id=99).collect()}
    known = {"a": 0, "b": 1, "c": 7}
    assert got == {i: [known.get(w, 99) for w in t.split()] for i, t in enumerate(texts)}
    assert tokens.vocab_size(vocab).first().vocab_size == 8
    assert tokens.vocab_size(vocab.limit(0)).first().vocab_size == 0


def test_batch_widths_from_lengths_alone(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(4), [1] * rng.randrange(0, 9)) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, batch_id int, token_ids array<bigint>")
    sizes = tokens.batch_widths(df.select("k", "batch_id", F.size("token_ids").alias("n")), "n", 6).drop("n")
    joined = tokens.truncate_and_pad_batch(df.drop("batch_id").join(sizes, "k"), max_len=6, width="width")
    plain = tokens.truncate_and_pad_batch(df, max_len=6)
    columns = ["k", "width", "input_ids", "labels"]
    assert sorted(joined.select(columns).collect()) == sorted(plain.select(columns).collect())


def test_vocab_is_dense(spark):
    docs = spark.createDataFrame([("b a",), ("c a",)], "text string")
    rows = tokens.build_vocab(docs).collect()
    assert {r.token: r.id for r in rows} == {"a": 0, "b": 1, "c": 2}


def test_uniform_length(spark):
    df = spark.createDataFrame(
        [([1, 2], [1]), ([1, 2], [1, 2]), ([1, 2], None)], "x array<int>, y array<int>"
    )
    rows = {r.column_name: r for r in tokens.uniform_length_check(df, ["x", "y"], 2).collect()}
    assert (rows["x"].shortest, rows["x"].longest, rows["x"].n_off) == (2, 2, 0)
    assert rows["y"].n_off == 2
    assert tokens.uneven_rows(df, ["x", "y"], 2).count() == 2


def test_tokenize_keeps_rows_and_columns_without_moving_them(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "b", "y"), (1, None, "z")], "id int, text string, other string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "token string, id int")
    out = tokens.tokenize(docs, vocab)
    assert sorted((r.other, r.token_ids) for r in out.collect()) == [("x", [0, 1]), ("y", [1]), ("z", None)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_large_vocabularies_are_joined_with_the_same_ids(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(60)], k=rng.randrange(0, 40))) for _ in range(200)]
    rows = [(i // 2, t, [i], "b") for i, t in enumerate(texts + ["hot  words\there"] * 150 + [None, "", None])]
    docs = spark.createDataFrame(rows, "id int, text string, row array<int>, block string").repartition(4)
    vocab = spark.createDataFrame([(f"w{i}", 100 - i) for i in range(0, 60, 2)] + [("hot", 7), ("hot", 5)], "token string, id int")
    direct = tokens.tokenize(docs, vocab)
    for block_bytes in (300, 1 << 23):
        joined = tokens.tokenize(docs, vocab, max_vocab=10, block_bytes=block_bytes)
        assert joined.columns == direct.columns
        assert sorted(map(repr, joined.collect())) == sorted(map(repr, direct.collect()))
    assert tokens.tokenize(docs.limit(0), vocab, max_vocab=1).count() == 0


def test_frequent_vocabulary(spark):
    docs = spark.createDataFrame([("b a b c",), ("d c b",), (None,)], "text string")
    assert sorted((r.id, r.token) for r in tokens.frequent_vocab(docs, 3).collect()) == [(0, "b"), (1, "c"), (2, "a")]


def test_missing_texts_are_counted_apart(spark):
    schema = "prompt_text string, full_text string, prompt_ids array<bigint>, full_ids array<bigint>"
    rows = [(None, "p", [1], [1, 2]), ("p", "p q", None, [1, 2]), ("p", "p q", [1], [1, 2])]
    got = tokens.mask_and_pad(spark.createDataFrame(rows, schema), 4).collect()
    assert [r.skip_reason for r in got] == ["missing_text", "missing_text", None]


def test_too_long_head_slices_are_refused(spark):
    with pytest.raises(ValueError):
        ordering.head_slice(spark.range(3), 1_000_001, "id")


def test_stand_in_ids_see_every_character(spark, tmp_path):
    """Words alike in first character and length are different tokens."""
    import hashlib

    from distaff.plans.registry import QUERIES

    rows = [(i, "aa bb. cd ef " + word, "de") for i, word in enumerate(["stone", "store"] * 5)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    digest = lambda ids: hashlib.md5(",".join(map(str, ids)).encode()).hexdigest()
    ids = {i: [int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in text.split()] for i, text, _ in rows}
    masked = {r.doc_id: r for r in QUERIES["mask_and_pad"].build(spark, str(tmp_path)).collect()}
    batched = {r.doc_id: r for r in QUERIES["truncate_and_pad_batch"].build(spark, str(tmp_path)).collect()}
    for i, mine in ids.items():
        assert masked[i].input_md5 == digest(mine + [0] * (768 - len(mine)))
        assert masked[i].labels_md5 == digest([-100] * 2 + mine[2:] + [-100] * (768 - len(mine)))
        assert batched[i].input_md5 == batched[i].labels_md5 == digest(mine)
    assert len({r.input_md5 for r in masked.values()}) == len({r.input_md5 for r in batched.values()}) == 2


def test_tokenizers_get_batches_in_parts(spark):
    """However many rows a batch has, few texts at a time become lists; order and empty texts stay."""

    def encode(texts):
        assert sum(map(len, texts)) <= (1 << 20) + 5000
        return [[len(texts), *map(len, t.split(" "))] for t in texts]

    size = F.when(F.col("id") % 7 == 0, 0).otherwise(F.col("id") % 5 + 1).cast("int")
    text = F.when(F.col("id") % 11 != 0, F.repeat(F.lit("abc " * 250), size))
    docs = spark.range(0, 3000, 1, 1).select("id", text.alias("text"))
    got = tokens.tokenize_with(docs, encode, "text", "ids").collect()
    assert [r.id for r in got] == list(range(3000))
    for r in got:
        assert r.ids[1:] == [len(w) for w in (r.text or "").split(" ")] and r.ids[0] < 3000


def test_tokens_lie_between_four_separators_only(spark):
    texts = ["a\u00a0b a\x0bb\x0ca", "\r\na\t\tb \n", "\n", "", None]
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("a\u00a0b", 2)], "token string, id int")
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    expected = {0: [2, -1], 1: [0, 1], 2: [], 3: [], 4: None}
    for max_vocab in (10, 1):
        got = tokens.tokenize(docs, vocab, max_vocab=max_vocab).collect()
        assert {r.id: r.token_ids for r in got} == expected
