"""Token arrays: encoding, masking, padding and shape checks."""

from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from distaff.constants import IGNORE_LABEL, MAX_SEQUENCE, MAX_TRAIN_TOKENS, MAX_VOCABULARY
from distaff.operators.ordering import dense_index, head_slice
from distaff.session import materialise

SEPARATOR = r"[ \t\n\r]+"
#: Text bytes that a tokenizer is given at once.
ENCODE_BYTES = 1 << 20


def words(text: Column, separator: str = SEPARATOR) -> Column:
    """Tokens of a text in order: what lies between separators."""
    return F.array_remove(F.split(text, separator), "")


def build_vocab(df: DataFrame, text: str = "text", separator: str = SEPARATOR) -> DataFrame:
    """(token, id): the distinct tokens of a corpus, numbered in token order."""
    tokens = df.select(F.explode(words(F.col(text), separator)).alias("token")).distinct()
    return dense_index(tokens, "token", name="id")


def vocab_size(vocab: DataFrame) -> DataFrame:
    """Width that covers every id: ``max(count, max_id + 1)``."""
    return vocab.agg(
        F.greatest(F.count("*"), F.coalesce(F.max("id"), F.lit(-1)) + 1).alias("vocab_size")
    )


def _split(text: str) -> list[str]:
    """``words`` in Python, in half the time of a pattern."""
    return [*filter(None, text.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" "))]


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in order, in parts of about ``ENCODE_BYTES``; at least one."""
    part = np.cumsum(pa.compute.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64) // ENCODE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for start, end in zip(cuts, cuts[1:]):
        yield texts.slice(start, end - start)


def tokenize(
    df: DataFrame,
    vocab: DataFrame,
    text: str = "text",
    name: str = "token_ids",
    unknown_id: int = -1,
    max_vocab: int = MAX_VOCABULARY,
    block_bytes: int = 1 << 23,
) -> DataFrame:
    """Add each text's tokens looked up in a vocabulary table (token, id).

    A vocabulary is counted first. Up to ``max_vocab`` tokens it is sent to
    every task and texts are looked up where they are: no row moves. A larger
    one is joined with the distinct words of each block of rows, with the same
    ids. Null texts give null ids, repeated keys stay apart, a token that the
    vocabulary names twice has its smallest id. Tokens lie between blanks,
    tabs and line ends.
    """
    vocab = vocab.groupBy(F.col("token").cast("string").alias("token")).agg(F.min("id").cast("bigint").alias("id"))
    if vocab.count() > max_vocab:
        return _tokenize_joined(df, vocab, text, name, unknown_id, block_bytes)
    pairs = vocab.toPandas()
    ids = dict(zip(pairs["token"], pairs["id"].tolist()))
    known = df.sparkSession.sparkContext.broadcast(ids)

    @F.arrow_udf("array<bigint>")
    def looked_up(texts: pa.Array) -> pa.Array:
        get, found = known.value.get, []
        for part in _parts(texts):
            split = [_split(t) if t is not None else () for t in part.to_pylist()]
            ends = np.zeros(len(split) + 1, dtype=np.int32)
            np.cumsum(np.fromiter(map(len, split), dtype=np.int32, count=len(split)), out=ends[1:])
            got = np.fromiter(map(get, chain.from_iterable(split), repeat(unknown_id)), dtype=np.int64, count=int(ends[-1]))
            found.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(got), mask=part.is_null()))
        return pa.concat_arrays(found)

    return df.withColumn(name, looked_up(F.col(text)))


def _tokenize_joined(
    df: DataFrame, vocab: DataFrame, text: str, name: str, unknown_id: int, block_bytes: int
) -> DataFrame:
    """``tokenize`` by a join of distinct (block, word) pairs.

    Rows are dealt into blocks of about ``block_bytes`` of text, equal ones
    apart, and written once. A word is joined once for each block that has it,
    so one that every text has is no hot key, and a block's rows meet the ids
    of their own words only.
    """
    total = df.agg(F.sum(F.octet_length(F.col(text)).cast("bigint"))).first()[0] or 0
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.col(text)), F.lit(total // block_bytes + 1))
    rows = materialise(df.select(F.struct("*").alias("row"), F.col(text).alias("said"), block.alias("block")), "blocks")
    pairs = rows.select(F.col("block").alias("word_block"), F.explode(F.array_distinct(words(F.col("said")))).alias("token")).distinct()
    known = pairs.join(vocab, "token").select("word_block", "token", "id")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = dict(zip(right["token"].to_pylist(), right["id"].to_pylist()))
        found = [[ids.get(w, unknown_id) for w in _split(t)] if t is not None else None for t in left["said"].to_pylist()]
        return pa.table({"row": left["row"], "found": pa.array(found, pa.list_(pa.int64()))})

    schema = T.StructType([T.StructField("row", df.schema), T.StructField("found", T.ArrayType(T.LongType()))])
    joined = rows.groupBy("block").cogroup(known.groupBy("word_block")).applyInArrow(look_up, schema)
    return joined.select(*[F.col("row")[c].alias(c) for c in df.columns if c != name], F.col("found").alias(name))


def frequent_vocab(df: DataFrame, size: int, text: str = "text", separator: str = SEPARATOR) -> DataFrame:
    """(token, id): the ``size`` most frequent tokens of a corpus, the first having id 0; ties in token order."""
    tokens = df.select(F.explode(words(F.col(text), separator)).alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    order = (F.desc("n"), F.asc("token"))
    return dense_index(head_slice(counts, size, *order), *order, name="id").select("token", "id")


def tokenize_with(
    df: DataFrame, encode: Callable[[list[str]], list[list[int]]], text: str, name: str
) -> DataFrame:
    """Add token ids from any tokenizer, called on parts of Arrow batches.

    Of a batch only about ``ENCODE_BYTES`` of text at a time are Python strings
    and lists of numbers, so what a task holds does not grow with its rows.
    """

    @F.arrow_udf("array<bigint>")
    def encoded(texts: pa.Array) -> pa.Array:
        found = []
        for part in _parts(texts):
            mine = [t if t is not None else "" for t in part.to_pylist()]
            found.append(pa.array(encode(mine), pa.list_(pa.int64())))
        return pa.concat_arrays(found)

    return df.withColumn(name, encoded(F.col(text)))


def mask_skip_reason(max_len: int = MAX_SEQUENCE) -> Column:
    """Why a rendered row cannot be masked; null where it can."""
    full, prompt = F.size("full_ids"), F.size("prompt_ids")
    parts = [F.col(c).isNull() for c in ("full_text", "prompt_text", "full_ids", "prompt_ids")]
    return (
        F.when(parts[0] | parts[1] | parts[2] | parts[3], "missing_text")
        .when(~F.startswith(F.col("full_text"), F.col("prompt_text")), "prompt_not_prefix")
        .when(full > max_len, "too_long")
        .when(prompt >= full, "empty_reply")
    )


def mask_and_pad(df: DataFrame, max_len: int = MAX_SEQUENCE, pad_id: int = 0) -> DataFrame:
    """Add ``input_ids`` and ``labels`` of exactly ``max_len`` entries.

    Labels ignore the prompt and the padding. Rows that do not fit carry
    their ``skip_reason`` and null arrays; nothing is truncated.
    """
    full, prompt = F.col("full_ids"), F.col("prompt_ids")
    padding = F.lit(max_len) - F.size(full)
    ignored = F.lit(IGNORE_LABEL).cast("bigint")
    reply = F.slice(full, F.size(prompt) + 1, F.greatest(F.size(full) - F.size(prompt), F.lit(0)))
    input_ids = F.concat(full, F.array_repeat(F.lit(pad_id).cast("bigint"), padding))
    labels = F.concat(
        F.array_repeat(ignored, F.size(prompt)), reply, F.array_repeat(ignored, padding)
    )
    fits = F.col("skip_reason").isNull()
    return (
        df.withColumn("skip_reason", mask_skip_reason(max_len))
        .withColumn("input_ids", F.when(fits, input_ids))
        .withColumn("labels", F.when(fits, labels))
    )


def length_filter(df: DataFrame, ids: str, max_len: int = MAX_SEQUENCE) -> DataFrame:
    """Rows that fit; longer ones are skipped, never cut."""
    return df.filter(F.size(ids) <= max_len)


def batch_widths(batches: DataFrame, length: str, max_len: int = MAX_TRAIN_TOKENS) -> DataFrame:
    """Add ``width``, the longest kept length of each batch, to rows of (batch_id, ``length``, …).

    Keys and lengths are all this needs, so that ids are joined once, at last.
    """
    longest = F.max(F.col(length)).over(Window.partitionBy("batch_id"))
    return batches.withColumn("width", F.least(longest, F.lit(max_len)))


def truncate_and_pad_batch(
    df: DataFrame,
    ids: str = "token_ids",
    max_len: int = MAX_TRAIN_TOKENS,
    pad_id: int = 0,
    mask: str = "none",
    width: str | None = None,
) -> DataFrame:
    """Cut rows to ``max_len`` and pad to the longest row of their batch.

    ``width`` names a column that holds that length (``batch_widths``);
    without it the rows of a ``batch_id`` are brought together. Labels copy
    the ids; ``mask='pad'`` ignores the padding in them.
    """
    kept = F.slice(F.col(ids), 1, max_len)
    cut = df.withColumn("_kept", kept)
    if width is None:
        cut = batch_widths(cut.withColumn("_size", F.size("_kept")), "_size", max_len).drop("_size")
    elif width != "width":
        cut = cut.withColumn("width", F.col(width))
    padding = F.col("width") - F.size("_kept")
    fill = {"none": pad_id, "pad": IGNORE_LABEL}[mask]
    return (
        cut.withColumn(
            "input_ids", F.concat("_kept", F.array_repeat(F.lit(pad_id).cast("bigint"), padding))
        )
        .withColumn(
            "labels", F.concat("_kept", F.array_repeat(F.lit(fill).cast("bigint"), padding))
        )
        .drop("_kept")
    )


def uniform_length_check(df: DataFrame, columns: list[str], length: int) -> DataFrame:
    """Shortest and longest array of each column, and rows off ``length``."""
    sizes = df.select(*[F.size(c).alias(c) for c in columns])
    stats = []
    for c in columns:
        stats += [
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            F.count_if(F.coalesce(F.col(c), F.lit(-1)) != length).alias(f"{c}_off"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}_min").alias("shortest"),
                F.col(f"{c}_max").alias("longest"),
                F.col(f"{c}_off").alias("n_off"),
            )
            for c in columns
        ]
    )
    return sizes.agg(*stats).select(F.inline(rows))


def uneven_rows(df: DataFrame, columns: list[str], length: int) -> DataFrame:
    """Rows with an array whose size is not ``length``."""
    off = F.lit(False)
    for c in columns:
        off = off | (F.coalesce(F.size(c), F.lit(-1)) != length)
    return df.filter(off)
