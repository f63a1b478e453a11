"""Word n-grams as rolling hashes, and a filter of fixed size that is asked before anything is shuffled.

Words are hashed by Spark; numpy rolls the hashes of a whole Arrow batch at
once. A gram is two 64-bit numbers, so a large table moves 16 bytes for each
gram that passes the filter and no text.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distaff.operators.tokens import words

#: Bits of the filter: 2 MB in each task, whatever is put in.
FILTER_BITS = 24
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
ROWS = 1000


def rolling(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, a, b) of every ``n``-gram of rows whose word hashes lie between ``offsets``.

    ``place`` counts in ``hashes``; grams never reach into the next row.
    """
    ends = np.repeat(offsets[1:], np.diff(offsets))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = np.flatnonzero(np.arange(offsets[0], offsets[0] + len(ends)) + n <= ends) + offsets[0]
    width = len(hashes) - n + 1
    if not len(place) or width < 1:
        empty = np.empty(0, np.uint64)
        return np.empty(0, np.int64), np.empty(0, np.int64), empty, empty
    rolled = []
    for m in MULTIPLIERS:
        total = np.zeros(width, dtype=np.uint64)
        for j in range(n):
            total = total * np.uint64(m) + hashes[j : j + width]
        rolled.append(total[place])
    return row[place - offsets[0]], place, *rolled


def _passes(a: np.ndarray, kept: np.ndarray) -> np.ndarray:
    at = a >> np.uint64(64 - FILTER_BITS)
    return kept[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) == 1


def gram_filter(grams: DataFrame) -> np.ndarray:
    """Bit set of the first hashes of ``grams``: at most ``2 ** FILTER_BITS / 64`` numbers reach the driver.

    The more grams it holds the more others pass, which costs a shuffle of
    those but never a result.
    """
    at = F.shiftrightunsigned("a", 64 - FILTER_BITS)
    words_of_bits = grams.filter("a IS NOT NULL").groupBy(F.shiftright(at, 6).alias("word"))
    found = words_of_bits.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))).alias("bits"))
    kept = np.zeros(1 << FILTER_BITS - 6, dtype=np.uint64)
    for word, bits in found.collect():
        kept[word] = np.uint64(bits & (1 << 64) - 1)
    return kept


def gram_table(
    df: DataFrame, ids: list[str], text: str, n: int, kept: np.ndarray | None = None, texts: bool = False, every_row: bool = False
) -> DataFrame:
    """(ids…, a, b) of the distinct ``n``-grams of each row, of those that pass ``kept`` where it is given.

    ``texts`` adds the words of the gram, ``every_row`` one row without hashes
    for texts that are null or too short. Without ``ids`` grams are distinct
    in batches of rows. Words lie between blanks, tabs and line ends.
    """
    sent = None if kept is None else df.sparkSession.sparkContext.broadcast(kept)
    split = words(F.col(text).cast("string"))
    columns = {"_hashes": F.transform(split, lambda w: F.xxhash64(w))} | ({"_words": split} if texts else {})
    rows = df.select(*ids, *[c.alias(name) for name, c in columns.items()])

    def grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                lists = batch["_hashes"].fill_null(pa.scalar([], batch["_hashes"].type))
                row, place, a, b = rolling(lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy().astype(np.int64), n)
                if sent is not None:
                    passed = _passes(a, sent.value)
                    row, place, a, b = row[passed], place[passed], a[passed], b[passed]
                order = np.lexsort((place, b, a, row if ids else np.zeros_like(row)))
                row, place, a, b = row[order], place[order], a[order], b[order]
                same = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & ((row[1:] == row[:-1]) | (not ids))
                first = np.concatenate([[True], ~same])[: len(row)]
                row, place, a, b = row[first], place[first], a[first], b[first]
                bare = np.setdiff1d(np.arange(batch.num_rows), row) if every_row else np.empty(0, np.int64)
                hashes = [pa.array(np.concatenate([x.view(np.int64), np.zeros(len(bare), np.int64)]), mask=np.arange(len(x) + len(bare)) >= len(x)) for x in (a, b)]
                out = {c: batch[c].take(pa.array(np.concatenate([row, bare]))) for c in ids} | {"a": hashes[0], "b": hashes[1]}
                if texts:
                    known = batch["_words"].fill_null(pa.scalar([], batch["_words"].type))
                    shift = known.offsets[0].as_py() - lists.offsets[0].as_py()
                    out["gram"] = pa.array([" ".join(known.values.slice(p + shift, n).to_pylist()) for p in place.tolist()] + [None] * len(bare), pa.string())
                yield pa.record_batch(out)

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in ids]
    return rows.mapInArrow(grams, ", ".join([*kinds, "a bigint", "b bigint", *(["gram string"] if texts else [])]))
