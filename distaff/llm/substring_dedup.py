"""Removal of repeated passages, with a count-min sketch before the exact pass.

Documents are dealt into blocks of bounded text. First every block sends a
sketch of its windows of 20 words, sparse and cut by ranges of cells; the
sketches of a range are merged, and each block is told which of its cells hold
two or more. Counts are never too low, so windows in lower cells occur once
and go no further. Then the blocks send the other windows, each once, by their
96-bit fingerprint, and are told which of them start earlier elsewhere. Blocks
and ranges grow in number with the text, not in size, and a window that every
document has is one entry of each block.
"""

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distaff.llm.common import in_blocks

WINDOW = 20
#: Text bytes of a block, and of the blocks whose windows one range of cells serves.
BLOCK_BYTES, RANGE_BYTES = 4 << 20, 8 << 20
#: Rows of the sketch. Each has at least as many cells as the text has bytes.
DEPTH = 2
LAST = np.iinfo(np.int64).max
MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _pack(values: np.ndarray) -> bytes:
    """Compressed by byte planes."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def _pack_steps(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)))


def _unpack_steps(data: bytes, dtype: type) -> np.ndarray:
    return np.cumsum(_unpack(data, dtype), dtype=dtype)


class _Block:
    """Rows of a block in order of (id, text), their words numbered through."""

    def __init__(self, table: pa.Table):
        rows = table["row"].combine_chunks()
        ids, texts = rows.field("doc_id").to_pylist(), rows.field("text").to_pylist()
        split = [("" if t is None else t).encode("utf-8", "surrogatepass").split() for t in texts]
        ids = [LAST if i is None else i for i in ids]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i] or ""))
        self.words = [split[i] for i in self.order]
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.ends = np.cumsum(self.lengths)
        self.doc_ids = np.array([ids[i] for i in self.order], dtype=np.int64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word and the two halves of the fingerprint of every window."""
        total = int(self.ends[-1]) if len(self.ends) else 0
        last = np.repeat(self.ends, self.lengths) - size
        starts = np.flatnonzero(np.arange(total) <= last)
        if not len(starts):
            return starts, np.empty(0, np.uint64), np.empty(0, np.uint64)
        digest = xxhash.xxh3_64_intdigest
        each = np.fromiter((digest(w) for words in self.words for w in words), dtype=np.uint64, count=total)
        halves = []
        for m in MULTIPLIERS:
            h = np.zeros(total - size + 1, dtype=np.uint64)
            for i in range(size):
                h *= m
                h += each[i : i + len(h)]
            h = h[starts]
            h ^= h >> np.uint64(32)
            h *= MULTIPLIERS[0]
            h ^= h >> np.uint64(29)
            halves.append(h)
        return starts, *halves

    def place(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id of the document and place in it of window starts."""
        doc = np.searchsorted(self.ends, starts, side="right")
        return self.doc_ids[doc], starts - (self.ends - self.lengths)[doc]


def _cells(fingerprint: np.ndarray, cell_bits: int, range_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted cells, each window's place among them, their counts, and where each range begins."""
    cells, at, counts = np.unique(fingerprint >> np.uint64(64 - cell_bits), return_inverse=True, return_counts=True)
    begins = np.searchsorted(cells, np.arange((1 << range_bits) + 1, dtype=np.uint64) << np.uint64(cell_bits - range_bits))
    return cells, at, counts, begins


def _after(ids: np.ndarray, starts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether each window starts after window ``first`` of its group."""
    return (ids > ids[first]) | ((ids == ids[first]) & (starts > starts[first]))


def _first_of_equal(h1: np.ndarray, h2: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each window the earliest one with its fingerprint."""
    order = np.lexsort((starts, ids, h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.empty(len(order), dtype=np.int64)
    first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return first


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(row, n_words, n_removed, kept) for every row of ``docs``.

    ``docs`` has (doc_id, text); ``row`` is the whole input row, whatever its
    other columns are called. A word goes when a window over it also starts
    earlier: under a smaller ``doc_id``, or under the same one at a smaller
    word. Windows are judged on the input. Null ids come after all others; rows
    that share an id are judged alike, so exact repeats of a row keep the same
    words. ``kept`` joins the other words with one space; null texts have none.
    Fingerprints of 96 bits stand for windows: among 10^12 windows two differing
    ones would meet with a chance of 1 in 10^5.
    """
    dealt, total = in_blocks(docs, block_bytes)
    range_bits = (total // range_bytes).bit_length()
    cell_bits = max(total.bit_length(), range_bits + 3)

    def sketch(key: tuple, table: pa.Table) -> pa.Table:
        _, *halves = _Block(table).windows(window)
        out = {"depth": [], "range": [], "cells": [], "more": []}
        for depth, half in enumerate(halves[:DEPTH]):
            cells, _, counts, begins = _cells(half, cell_bits, range_bits)
            for r in np.flatnonzero(np.diff(begins)).tolist():
                part = slice(begins[r], begins[r + 1])
                out["depth"].append(depth)
                out["range"].append(r)
                out["cells"].append(_pack_steps(cells[part]))
                out["more"].append(np.packbits(counts[part] > 1).tobytes())
        kinds = {"depth": pa.int32(), "range": pa.int32(), "cells": pa.binary(), "more": pa.binary()}
        made = pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})
        return made.append_column("block", pa.array([key[0].as_py()] * len(made), pa.int64()))

    sketches = dealt.groupBy("block").applyInArrow(sketch, "depth int, range int, cells binary, more binary, block bigint")

    def merge(table: pa.Table) -> pa.Table:
        """Which cells of each block have a merged count of two or more."""
        each = [_unpack_steps(c, np.uint64) for c in table["cells"].to_pylist()]
        more = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(c)) for m, c in zip(table["more"].to_pylist(), each, strict=True)]
        _, at = np.unique(np.concatenate(each), return_inverse=True)
        hot = np.bincount(at, weights=1 + np.concatenate(more)) >= 2
        ends = np.cumsum([len(c) for c in each])[:-1]
        told = [np.packbits(bits).tobytes() for bits in np.split(hot[at], ends)]
        return pa.table({"block": table["block"], "depth": table["depth"], "range": table["range"], "hot": pa.array(told, pa.binary())})

    told = sketches.groupBy("depth", "range").applyInArrow(merge, "block bigint, depth int, range int, hot binary")

    def candidates(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        block = _Block(table)
        starts, *halves = block.windows(window)
        flagged = np.ones(len(starts), dtype=bool)
        answers = {(d, r): h for d, r, h in zip(*(told[c].to_pylist() for c in ("depth", "range", "hot")), strict=True)}
        for depth, half in enumerate(halves[:DEPTH]):
            cells, at, _, begins = _cells(half, cell_bits, range_bits)
            hot = np.zeros(len(cells), dtype=bool)
            for r in np.flatnonzero(np.diff(begins)).tolist():
                n = int(begins[r + 1] - begins[r])
                hot[begins[r] : begins[r + 1]] = np.unpackbits(np.frombuffer(answers[depth, r], np.uint8), count=n)
            flagged &= hot[at]
        starts, h1, h2 = starts[flagged], halves[0][flagged], (halves[1][flagged] >> np.uint64(32)).astype(np.uint32)
        ids, places = block.place(starts)
        gone = _after(ids, places, _first_of_equal(h1, h2, ids, places))
        names = ("range", "h1", "h2", "ids", "places", "starts")
        out: dict[str, list] = {n: [] for n in names}

        def send(r: int, rows: np.ndarray, judged: bool) -> None:
            values = (
                r,
                None if judged else _pack(h1[rows]),
                None if judged else _pack(h2[rows]),
                None if judged else _pack_steps(ids[rows]),
                None if judged else _pack(places[rows].astype(np.uint32)),
                _pack_steps(starts[rows]),
            )
            for name, value in zip(names, values, strict=True):
                out[name].append(value)

        if gone.any():
            send(0, np.flatnonzero(gone), judged=True)
        open_ = np.flatnonzero(~gone)
        ranges = (h1[open_] >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(open_), np.int64)
        order = np.argsort(ranges, kind="stable")
        for rows in np.split(open_[order], np.flatnonzero(np.diff(ranges[order])) + 1):
            if len(rows):
                send(int(h1[rows[0]] >> np.uint64(64 - range_bits)) if range_bits else 0, rows, judged=False)
        made = pa.table({n: pa.array(v, pa.int32() if n == "range" else pa.binary()) for n, v in out.items()})
        return made.append_column("block", pa.array([key[0].as_py()] * len(made), pa.int64()))

    sent = (
        dealt.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(
            candidates,
            "range int, h1 binary, h2 binary, ids binary, places binary, starts binary, block bigint",
        )
    )
    # Windows a block has judged itself only pass through, dealt out by block.
    sent = sent.withColumn("block_too", F.when(F.col("h1").isNull(), F.col("block")).otherwise(-1))

    def judge(table: pa.Table) -> pa.Table:
        """Of each block the windows that start earlier in another one."""
        done = table.filter(pa.compute.is_null(table["h1"]))
        asked = table.filter(pa.compute.is_valid(table["h1"]))
        blocks, gone = done["block"].to_pylist(), done["starts"].to_pylist()
        if len(asked):
            starts = [_unpack_steps(s, np.int64) for s in asked["starts"].to_pylist()]
            h1, h2, places = (
                np.concatenate([_unpack(x, kind) for x in asked[name].to_pylist()])
                for name, kind in (("h1", np.uint64), ("h2", np.uint32), ("places", np.uint32))
            )
            ids = np.concatenate([_unpack_steps(x, np.int64) for x in asked["ids"].to_pylist()])
            late = _after(ids, places, _first_of_equal(h1, h2, ids, places))
            ends = np.cumsum([len(s) for s in starts])[:-1]
            for block, mine, theirs in zip(asked["block"].to_pylist(), starts, np.split(late, ends), strict=True):
                if theirs.any():
                    blocks.append(block)
                    gone.append(_pack_steps(mine[theirs]))
        return pa.table({"block": pa.array(blocks, pa.int64()), "gone": pa.array(gone, pa.binary())})

    judged = sent.groupBy("range", "block_too").applyInArrow(judge, "block bigint, gone binary")

    def apply(table: pa.Table, judged: pa.Table) -> pa.Table:
        block = _Block(table)
        total = int(block.ends[-1]) if len(block.ends) else 0
        steps = np.zeros(total + 1, dtype=np.int64)
        for gone in judged["gone"].to_pylist():
            starts = _unpack_steps(gone, np.int64)
            steps[starts] += 1
            steps[starts + window] -= 1
        covered = np.cumsum(steps[:total]) > 0
        removed, kept = [], []
        for words, gone in zip(block.words, np.split(covered, block.ends[:-1]), strict=True):
            removed.append(int(gone.sum()))
            left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if removed[-1] else words
            kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
        return pa.table(
            {
                "row": table["row"].take(pa.array(block.order)),
                "n_words": pa.array(block.lengths),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )

    return (
        dealt.groupBy("block")
        .cogroup(judged.groupBy("block"))
        .applyInArrow(apply, f"row {dealt.schema['row'].dataType.simpleString()}, n_words bigint, n_removed bigint, kept string")
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; texts without any stay as they are."""
    cut = remove_repeats(docs, window)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    return cut.select(F.col("row").withField("text", text).alias("row")).select("row.*")
