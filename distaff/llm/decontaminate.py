"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ten words, a window into shingles of three.
Ordered by how often the documents hold them, the rarest shingle of a window
is its necessary prefix: under full containment a document that has the window
has that shingle. Documents are joined on it alone; its place in the window
says where the window would start in the document, which must have room for
it there, and the words decide.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distaff.llm.common import ROW_KEY, in_slices, keyed_texts, same_row
from distaff.session import materialise

WINDOW, SHINGLE = 10, 3
#: Bits of the shingle filter. It is sent to every task, so its size is fixed:
#: a larger benchmark makes it let more through, never grow.
FILTER_BITS = 1 << 24
SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122 or 65 <= c <= 90))
TO_WORDS = bytes.maketrans(
    SEPARATORS + bytes(range(65, 91)), b" " * len(SEPARATORS) + bytes(range(97, 123))
)
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Runs of digits, letters and all characters beyond ASCII, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(TO_WORDS).split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash for each ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    out = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        out = (out ^ each[i : i + n]) * MIX
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, words, shingles): each window of each item; items without words have none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, hashes = [], [], []
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                tokens = words_of(text)
                length = min(window, len(tokens))
                size = min(SHINGLE, length)
                each = shingle_hashes(tokens, size) if tokens else []
                for start in range(len(tokens) - length + 1 if tokens else 0):
                    ids.append(item)
                    words.append(b" ".join(tokens[start : start + length]).decode("utf-8", "surrogatepass"))
                    hashes.append(each[start : start + length - size + 1].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words, pa.string()), pa.array(hashes, pa.list_(pa.int64()))],
                ["item_id", "words", "shingles"],
            )

    texts = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).distinct()
    return texts.mapInArrow(cut, "item_id bigint, words string, shingles array<bigint>").distinct()


def _filter_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bit set with a bit for each ``hash``, merged by word of 64 bits: at most ``bits`` / 64 rows."""
    slot = F.pmod("hash", F.lit(bits))
    rows = (
        hashes.groupBy(F.floor(slot / 64).alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(hash, {bits}) % 64 AS INT))")).alias("word"))
        .toPandas()
    )
    words = np.zeros(bits // 64, dtype=np.int64)
    words[rows["at"].to_numpy(dtype=np.int64)] = rows["word"].to_numpy(dtype=np.int64)
    return words


def _passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes % (len(words) * 64)
    return (words[slot >> 6] >> (slot & 63)) & 1 == 1


def find_windows(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, filter_bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """Sizes and hits of the documents.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text); other columns
    are ignored. Sizes: (doc_id, text_hash, n_words), one row per document row.
    Hits: (doc_id, text_hash, start, length, item_id), one for each occurrence
    of a window of an item; rows equal in id and text share theirs. Null texts
    have no words, null ids are kept, an empty side gives no hits.
    """
    texts = keyed_texts(docs)
    spark = docs.sparkSession
    windows = materialise(item_windows(benchmark, window), "item-windows")
    lengths = F.least(F.lit(SHINGLE), F.size(F.split("words", " ")))
    sizes = sorted(r[0] for r in windows.select(lengths.alias("n")).distinct().collect())
    shingles = windows.select(F.explode("shingles").alias("hash")).distinct()
    known = spark.sparkContext.broadcast(_filter_of(shingles, filter_bits))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for part in in_slices([batch]):
                for text in part["text"].to_pylist():
                    tokens = words_of(text)
                    for size in sizes:
                        each = shingle_hashes(tokens, size)
                        found.append(each[_passes(known.value, each)])
            each, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(each), pa.array(n.astype(np.int64))], ["hash", "n"])

    frequency = texts.select("text").mapInArrow(counts, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    rarest = (
        windows.select("item_id", "words", F.posexplode("shingles").alias("offset", "hash"))
        .join(frequency, "hash", "left")
        .groupBy("item_id", "words")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("prefix"))
        .filter("prefix.n > 0")
        .select("item_id", "words", F.size(F.split("words", " ")).alias("length"), "prefix.hash", "prefix.offset")
    )
    prefixes = materialise(rarest, "item-prefixes")
    wanted = spark.sparkContext.broadcast(_filter_of(prefixes.select("hash").distinct(), filter_bits))

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sizes, and the shingles that may be prefixes with the words around them."""
        for batch in in_slices(batches):
            n_words, found = [], []
            for text in batch["text"].to_pylist():
                tokens = words_of(text)
                n_words.append(len(tokens))
                mine = []
                for size in sizes:
                    each = shingle_hashes(tokens, size)
                    for at in np.flatnonzero(_passes(wanted.value, each)).tolist():
                        first = max(0, at - window + 1)
                        around = b" ".join(tokens[first : at + window]).decode("utf-8", "surrogatepass")
                        mine.append({"hash": int(each[at]), "at": at, "first": first, "around": around})
                found.append(mine)
            kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("first", pa.int64()), ("around", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(n_words, pa.int64()), pa.array(found, kind)],
                [*ROW_KEY, "n_words", "found"],
            )

    rows = materialise(
        texts.mapInArrow(
            matches,
            "doc_id bigint, text_hash bigint, n_words bigint, "
            "found array<struct<hash:bigint,at:bigint,first:bigint,around:string>>",
        ),
        "prefix-matches",
    )
    start = F.col("at") - F.col("offset")
    around = F.split("around", " ")
    there = F.array_join(F.slice(around, (start - F.col("first") + 1).cast("int"), F.col("length")), " ")
    hits = (
        rows.filter(F.size("found") > 0)
        .select(*ROW_KEY, "n_words", F.explode("found").alias("f"))
        .select(*ROW_KEY, "n_words", "f.*")
        .join(prefixes, "hash")
        .filter((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .filter(there == F.col("words"))
        .select(*ROW_KEY, start.alias("start"), F.col("length").cast("bigint").alias("length"), "item_id")
        .distinct()
    )
    return rows.select(*ROW_KEY, "n_words"), hits


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, item_ids, contaminated) for every document row.

    ``n_hit`` counts the words inside any occurrence of a window; ``item_ids``
    are the items with an occurring window, sorted as strings.
    """
    sizes, hits = find_windows(docs, benchmark, window)
    hits = materialise(hits, "window-hits")
    covered = (
        hits.select(*ROW_KEY, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("at"))
        .groupBy(*ROW_KEY, "at")
        .agg(F.lit(1).alias("one"))
        .groupBy(*ROW_KEY)
        .agg(F.count("*").alias("n_hit"))
    )
    items = (
        hits.filter("item_id IS NOT NULL")
        .groupBy(*ROW_KEY, F.col("item_id").cast("string").alias("item"))
        .agg(F.lit(1).alias("one"))
        .groupBy(*ROW_KEY)
        .agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    )
    no_items: Column = F.expr("CAST(array() AS array<string>)")
    found = covered.alias("c").join(items.alias("i"), same_row_names("c", "i"), "left").select(
        *[F.col(f"c.{k}").alias(k) for k in ROW_KEY], "n_hit", "item_ids"
    )
    return sizes.join(found, same_row(sizes, found), "left").select(
        *[sizes[k] for k in ROW_KEY],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("item_ids", no_items).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def same_row_names(left: str, right: str) -> Column:
    """``same_row`` for two aliases."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (
        F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash")
    )
