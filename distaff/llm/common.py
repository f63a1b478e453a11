"""Helpers shared by the operators on training data.

A document row is known by ``doc_id`` and the hash of its text (``ROW_KEY``):
ids may be null or repeated, and rows equal in both are the same document.
"""

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_KEY = ["doc_id", "text_hash"]
#: Names of the key beside columns of any other name.
ROW_ID, ROW_HASH = "__row_doc_id", "__row_text_hash"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text) with null texts as empty ones; other columns are dropped."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on ``ROW_KEY``; null ids are equal."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def fold(modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches cut into short ones, so that only few texts at a time are Python strings."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def in_blocks(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """(row, block) and the bytes of all texts.

    ``row`` is the whole input row with ``doc_id`` as long and ``text`` as
    string. Rows are dealt by a hash of both, so blocks hold about
    ``block_bytes`` of text each, however much there is.
    """
    rows = docs.withColumns({"doc_id": F.col("doc_id").cast("bigint"), "text": F.col("text").cast("string")})
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(total // block_bytes + 1))
    return rows.select(F.struct("*").alias("row"), block.alias("block")), total


def drawn_by_hash(count: int, limit: int, *key: str) -> Column:
    """Whether a row is among about twice ``limit`` of ``count`` rows, by the hash of ``key``."""
    rate = min(1.0, 2 * limit / max(1, count))
    return F.pmod(F.xxhash64(*key), F.lit(1 << 30)) <= int(rate * (1 << 30))


def hashed_sample(rows: DataFrame, limit: int, *key: str, count: int | None = None) -> DataFrame:
    """At most ``limit`` rows: those of the smallest hashes of ``key`` among about twice as many.

    The rate follows the number of rows, so what all tasks send together stays
    bounded as the table grows; ``count`` is that number where it is known.
    ``key`` must be distinct, as copies are drawn together; ``distinct_sample``
    takes rows with copies.
    """
    drawn = rows.filter(drawn_by_hash(rows.count() if count is None else count, limit, *key))
    return drawn.orderBy(F.xxhash64(*key), *key).limit(limit)


def distinct_sample(rows: DataFrame, limit: int, key: str) -> DataFrame:
    """At most ``limit`` distinct values of ``key``, each once however many rows hold it.

    Only 128-bit hashes are made distinct and drawn; then one value of each
    hash drawn is fetched, copies being dropped where they are read.
    """
    hashes = [F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g")]
    distinct = rows.select(*hashes).distinct()
    rate = min(1.0, 2 * limit / max(1, distinct.count()))
    drawn = distinct.filter(F.pmod("h", F.lit(1 << 30)) <= int(rate * (1 << 30))).orderBy("h", "g").limit(limit).collect()
    chosen = F.broadcast(rows.sparkSession.createDataFrame(drawn, "h bigint, g bigint"))
    found = rows.select(key, *hashes).join(chosen, ["h", "g"]).groupBy("h", "g").agg(F.first(key).alias(key))
    return found.orderBy("h", "g").select(key)
