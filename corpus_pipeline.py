"""Corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns their columns; the last adds ``copies``, how often the mix
takes a document. Rows stay as they are but for ``text`` and ``n_chars`` of
documents that lose a repeated passage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distaff.llm import decontaminate, mixing, simhash, substring_dedup, toxicity
from distaff.llm.common import ROW_HASH, ROW_ID, read_table
from distaff.operators.ordering import running
from distaff.session import configure, materialise

#: Boosted and compressed scores, windows and seeded choices are beyond SQL;
#: the tests hold the stages against brute force.
ORACLE_SQL = None


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({ROW_ID: F.col("doc_id").cast("bigint"), ROW_HASH: F.xxhash64(text)})


def _matches(docs: DataFrame, rows: DataFrame):
    return docs[ROW_ID].eqNullSafe(rows["doc_id"]) & (docs[ROW_HASH] == rows["text_hash"])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, learnt from the labels of documents still there.

    Null and empty texts score as texts without words. Repeated rows score
    alike, so all or none of them stay. Without labels nothing is learnt and
    the constant score decides. No documents, no rows.
    """
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, by the SimHash operator's own shingles and bits.

    That of the smallest id stays, of rows that share it one; null ids come
    last. Texts without words, null ones included, are linked like any other.
    """
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that start earlier elsewhere.

    A text that loses nothing stays as it is, null ones too; one that is all
    repeats becomes empty. Repeated rows are judged alike by their place.
    """
    cut = substring_dedup.remove_repeats(docs)
    row = F.col("row").withField("text", F.col("kept"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("kept").cast(docs.schema["n_chars"].dataType))
    return cut.select(F.when(F.col("n_removed") > 0, row).otherwise(F.col("row")).alias("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark; null and empty texts have none, repeated rows stay or go together."""
    _, hits = decontaminate.find_windows(docs, read_table(spark, sf_dir, "benchmark"))
    bad = hits.select("doc_id", "text_hash").distinct()
    keyed = _keyed(docs)
    return keyed.join(bad, _matches(keyed, bad), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies``; an input column of that name gives way.

    Texts without words are never taken. Where the mix takes some of the rows
    that are equal in id, text and source, so many of them are kept, the first
    as they are read; they are numbered without bringing them together.
    """
    mixed = mixing.mix(docs).groupBy("doc_id", "text_hash", F.col("source").alias("mixed_source")).agg(
        F.min("copies").alias("low"),
        F.max("copies").alias("high"),
        F.sum("copies").alias("n_copies"),
        F.count("*").alias("n"),
    )
    mixed = materialise(mixed.filter("high > 0"), "mixed")
    keyed = _keyed(docs)
    same = _matches(keyed, mixed) & keyed["source"].cast("string").eqNullSafe(mixed["mixed_source"])
    kept = [c for c in docs.columns if c != "copies"]
    row = F.struct(*[keyed[c] for c in kept])
    found = keyed.join(mixed, same).select(row.alias("row"), keyed[ROW_ID], keyed[ROW_HASH], "mixed_source", "low", "high", "n_copies", "n")
    alike = found.filter("low = high").select("row.*", F.col("low").alias("copies"))
    # Equal rows get ``low`` or one more.
    some = running(found.filter("low < high"), [ROW_ID, ROW_HASH, "mixed_source"], [], {"nth": ("sum", F.lit(1))})
    copies = F.col("low") + (F.col("nth") < F.col("n_copies") - F.col("low") * F.col("n")).cast("int")
    return alike.unionByName(some.withColumn("copies", copies).filter("copies > 0").select("row.*", "copies"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query ``pipeline``."""
    return run(configure(spark), sf_dir)
