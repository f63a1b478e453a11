"""How far the word use of the sources of a language lies apart, in exact integers.

``bytes.translate`` lowers A-Z and blanks every separator in one pass over a
text's UTF-8 bytes, ``bytes.split`` gives its terms and a ``Counter`` for each
document their frequencies. What the documents send on is sparse: one row for
each term a (lang, source) group has in a batch, with its occurrences and
documents. Everything after that is aggregation in Spark.
"""

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distaff.session import materialise

#: Letters A-Z become a-z, letters a-z and bytes from 0x80 stay, all else is a blank.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PIECE = 1 << 20
ENTRIES = 1 << 16
CELLS = 1 << 18
LEAST_DOCUMENTS = 3
PARTS = 1_000_000_000


def document_terms(text: bytes, piece: int = PIECE) -> Counter:
    """Terms of one text with their frequencies; long texts are split ``piece`` by ``piece`` at blanks."""
    clean, seen, at = text.translate(TERM_BYTES), Counter(), 0
    while at < len(clean):
        stop = clean.find(b" ", at + piece)
        stop = len(clean) if stop < 0 else stop
        seen.update(clean[at:stop].split())
        at = stop
    return seen


def _merged(groups: list[tuple[str, str]], sizes: list[int], terms: list[bytes], counts: list[int]) -> pa.RecordBatch:
    """Sums over the documents of each (group, term), and one empty term for every group."""
    code = {g: i for i, g in enumerate(dict.fromkeys(groups))}
    of = np.repeat(np.array([code[g] for g in groups], dtype=np.int32), sizes)
    table = pa.table({"g": of, "term": pa.array(terms, pa.binary()), "n": pa.array(counts, pa.int64())})
    merged = table.group_by(["g", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    g = np.concatenate([merged["g"].to_numpy(), np.arange(len(code), dtype=np.int32)])
    blank = np.zeros(len(code), dtype=np.int64)
    lang, source = (pa.array(names, pa.string()) for names in zip(*code, strict=True))
    return pa.record_batch(
        {
            "lang": lang.take(pa.array(g)),
            "source": source.take(pa.array(g)),
            "term": pa.concat_arrays([merged["term"].combine_chunks().cast(pa.binary()), pa.array([b""] * len(code), pa.binary())]),
            "n": np.concatenate([merged["n_sum"].to_numpy(), blank]),
            "docs": np.concatenate([merged["n_count"].to_numpy(), blank]),
        }
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group.

    Each occurring group also has the empty term with zeros, so groups without
    terms stay known. Null text, lang and source are empty; other columns are
    dropped.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, sizes, terms, counts = [], [], [], []
        for batch in batches:
            for row in range(batch.num_rows):
                seen = document_terms(batch["text"][row].as_py())
                groups.append((batch["lang"][row].as_py(), batch["source"][row].as_py()))
                sizes.append(len(seen))
                terms.extend(seen)
                counts.extend(seen.values())
                if len(terms) >= ENTRIES:
                    yield _merged(groups, sizes, terms, counts)
                    groups, sizes, terms, counts = [], [], [], []
        if groups:
            yield _merged(groups, sizes, terms, counts)

    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(known("lang").alias("lang"), known("source").alias("source"), known("text").cast("binary").alias("text"))
    partial = rows.mapInArrow(count, "lang string, source string, term binary, n bigint, docs bigint")
    term = F.col("term").cast("string").alias("term")
    return partial.groupBy("lang", "source", term).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n: Column, total: Column) -> Column:
    """1 + floor(10^9 (n + 1) / total), in decimals that hold any count exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", F.lit(PARTS).cast("decimal(10,0)") * wide(n + 1), wide(total))


def probabilities(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same of int64 arrays: long division, three digits at a time, so that nothing overflows."""
    quotient, rest = np.divmod(n + 1, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        quotient = quotient * 1000 + digits
    return quotient + 1


def pair_sums(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """[a, b]: floor((p - q)^2 / q) summed over the terms, p of group ``a`` and q of group ``b``."""
    p = probabilities(counts, totals[:, None])
    return np.stack([((row - p) ** 2 // p).sum(axis=1) for row in p])


def kept_terms(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, n, per): terms in enough documents of their language, with n by source.

    The empty term, which every language has, lists all its sources. ``per``
    holds one entry for each source, so its length is bounded by the number of
    sources, never by rows. Written to the shared folder, as every part reads it.
    """
    rows = (
        term_counts(docs)
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("per"))
        .filter((F.col("docs") >= least_documents) | (F.col("term") == ""))
    )
    return materialise(rows.select("lang", "term", "n", "per"), "kept_terms")


def _group_totals(kept: DataFrame, cells: int) -> DataFrame:
    """(lang, source, total, lang_total, blocks): occurrences plus kept terms, and term blocks of ``cells`` counts."""
    by_lang = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_n"),
        F.count_if(F.col("term") != "").alias("v"),
        F.max(F.when(F.col("term") == "", F.size("per"))).alias("sources"),
    )
    by_source = kept.select("lang", F.explode("per").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("n"))
    totals = by_source.join(by_lang, "lang").select(
        "lang",
        "source",
        (F.col("n") + F.col("v")).alias("total"),
        (F.col("lang_n") + F.col("v")).alias("lang_total"),
        (F.floor(F.col("v") * F.col("sources") / cells) + 1).alias("blocks"),
    )
    return materialise(totals, "group_totals")


def _pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language.

    Terms are dealt into blocks by hash. A block meets the totals of its
    language's sources, holds one dense matrix of bounded size and sends one
    sum for each pair.
    """
    blocks = totals.groupBy("lang").agg(F.max("blocks").alias("blocks"))
    terms = kept.filter("term <> ''").join(blocks, "lang")
    terms = terms.select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "per")
    sides = totals.select("lang", "source", "total", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        names = right["source"].combine_chunks()
        per = left["per"].combine_chunks()
        flat = per.flatten()
        counts = np.zeros((len(names), len(per)), dtype=np.int64)
        of = pc.index_in(flat.field("source"), value_set=names).to_numpy(zero_copy_only=False)
        counts[of, np.repeat(np.arange(len(per)), np.diff(per.offsets.to_numpy()))] = flat.field("n").to_numpy()
        sums = pair_sums(counts, right["total"].to_numpy())
        a, b = np.nonzero(~np.eye(len(names), dtype=bool))
        return pa.table(
            {
                "lang": right["lang"].combine_chunks().take(pa.array(np.zeros(len(a), dtype=np.int64))),
                "source": names.take(pa.array(a)),
                "item": names.take(pa.array(b)),
                "value": sums[a, b],
            }
        )

    found = (
        terms.groupBy("lang", "block")
        .cogroup(sides.groupBy("lang", "block"))
        .applyInArrow(add_up, "lang string, source string, item string, value bigint")
    )
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _marked_terms(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value) of terms that a source uses more than its language does."""
    rows = kept.filter("term <> ''").select("lang", F.col("term").alias("item"), F.col("n").alias("lang_n"), F.explode("per").alias("x"))
    rows = rows.select("lang", "x.source", "item", F.col("x.n").alias("n"), "lang_n").join(totals, ["lang", "source"])
    p, q = probability(F.col("n"), F.col("total")), probability(F.col("lang_n"), F.col("lang_total"))
    rows = rows.select("lang", "source", "item", p.alias("p"), q.alias("q")).filter("p > q")
    return rows.select("lang", "source", "item", F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q")).alias("value"))


def source_divergence(
    docs: DataFrame, top_terms: int = 200, least_documents: int = LEAST_DOCUMENTS, cells: int = CELLS
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of sources and the terms that set them apart.

    Part ``pair`` has each other source of the language, part ``term`` the
    ``top_terms`` terms that stand out most against the whole language. With p
    of a term in the group and q in what it is compared with, both
    1 + floor(10^9 (n + 1) / (N + V)), a term's value is floor((p - q)^2 / q).
    Ranks go by value, then by the item's bytes.

    Null lang, source and text are empty strings, so null and empty sources
    are one group. Empty texts have no terms, but their group has its pairs; a
    language without kept terms has pairs of value zero. Texts of any length
    are counted whole, repeated rows as often as they occur, whatever their
    ids. No documents, no rows. Other columns are ignored.

    Rows of a hot source or term are added up in each batch, in each task and
    then by (lang, source, term). The totals are small tables of one row for
    each group, joined by their measured size. Pairs cost the square of a
    language's sources for each term, as the result has that many rows.
    """
    kept = kept_terms(docs, least_documents)
    totals = _group_totals(kept, cells)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.withColumns({"part": F.lit(part), "rank": F.row_number().over(best)})
    terms = ranked(_marked_terms(kept, totals), "term").filter(F.col("rank") <= top_terms)
    return (
        ranked(_pairs(kept, totals), "pair").unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
    )
