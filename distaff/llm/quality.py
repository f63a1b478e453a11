"""Quality classifier: boosted trees over document statistics."""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distaff.llm import boosted_trees
from distaff.llm.common import fold, hashed_sample, in_slices

#: Labelled rows the trees are fitted on, at most; chosen by a hash of the id.
FIT_ROWS = 20_000
THRESHOLD = 0.7
SENTENCE_END = re.compile(r"[.!?]+(?:\s|$)")
FEATURES = (
    "log_chars log_words mean_word word_spread long_words short_words upper upper_words digits punctuation symbols non_ascii "
    "spaces lines line_words repeated_lines repeated_line_chars short_lines distinct_words top_word repeated_pairs "
    "repeated_fives sentence_words no_end punctuated_words doubled_marks bars brackets links compressed distinct_chars"
).split()


def statistics(text: str | None) -> list[float]:
    """The FEATURES of one whole text; an empty one has zeros."""
    text = text or ""
    words = text.split()
    if not words:
        return [float(np.log1p(len(text))), *[0.0] * (len(FEATURES) - 1)]
    n, chars = len(words), len(text)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    data = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    upper, lower, digit = kinds[65:91].sum(), kinds[97:123].sum(), kinds[48:58].sum()
    marks = sum(kinds[ord(c)] for c in ".,;:!?'\"-()")
    symbols = kinds[33:127].sum() - upper - lower - digit - marks
    lines = [line.strip() for line in text.split("\n") if line.strip()]
    line_counts = Counter(lines)
    repeated = [(k, c) for k, c in line_counts.items() if c > 1]
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    fives = Counter(zip(words, words[1:], words[2:], words[3:], words[4:]))

    def share(c: Counter) -> float:
        total = sum(c.values())
        return sum(v for v in c.values() if v > 1) / total if total else 0.0

    return [
        float(np.log1p(chars)),
        float(np.log1p(n)),
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths > 12).mean()),
        float((lengths < 3).mean()),
        upper / len(data),
        sum(w.isupper() for w in words) / n,
        digit / len(data),
        marks / len(data),
        symbols / len(data),
        kinds[128:].sum() / len(data),
        (kinds[32] + kinds[9] + kinds[10]) / len(data),
        float(np.log1p(len(lines))),
        n / len(lines),
        sum(c for _, c in repeated) / len(lines),
        sum(len(k) * c for k, c in repeated) / chars,
        sum(len(line) < 30 for line in lines) / len(lines),
        len(counts) / n,
        max(counts.values()) / n,
        share(pairs),
        share(fives),
        n / max(1, len(SENTENCE_END.findall(text))),
        float(lines[-1][-1] not in ".!?\"'"),
        sum(not w[-1].isalnum() for w in words) / n,
        (data.count(b"!!") + data.count(b"***") + data.count(b"###") + data.count(b"$$$")) / n,
        kinds[ord("|")] / n,
        (kinds[ord("{")] + kinds[ord("<")] + kinds[ord("[")]) / n,
        (data.count(b"http") + data.count(b"www.")) / n,
        len(zlib.compress(data, 1)) / len(data),
        len(set(text)) / chars,
    ]


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> boosted_trees.Trees:
    """Trees for ``labels.quality`` from at most ``fit_rows`` rows of three folds of four.

    Rows without a label, and those whose crc32(doc_id as text) mod 4 is 2,
    are not learnt from. Nothing but the text is an input.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").alias("quality"))
    chosen = hashed_sample(known.filter(fold(4) != 2), fit_rows, "doc_id")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            x = [statistics(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["quality"], pa.array(x, pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    rows = texts.join(chosen, "doc_id").select("doc_id", "quality", "text").mapInArrow(measure, "doc_id bigint, quality int, x array<double>")
    got = rows.toPandas().sort_values("doc_id", kind="stable")
    x = np.array(got["x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return boosted_trees.fit(x, (got["quality"].to_numpy(np.int64) == 1).astype(np.float64))


def score_quality(docs: DataFrame, trees: boosted_trees.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Null texts count as empty, which are scored too; repeated rows score
    alike and null ids are kept. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            x = np.array([statistics(t) for t in batch["text"].to_pylist()], dtype=np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(shared.value.probabilities(x))], ["doc_id", "score"])

    return texts.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
