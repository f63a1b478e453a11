"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled texts: one on windows of
ordinary text, one on those windows of toxic text that hold what ordinary text
lacks, laid before the same ordinary content, so that ordinary words compress
alike with both and only toxic ones compress better with the second. The difference of the two
lengths of a window is its gain. Windows of eight words are compared with a
small ordinary dictionary first; those that gain anything are cut into windows
of three and compared again, strictly, with a large one. How much gain makes a
text toxic is calibrated on labelled texts the dictionaries have not seen.
"""

from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distaff.llm.common import fold, hashed_sample, in_slices

#: Labelled rows learnt from, at most; chosen by a hash of the id. The first
#: share of them trains the dictionaries, the others calibrate.
FIT_ROWS, TRAINING_SHARE = 6_000, 0.6
THRESHOLD = 0.3
WIDE, NARROW = 8, 3
SMALL, LARGE, TOXIC = 16 << 10, 64 << 10, 1 << 10
#: Closes every window and both dictionaries. The compressor looks for no match
#: in the last eight bytes, and keeps as it is what would hardly get shorter.
TAIL = bytes(range(1, 9)) + bytes(range(14, 32))
#: Bytes of the grams that are compared.
GRAMS = (5, 7, 9)
#: A gram is distinctive in this many toxic texts, at this log ratio of
#: document frequencies and this many standard deviations.
LEAST_TEXTS, LEAST_RATIO, LEAST_DEVIATIONS = 3, 2.0, 5.0
#: Share of a text's four-word shingles that earlier texts may have; beyond it
#: the text is a copy and doesn't count again.
COPIED, SHINGLE_SAMPLE = 0.1, 8
#: Windows of ordinary text, about, that its dictionaries are trained on.
DICTIONARY_SAMPLES = 40_000
ROLL = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def windows_of(words: list[bytes], size: int) -> list[bytes]:
    """Consecutive windows, each closed by TAIL."""
    return [b" " + b" ".join(words[i : i + size]) + b" " + TAIL for i in range(0, len(words), size)]


class Pair(NamedTuple):
    """Ordinary and toxic dictionary of one comparison."""

    ordinary: bytes
    toxic: bytes
    level: int

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for content in (self.ordinary, self.toxic + self.ordinary):
            settings = zstandard.ZstdCompressionParameters.from_level(
                self.level, source_size=80, dict_size=len(content), write_content_size=0, write_checksum=0, write_dict_id=0
            )
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=settings))
        return made


class Meter:
    """Both comparisons, ready to measure texts."""

    def __init__(self, wide: Pair, narrow: Pair):
        self.pairs = wide, narrow

    def __reduce__(self):
        return Meter, self.pairs

    @cached_property
    def ready(self) -> list[list[zstandard.ZstdCompressor]]:
        return [pair.compressors() for pair in self.pairs]

    def gains(self, windows: list[bytes], narrow: bool) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window."""
        if not windows:
            return np.zeros(0, dtype=np.int64)
        ordinary, toxic = (np.fromiter(map(len, c.multi_compress_to_buffer(windows)), np.int64, len(windows)) for c in self.ready[narrow])
        return ordinary - toxic

    def measure(self, text: str | None) -> list[float]:
        """Largest gain, log of the summed gains of two or more, log of the number of words if anything gained.

        A text without a gain measures zero throughout, however long it is.
        """
        words = words_of(text)
        found: list[bytes] = []
        for at in np.flatnonzero(self.gains(windows_of(words, WIDE), narrow=False) > 0).tolist():
            found += windows_of(words[at * WIDE : (at + 1) * WIDE], NARROW)
        gains = self.gains(found, narrow=True)
        most = max(0, int(gains.max(initial=0)))
        return [float(most), float(np.log1p(gains[gains > 1].sum())), float(np.log1p(len(words))) if most else 0.0]


def _originals(texts: list[bytes]) -> list[bytes]:
    """Texts without those that earlier ones mostly hold, judged by one shingle in SHINGLE_SAMPLE."""
    seen: set[int] = set()
    kept = []
    for text in texts:
        words = text.split()
        hashes = (xxhash.xxh3_64_intdigest(b" ".join(words[i : i + 4])) for i in range(max(1, len(words) - 3)))
        shingles = {h for h in hashes if h % SHINGLE_SAMPLE == 0}
        if len(shingles & seen) <= COPIED * len(shingles):
            kept.append(text)
        seen |= shingles
    return kept


def _grams(text: bytes) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(bytes, places, hashes) of the grams of each length that lie in one word, its bounding spaces included."""
    data = np.frombuffer(b" " + text + b" ", dtype=np.uint8)
    space = data == 32
    found = []
    for n in GRAMS:
        size = len(data) - n + 1
        if size <= 0:
            continue
        hashes, inside = np.full(size, n, dtype=np.uint64), np.ones(size, dtype=bool)
        for i in range(n):
            hashes *= ROLL
            hashes += data[i : i + size]
            if 0 < i < n - 1:
                inside &= ~space[i : i + size]
        places = np.flatnonzero(inside)
        found.append((n, places, hashes[places]))
    return found


def _distinct_grams(text: bytes) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint64), *[h for _, _, h in _grams(text)]]))


def _known(grams: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Places in sorted ``grams`` of those of ``asked`` that are there, -1 for others."""
    if not len(grams):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(grams, asked), len(grams) - 1)
    return np.where(grams[at] == asked, at, -1)


def toxic_windows(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Windows of one word, with the blanks around it, that hold grams which toxic texts have and ordinary ones lack.

    Every occurrence is a window. Grams are counted by hash, text after text,
    so that memory holds those of the toxic texts only.
    """
    if not toxic:
        return []
    grams, there = np.unique(np.concatenate([_distinct_grams(t) for t in toxic]), return_counts=True)
    grams, there = grams[there >= LEAST_TEXTS], there[there >= LEAST_TEXTS]
    elsewhere = np.zeros(len(grams), dtype=np.int64)
    for text in ordinary:
        at = _known(grams, _distinct_grams(text))
        elsewhere[at[at >= 0]] += 1
    n, m = len(toxic), max(len(ordinary), 1)
    ratio = np.log((there + 0.5) / (n + 1)) - np.log((elsewhere + 0.5) / (m + 1))
    p = (there + elsewhere) / (n + m)
    spread = np.sqrt(np.maximum(p * (1 - p) * (1 / n + 1 / m), 1e-12))
    telling = grams[(ratio > LEAST_RATIO) & ((there / n - elsewhere / m) / spread > LEAST_DEVIATIONS)]
    found = []
    for text in toxic:
        blanks = np.flatnonzero(np.frombuffer(b" " + text, dtype=np.uint8) == 32)
        words = text.split(b" ")
        # A gram lies in one word, the second of its bytes surely.
        held = [np.searchsorted(blanks, places[_known(telling, hashes) >= 0] + 1) - 1 for _, places, hashes in _grams(text)]
        found += [b" " + words[i] + b" " for i in np.unique(np.concatenate([np.empty(0, np.int64), *held])).tolist()]
    return found


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained content; the distinct samples themselves, the commonest last, where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, level=9).as_bytes()
    except zstandard.ZstdError:
        counts = Counter(samples)
        return b"".join(sorted(counts, key=lambda x: (counts[x], x)))[-size:]


class Classifier(NamedTuple):
    meter: Meter
    weights: np.ndarray  # of the measures and, last, the constant

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.meter.measure(t) for t in texts], dtype=np.float64).reshape(-1, 3)
        return _probabilities(x, self.weights)


def _probabilities(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))


def _calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Logistic weights by Newton steps; without both classes only the constant."""
    whole = np.c_[x, np.ones(len(x))]
    weights = np.zeros(whole.shape[1])
    share = (y.sum() + 0.5) / (len(y) + 1)
    weights[-1] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return weights
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(whole @ weights, -30, 30)))
        slope = whole.T @ (y - p) - ridge * weights
        step = np.linalg.solve((whole * (p * (1 - p))[:, None]).T @ whole + ridge * np.eye(len(weights)), slope)
        weights = weights + np.clip(step, -2, 2)
    return weights


def train(texts: list[str | None], toxic: np.ndarray, seed: int = 0) -> Classifier:
    """Dictionaries from the first TRAINING_SHARE of the texts, calibration from the others."""
    cut = int(len(texts) * TRAINING_SHARE)
    plain = [b" ".join(words_of(t)) for t in texts[:cut]]
    bad = _originals([x for x, t in zip(plain, toxic, strict=False) if t])
    good = _originals([x for x, t in zip(plain, toxic, strict=False) if not t])
    toxic_content = _dictionary(toxic_windows(bad, good), TOXIC)
    rate = min(1.0, DICTIONARY_SAMPLES * WIDE / max(1, sum(x.count(b" ") + 1 for x in good)))
    rng = np.random.default_rng(seed)
    samples = []
    for text in good:
        words = text.split()
        starts = np.arange(0, len(words), WIDE)
        samples += [b" ".join(words[i : i + WIDE]) + b" " for i in starts[rng.random(len(starts)) < rate].tolist()]
    small, large = (_dictionary(samples, size) + TAIL for size in (SMALL, LARGE))
    meter = Meter(Pair(small, toxic_content, 5), Pair(large, toxic_content, 9))
    x = np.array([meter.measure(t) for t in texts[cut:]], dtype=np.float64).reshape(-1, 3)
    return Classifier(meter, _calibrate(x, toxic[cut:].astype(np.float64)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Classifier:
    """Classifier for ``labels.toxic`` from at most ``fit_rows`` labelled rows of three folds of four.

    Rows without a label, and those whose crc32(doc_id as text) mod 4 is 2,
    are not learnt from. Nothing but the text is an input. A document with
    contradicting labels counts as toxic.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = hashed_sample(known.filter(fold(4) != 2), fit_rows, "doc_id")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # One row of each id, however many share it: that of the smallest text hash, found before anything is sent.
    one = texts.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows: pd.DataFrame = one.withColumn("place", F.xxhash64("doc_id")).toPandas()
    rows = rows.sort_values(["place", "doc_id"], kind="stable")
    return train(rows["text"].tolist(), rows["toxic"].to_numpy() == 1)


def score_toxicity(docs: DataFrame, classifier: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (score >= ``threshold``).

    ``docs`` is (doc_id, text). Whole texts are measured; null ones count as
    empty and are scored too. Repeated rows score alike, null ids are kept.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            scores = shared.value.scores(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, fit_rows))
    rows = docs.select(F.struct("*").alias("row"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch["row"].field("text").cast(pa.string()).to_pylist()
            fine = shared.value.scores(texts) < threshold
            yield batch.filter(pa.array(fine, pa.bool_()))

    return rows.mapInArrow(keep, rows.schema).select("row.*")
