"""Language model scoring over a lattice of subwords.

Documents fall into a few classes by their most common words. In its class a
token has the probability of its training count, absolutely discounted; the
discounted mass goes to spelling, where the pieces of an existing vocabulary
are the edges of a lattice and every segmentation counts: a forward recursion
in log space sums them. A first piece carries the word mark, later ones do not,
and an end of word closes the spelling, so the probabilities of all tokens sum
to one in each class. Piece weights begin at the vocabulary's own scores and
are estimated anew from the distinct words of the whole corpus.
"""

from collections.abc import Iterator
from functools import reduce
from itertools import chain, pairwise
from operator import or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distaff.llm.common import distinct_sample, drawn_by_hash, fold, hashed_sample, in_blocks
from distaff.session import materialise

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Counts the ends of texts among the words; no word holds a space.
END = b" "
#: Text bytes of a block of documents.
BLOCK_BYTES = 8 << 20
#: Classes of documents, the bounded sample of training documents that starts
#: them, the most common words of all training documents, and rounds of fitting.
CLASSES, CLASS_SAMPLE, CLASS_WORDS, CLASS_ROUNDS = 6, 2_000, 1_000, 30
#: Share of the words that may still change their class when the rounds end.
SETTLED = 1e-4
#: Bytes of word places that a task of such a round reads, and of the texts in one array of them.
ROUND_BYTES, PLACED_BYTES = 16 << 20, 1 << 20
#: Distinct words of each class on which the piece weights warm up, and the
#: rounds; the weights used come from one more round over all distinct words.
WARM_WORDS, WARM_ROUNDS = 20_000, 4
#: Words of one length are recursed together up to so many characters, and
#: looked for among so many rows of the word table at once.
BATCH_CHARS, BATCH_WORDS = 100_000, 100_000
#: Distinct words, about, that a task counts before it passes the counts on: texts
#: of so many times ``WORD_BYTES`` are split together.
COUNTED_WORDS, WORD_BYTES = 100_000, 64
ROLL, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Pieces(NamedTuple):
    """Hashes of the pieces by length, with their places in the weights."""

    hashes: dict[int, np.ndarray]
    places: dict[int, np.ndarray]
    heads: dict[int, np.ndarray]  # whether a hash with these upper 16 bits exists, asked first
    first: np.ndarray  # whether a piece begins a word
    prior: np.ndarray  # log weight from the vocabulary's scores

    @property
    def end_of_word(self) -> int:
        return len(self.first)

    @property
    def byte(self) -> int:
        return len(self.first) + 1


def _hash(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of code points."""
    out = np.zeros(len(codes), dtype=np.uint64)
    for column in codes.T:
        out = out * ROLL + (column.astype(np.uint64) + np.uint64(1)) * SPREAD
    return out


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """Pieces of a public vocabulary; control and byte pieces are left out.

    The scores of a merge vocabulary are negative ranks; rank r weighs
    1 / (r + 10), as frequencies by rank do.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for i in range(model.vocab_size()):
        text = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) or MARK in text[1:]:
            continue
        found[text] = max(0.0, -model.get_score(i))
    found.setdefault(MARK, 0.0)
    texts = sorted(found)
    first = np.array([t[0] == MARK for t in texts])
    prior = -np.log(np.array([found[t] for t in texts]) + 10)
    hashes, places, heads = {}, {}, {}
    lengths = np.array([len(t) for t in texts])
    for n in sorted(set(lengths.tolist())):
        where = np.flatnonzero(lengths == n)
        h = _hash(np.array([[ord(c) for c in texts[i]] for i in where], dtype=np.uint32))
        order = np.argsort(h)
        hashes[n], places[n] = h[order], where[order]
        heads[n] = np.zeros(1 << 16, dtype=bool)
        heads[n][h >> np.uint64(48)] = True
    return Pieces(hashes, places, heads, first, prior)


def first_weights(pieces: Pieces) -> np.ndarray:
    """Log weights from the vocabulary alone; end of word and bytes have a quarter and a hundredth."""
    return log_weights(pieces, np.zeros(len(pieces.first) + 2), 1.0)


def log_weights(pieces: Pieces, counts: np.ndarray, strength: float = 100.0) -> np.ndarray:
    """Log weights from expected counts, with ``strength`` uses spread as the vocabulary's scores have it."""
    first, later = pieces.first, ~pieces.first
    share = np.exp(pieces.prior)
    out = np.zeros(len(counts))
    begin = counts[:-2][first] + strength * share[first] / share[first].sum()
    out[:-2][first] = np.log(begin / begin.sum())
    rest = np.concatenate([counts[:-2][later] + 0.74 * strength * share[later] / share[later].sum(), counts[-2:] + strength * np.array([0.25, 0.01])])
    rest = np.log(rest / rest.sum())
    out[:-2][later], out[-2:] = rest[:-2], rest[-2:]
    return out


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points, word mark first, of words of equal length."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(lengths, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if not len(same):
            continue
        n = int(lengths[same[0]])
        for part in np.array_split(same, len(same) * (n + 1) // BATCH_CHARS + 1):
            if len(part):
                text = "".join(words[i] for i in part.tolist()).encode("utf-32-le", "surrogatepass")
                codes = np.frombuffer(text, dtype=np.uint32).reshape(len(part), n)
                yield part, np.concatenate([np.full((len(part), 1), ord(MARK), np.uint32), codes], axis=1)


def _edges(pieces: Pieces, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(begin, end, rows, places) of all pieces in the words, by end."""
    n = codes.shape[1]
    spread = (codes.astype(np.uint64) + np.uint64(1)) * SPREAD
    rolling: dict[int, np.ndarray] = {}
    for end in range(1, n + 1):
        # hash of codes[begin:end] for every begin, one step longer each time
        column = spread[:, end - 1]
        rolling = {b: h * ROLL + column for b, h in rolling.items() if end - b <= max(pieces.hashes)}
        rolling[end - 1] = column.copy()
        for begin, h in rolling.items():
            known = pieces.hashes.get(end - begin)
            if known is None:
                continue
            rows = np.flatnonzero(pieces.heads[end - begin][h >> np.uint64(48)])
            if len(rows):
                at = np.minimum(np.searchsorted(known, h[rows]), len(known) - 1)
                found = known[at] == h[rows]
                rows, places = rows[found], pieces.places[end - begin][at[found]]
                if begin:  # within a word only pieces without the mark, also where the text has that sign
                    inner = ~pieces.first[places]
                    rows, places = rows[inner], places[inner]
                if len(rows):
                    yield begin, end, rows, places


def _bytes_of(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes > 0x7F).astype(int) + (codes > 0x7FF) + (codes > 0xFFFF)


def _forward(pieces: Pieces, weights: np.ndarray, kinds: np.ndarray, codes: np.ndarray, edges: list) -> np.ndarray:
    """Log of the summed weight of all ways to reach each place of each word, by the word's row of the weights."""
    rows, n = codes.shape
    alpha = np.full((n + 1, rows), -np.inf)
    alpha[0] = 0.0
    spelled = _bytes_of(codes) * (weights[kinds, pieces.byte] - np.log(256))[:, None]
    flat, base = weights.ravel(), kinds * weights.shape[1]
    ends = iter([*edges, (0, n + 1, None, None)])
    edge = next(ends)
    for end in range(1, n + 1):
        if end > 1:
            alpha[end] = alpha[end - 1] + spelled[:, end - 1]
        while edge[1] == end:
            begin, _, at, places = edge
            alpha[end, at] = np.logaddexp(alpha[end, at], alpha[begin, at] + flat[base[at] + places])
            edge = next(ends)
    return alpha


def spelling(pieces: Pieces, weights: np.ndarray, words: list[str], kinds: np.ndarray | None = None) -> np.ndarray:
    """Natural log probability of spelling each word, over all segmentations.

    With ``kinds`` every word has its own row of ``weights``.
    """
    weights, kinds = np.atleast_2d(weights), np.zeros(len(words), dtype=np.int64) if kinds is None else kinds
    out = np.zeros(len(words))
    for at, codes in _by_length(words):
        out[at] = _forward(pieces, weights, kinds[at], codes, list(_edges(pieces, codes)))[-1] + weights[kinds[at], pieces.end_of_word]
    return out


def expected_counts(pieces: Pieces, weights: np.ndarray, words: list[str], kinds: np.ndarray | None = None) -> np.ndarray:
    """Expected uses of every piece, of the end of word and of bytes in the spellings of the words.

    With ``kinds`` every word has its own row of ``weights`` and of the counts.
    """
    shape = weights.shape
    weights, kinds = np.atleast_2d(weights), np.zeros(len(words), dtype=np.int64) if kinds is None else kinds
    counts = np.zeros(weights.shape)
    for mine, codes in _by_length(words):
        rows, n = codes.shape
        kind = kinds[mine]
        edges = list(_edges(pieces, codes))
        alpha = _forward(pieces, weights, kind, codes, edges)
        beta = np.full((n + 1, rows), -np.inf)
        beta[n] = 0.0
        size = _bytes_of(codes)
        spelled = size * (weights[kind, pieces.byte] - np.log(256))[:, None]
        flat, base = weights.ravel(), kind * weights.shape[1]
        total = alpha[n]
        ends = iter([*reversed(edges), (0, 0, None, None)])
        edge = next(ends)
        used, shares = [np.empty(0, np.int64)], [np.empty(0)]
        for end in range(n, 0, -1):
            while edge[1] == end:
                begin, _, at, places = edge
                places = base[at] + places
                step = flat[places] + beta[end, at]
                used.append(places)
                shares.append(np.exp(alpha[begin, at] + step - total[at]))
                beta[begin, at] = np.logaddexp(beta[begin, at], step)
                edge = next(ends)
            if end > 1:
                step = spelled[:, end - 1] + beta[end]
                counts[:, pieces.byte] += np.bincount(kind, size[:, end - 1] * np.exp(alpha[end - 1] + step - total), len(counts))
                beta[end - 1] = np.logaddexp(beta[end - 1], step)
        counts += np.bincount(np.concatenate(used), np.concatenate(shares), counts.size).reshape(counts.shape)
        counts[:, pieces.end_of_word] += np.bincount(kind, minlength=len(counts))
    return counts.reshape(shape)


def _joined(batches: Iterator[pa.RecordBatch], rows: int = BATCH_WORDS) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``rows`` rows, so that words of one length and class are many."""
    kept: list[pa.RecordBatch] = []
    for batch in chain(batches, [None]):
        if batch is not None:
            kept.append(batch)
        if kept and (batch is None or sum(b.num_rows for b in kept) >= rows):
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
            kept = []


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _parts(batches: Iterator[pa.RecordBatch], n_bytes: int = COUNTED_WORDS * WORD_BYTES) -> Iterator[pa.Array]:
    """Texts of the batches, about ``n_bytes`` of them at a time."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(ends // n_bytes)) + 1
        for start, end in pairwise([0, *cuts.tolist(), batch.num_rows]):
            if start < end:
                yield batch["text"].slice(start, end - start)


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each text, and the words of all, as ``_tokens`` has them but without Python objects."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = split.flatten().cast(pa.binary())
    # blanks at either end of a text leave an empty word there
    filled = pc.binary_length(words).to_numpy() > 0
    sizes = np.diff(split.offsets.to_numpy())
    return _sums(filled.astype(np.int32), sizes).astype(np.int64), words if filled.all() else words.filter(pa.array(filled))


def _places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Place of each word in ``among``, -1 where it is not there."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy()


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of as many values in turn as each size says."""
    out = np.zeros(len(sizes), dtype=values.dtype)
    some = sizes > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some])
    return out


def _text(words: list[bytes]) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in words]


def _holders(sizes: np.ndarray, at: np.ndarray, n_words: int, texts: int = 250) -> np.ndarray:
    """How many texts hold each word, from the places of the words of each text; few texts at a time."""
    out = np.zeros(n_words, dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for start in range(0, len(sizes), texts):
        some = sizes[start : start + texts]
        row = np.repeat(np.arange(len(some)), some)
        pairs = pc.unique(pa.array(row * n_words + at[ends[start] : ends[start + len(some)]])).to_numpy()
        out += np.bincount(pairs % max(n_words, 1), minlength=n_words)
    return out


class Classes(NamedTuple):
    """Multinomials over common words; the last row of ``logs`` is for all others."""

    words: dict[bytes, int]
    logs: np.ndarray  # (words + 1, classes)

    @property
    def listed(self) -> pa.Array:
        return pa.array(sorted(self.words, key=self.words.get), pa.binary())

    def of(self, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Likeliest class of each text, from the places of its words in ``listed`` (-1: others).

        Texts without a common word are in the first class. What a text gets
        does not depend on the texts beside it.
        """
        common = places >= 0
        ends = np.concatenate([[0], np.cumsum(common)])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return _likeliest(self.logs, places[common], np.diff(ends[bounds]))


def _likeliest(logs: np.ndarray, places: np.ndarray, sizes: np.ndarray, counts: int | np.ndarray = 1) -> np.ndarray:
    return np.stack([_sums(each[places] * counts, sizes) for each in np.ascontiguousarray(logs.T)]).argmax(axis=0)


def fit_classes(texts: list[str], words: dict[bytes, int], classes: int = CLASSES, seed: int = 0) -> Classes:
    """Split a sample of texts by expectation maximisation of hard assignments; the likeliest of five starts."""
    split = [_tokens(t) for t in texts]
    counts = np.zeros((len(split), len(words)))
    for row, tokens in zip(counts, split, strict=True):
        np.add.at(row, [words[w] for w in tokens if w in words], 1)
    counts = counts[counts.sum(axis=1) > 0]
    rng = np.random.default_rng(seed)
    best = (-np.inf, np.zeros((len(words), classes)))
    for _ in range(5 if len(counts) else 0):
        centres = counts[rng.choice(len(counts), classes, replace=len(counts) < classes)]
        for _ in range(CLASS_ROUNDS):
            logs = _class_logs(centres)
            fit = counts @ logs
            chosen = fit.argmax(axis=1)
            centres = np.stack([counts[chosen == k].sum(axis=0) for k in range(classes)])
        if fit.max(axis=1).sum() > best[0]:
            best = (fit.max(axis=1).sum(), logs)
    return Classes(words, _with_others(best[1]))


def _class_logs(centres: np.ndarray) -> np.ndarray:
    """Log probabilities (words, classes) from word sums (classes, words)."""
    return np.log((centres + 0.1) / (centres + 0.1).sum(axis=1, keepdims=True)).T


def _with_others(logs: np.ndarray) -> np.ndarray:
    return np.concatenate([logs, np.zeros((1, logs.shape[1]))])


def common_words(texts: DataFrame, n_words: int = CLASS_WORDS) -> dict[bytes, int]:
    """The words that most of all ``texts`` (text) hold, ties in word order."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            sizes, words = _words(part)
            coded = words.dictionary_encode()
            n = _holders(sizes, coded.indices.to_numpy(), len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n)], ["word", "n"])

    counted = texts.mapInArrow(held, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(n_words).collect()
    return {bytes(r.word): i for i, r in enumerate(top)}


#: Kinds of the arrays of ``common_counts``.
PLACED = np.int16, np.int32, np.int32


def common_counts(texts: pa.Array, listed: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``listed`` of the common words of each text, every one once, their counts, and how many each text has."""
    sizes, words = _words(texts)
    at = _places(words, listed)
    row = np.repeat(np.arange(len(sizes)), sizes)[at >= 0]
    pairs = pc.value_counts(pa.array(row * len(listed) + at[at >= 0]))  # in the order of the texts
    row, at = np.divmod(pairs.field("values").to_numpy(), max(len(listed), 1))
    found = at, pairs.field("counts").to_numpy(), np.bincount(row, minlength=len(sizes))
    return tuple(x.astype(kind) for x, kind in zip(found, PLACED, strict=True))


def refine_classes(texts: DataFrame, start: Classes, rounds: int = CLASS_ROUNDS) -> Classes:
    """Rounds of hard assignments over all ``texts`` (text), from ``start`` until the classes are settled.

    They are when at most ``SETTLED`` of all common words still change their
    class, net of those that change places.

    The places of common words are written once, as the bytes of one array
    for many texts, with how often each text has them; in each round the tasks
    send the word sums of every class, and their sum makes the new centres.
    """
    n_words, classes = len(start.words), start.logs.shape[1]
    if not n_words:
        return start
    listed = texts.sparkSession.sparkContext.broadcast(start.listed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, PLACED_BYTES):
            found = common_counts(part, listed.value)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in found], ["places", "counts", "sizes"])

    placed = materialise(texts.mapInArrow(place, "places binary, counts binary, sizes binary"), "class-words")
    size = placed.agg(F.sum(F.octet_length("places").cast("bigint"))).first()[0] or 0
    placed = placed.coalesce(size // ROUND_BYTES + 1)
    logs, before = start.logs[:-1], None
    for _ in range(rounds):
        known = texts.sparkSession.sparkContext.broadcast(logs)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((classes, n_words), dtype=np.int64)
            for batch in batches:
                for each in zip(*batch.columns, strict=True):
                    at, n, sizes = (np.frombuffer(x.as_py(), kind) for x, kind in zip(each, PLACED, strict=True))
                    chosen = np.repeat(_likeliest(known.value, at, sizes, n), sizes)
                    sums += np.bincount(chosen * n_words + at, n, sums.size).astype(np.int64).reshape(sums.shape)
            k, at = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(at), pa.array(sums[k, at])], ["class", "place", "n"])

        got = placed.mapInArrow(assign, "class bigint, place bigint, n bigint").groupBy("class", "place").agg(F.sum("n").alias("n")).toPandas()
        centres = np.zeros((classes, n_words))
        centres[got["class"].to_numpy(np.int64), got["place"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
        known.unpersist()
        # Of every word that changes its class one sum falls and one rises.
        if before is not None and np.abs(centres - before).sum() <= 2 * SETTLED * centres.sum():
            break
        before, logs = centres, _class_logs(centres)
    return Classes(start.words, _with_others(logs))


class Model(NamedTuple):
    """What training leaves: word counts by class as a table, the rest as numbers."""

    words: DataFrame  # (word, total, n, spelled): counts in all and by class, and log spellings where a count is positive
    pieces: Pieces
    classes: Classes
    tokens: np.ndarray  # by class, ends included
    docs: np.ndarray
    n_words: np.ndarray
    discount: np.ndarray
    weights: np.ndarray
    distinct: int


def train(texts: DataFrame, vocabulary: str = VOCABULARY, classes: int = CLASSES) -> Model:
    """Count the words of ``texts`` (text) by class and estimate the piece weights.

    All texts decide the classes, all words of all texts are counted and all
    distinct ones give the final weights. The driver gets the common words, a
    sample of ``CLASS_SAMPLE`` distinct texts that starts the classes, sums, samples of
    ``WARM_WORDS`` words a class, and one expected count for each piece.
    """
    spark = texts.sparkSession
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"))
    sample = distinct_sample(texts, CLASS_SAMPLE, "text").toPandas()["text"].tolist()
    fitted_classes = refine_classes(texts, fit_classes(sample, common_words(texts), classes))
    known = spark.sparkContext.broadcast((fitted_classes, fitted_classes.listed))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            sizes, words = _words(part)
            coded, (fitted, listed) = words.dictionary_encode(), known.value
            at = coded.indices.to_numpy()
            kind = fitted.of(_places(coded.dictionary, listed)[at], sizes)
            n = np.bincount(np.repeat(kind, sizes) * len(coded.dictionary) + at, minlength=classes * len(coded.dictionary))
            k, at = np.nonzero(n.reshape(classes, -1))
            ends = pa.array([END] * classes, pa.binary())
            made = [
                pa.concat_arrays([coded.dictionary.take(pa.array(at)), ends]),
                pa.array(np.concatenate([k, np.arange(classes)]).astype(np.int32)),
                pa.array(np.concatenate([n[n > 0], np.bincount(kind, minlength=classes)])),
            ]
            yield pa.RecordBatch.from_arrays(made, ["word", "class", "n"])

    counted = texts.mapInArrow(count, "word binary, class int, n bigint").groupBy("word").agg(
        F.array(*[F.sum(F.when(F.col("class") == k, F.col("n")).otherwise(0)) for k in range(classes)]).alias("n")
    )
    words = materialise(counted, "word-counts")
    ends = words.filter(F.col("word") == END).first()
    docs = np.array(ends["n"] if ends else [0] * classes)
    words = words.filter(F.col("word") != END)
    each = [F.col("n")[k] for k in range(classes)]
    sums = words.agg(
        F.count("*"),
        *[f for n in each for f in (F.coalesce(F.sum(n), F.lit(0)), F.count_if(n > 0), F.count_if(n == 1), F.count_if(n == 2))],
    ).first()
    total, n_words, once, twice = np.array(sums[1:], dtype=np.int64).reshape(classes, 4).T
    discount = np.where((once > 0) & (twice > 0), once / np.maximum(once + 2 * twice, 1), 0.5)
    pieces = load_pieces(vocabulary)
    weights = np.stack([first_weights(pieces)] * classes)
    drawn = [(each[k] > 0) & drawn_by_hash(int(n_words[k]), WARM_WORDS, "word") for k in range(classes)]
    drawn = materialise(words.filter(reduce(or_, drawn)).select("word", "n"), "warm-words")
    for k in range(classes):
        warm = hashed_sample(drawn.filter(each[k] > 0).select("word"), WARM_WORDS, "word", count=int(n_words[k])).toPandas()["word"]
        for _ in range(WARM_ROUNDS if len(warm) else 0):
            weights[k] = log_weights(pieces, expected_counts(pieces, weights[k], _text(warm.tolist())))
    table, warmed = spark.sparkContext.broadcast(pieces), spark.sparkContext.broadcast(weights)

    def by_class(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[str]]:
        at, kind = np.nonzero(batch["n"].flatten().to_numpy().reshape(-1, classes))
        return at, kind, np.array(_text(batch["word"].to_pylist()), dtype=object)[at].tolist()

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros(warmed.value.shape)
        for batch in _joined(batches):
            _, kind, mine = by_class(batch)
            uses += expected_counts(table.value, warmed.value, mine, kind)
        k, at = np.nonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(at), pa.array(uses[k, at])], ["class", "piece", "uses"])

    used = words.mapInArrow(expect, "class bigint, piece bigint, uses double").groupBy("class", "piece").agg(F.sum("uses").alias("uses")).toPandas()
    uses = np.zeros(weights.shape)
    uses[used["class"].to_numpy(np.int64), used["piece"].to_numpy(np.int64)] = used["uses"].to_numpy(np.float64)
    weights = np.stack([log_weights(pieces, u) for u in uses])
    fitted = spark.sparkContext.broadcast(weights)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _joined(batches):
            logs = np.full((len(batch), classes), np.nan)
            at, kind, mine = by_class(batch)
            logs[at, kind] = spelling(table.value, fitted.value, mine, kind)
            spelled = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * classes), pa.array(logs.ravel()))
            total = pa.array(batch["n"].flatten().to_numpy().reshape(-1, classes).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch["word"], total, batch["n"], spelled], ["word", "total", "n", "spelled"])

    scored = words.mapInArrow(spell, "word binary, total bigint, n array<bigint>, spelled array<double>")
    return Model(scored, pieces, fitted_classes, total + docs, docs, n_words, discount, weights, int(sums[0]))


def score(docs: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, n_tokens, n_known, base_score, score) for every row of ``docs`` (doc_id, text).

    ``row`` is the whole input row. Null texts are empty; every text has one
    end token. ``score`` is the log10 probability of the text's class and of
    its tokens there, so the scores of all texts stay below one in sum. Blocks
    of documents ask for their distinct words, so a word that all documents
    have is a row or a few of each block.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((model._replace(words=None), model.classes.listed))
    dealt, _ = in_blocks(docs, block_bytes)

    def distinct(key: tuple, table: pa.Table) -> pa.Table:
        m, listed = shared.value
        sizes, words = _words(table["row"].combine_chunks().field("text"))
        coded = words.dictionary_encode()
        at = coded.indices.to_numpy()
        found = np.zeros((len(m.docs), len(coded.dictionary)), dtype=bool)
        found[np.repeat(m.classes.of(_places(coded.dictionary, listed)[at], sizes), sizes), at] = True
        kinds, at = np.nonzero(found)
        block = np.full(len(at), key[0].as_py(), dtype=np.int64)
        return pa.table({"block": block, "class": kinds.astype(np.int32), "word": coded.dictionary.take(pa.array(at))})

    def apply(table: pa.Table, told: pa.Table) -> pa.Table:
        m, listed = shared.value
        every, n_docs = int(m.tokens.sum()), int(m.docs.sum())
        base_all = np.log10(every + 0.1 * (m.distinct + (n_docs > 0) + 1))
        end_base = np.log10(n_docs + 0.1) - base_all
        prior = np.log10((m.docs + 0.5) / (n_docs + 0.5 * len(m.docs)))
        words = told["word"].combine_chunks().cast(pa.binary())
        kind, total, counts, spelled = (told[c].to_numpy() for c in ("class", "total", "n", "spelled"))
        spelled = spelled.copy()
        new = np.flatnonzero(np.isnan(spelled))
        spelled[new] = spelling(m.pieces, m.weights, _text(words.take(pa.array(new)).to_pylist()), kind[new])
        # in logs, as the spelling of a very long word is too small for a double
        with np.errstate(divide="ignore"):
            left = np.log(np.maximum(counts - m.discount[kind], 0.0))
        logs = np.logaddexp(left, np.log(m.discount * m.n_words + 0.5)[kind] + spelled)
        logs = (logs - np.log(m.tokens + 1)[kind]) / np.log(10)
        base = np.log10(total + 0.1) - base_all
        ends = np.log10((m.docs + 0.5) / (m.tokens + 1)) + prior

        coded = words.dictionary_encode()
        answer = np.full((len(m.docs), len(coded.dictionary)), -1)
        answer[kind, coded.indices.to_numpy()] = np.arange(len(kind))
        sizes, tokens = _words(table["row"].combine_chunks().field("text"))
        at = _places(tokens, coded.dictionary)
        chosen = m.classes.of(_places(coded.dictionary, listed)[at], sizes)
        at = answer[np.repeat(chosen, sizes), at]
        if (at < 0).any():
            raise ValueError("a word of the block was not asked for")
        made = {
            "n_tokens": sizes + 1,
            "n_known": _sums((total > 0).astype(np.int64)[at], sizes) + (n_docs > 0),
            "base_score": _sums(base[at], sizes) + end_base,
            "score": _sums(logs[at], sizes) + ends[chosen],
        }
        return pa.table({"row": table["row"], **made})

    asked = dealt.groupBy("block").applyInArrow(distinct, "block bigint, class int, word binary")
    here = F.col("class")
    told = asked.join(model.words, "word", "left").select(
        "block",
        "class",
        "word",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce(F.get("n", here), F.lit(0)).alias("n"),
        F.coalesce(F.get("spelled", here), F.lit(float("nan"))).alias("spelled"),
    )
    kind = dealt.schema["row"].dataType.simpleString()
    return (
        dealt.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(apply, f"row {kind}, n_tokens bigint, n_known bigint, base_score double, score double")
    )


def score_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of ``docs`` (doc_id, text).

    Rows whose crc32(doc_id as text) mod 10 is 0 are held out; the model
    learns from the others. Null ids count as empty text there. Without any
    training row all words are unknown.
    """
    held = fold(10) == 0
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(texts.filter(~held).select("text"), vocabulary)
    return score(texts, model).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_tokens",
        "n_known",
        F.lit(int(model.tokens.sum())).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    ).withColumn("held_out", held)
