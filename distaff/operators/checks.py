"""Checks of corpora, vocabularies, outputs and logs around a training run."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distaff.constants import MAX_VOCABULARY
from distaff.functions.distributions import bind, log_softmax, total
from distaff.functions.text import share
from distaff.operators.grams import gram_filter, gram_table
from distaff.operators.losses import counted, or_fail
from distaff.operators.ordering import running
from distaff.session import materialise

PARAMETER_TOKENS = 20


def dead_tokens(vocab: DataFrame, token_ids: DataFrame, ids: str = "token_ids") -> DataFrame:
    """Vocabulary entries (token, id) that no text uses."""
    used = token_ids.select(F.explode(F.array_distinct(ids)).alias("id")).distinct()
    return vocab.join(used, "id", "left_anti").select("token", "id")


def token_budget(df: DataFrame, tokens: Column, source: str, parameters: int) -> DataFrame:
    """Tokens by source against twenty for each model parameter."""
    wanted = PARAMETER_TOKENS * parameters
    everything = Window.partitionBy()
    sums = df.groupBy(source).agg(F.sum(tokens).alias("n_tokens"))
    return sums.select(
        source,
        "n_tokens",
        F.lit(wanted).cast("bigint").alias("n_wanted"),
        share(F.col("n_tokens"), F.lit(wanted)).alias("share_of_wanted"),
        (F.sum("n_tokens").over(everything) >= wanted).alias("enough"),
    )


def shard_tokens(df: DataFrame, key: str, tokens: Column, shard: int) -> DataFrame:
    """(key, n_tokens, start, shard_id): rows in key order, cut into shards of ``shard`` tokens.

    A row belongs to the shard in which it starts. Keys may be of any sortable
    type, null (first) or repeated: every row stays, equal keys follow each
    other by their tokens and no two rows with tokens start at one place. Rows
    whose tokens are null have none.
    """
    rows = df.select(key, F.coalesce(tokens.cast("bigint"), F.lit(0).cast("bigint")).alias("n_tokens"))
    placed = running(rows, [], [key, "n_tokens"], {"start": ("sum", F.col("n_tokens"))})
    return placed.withColumn("shard_id", F.floor(F.col("start") / shard))


def shared_grams(outputs: DataFrame, reference: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(key, n_grams, n_shared): distinct ``n``-word grams of every text, and those the reference has.

    Each row of ``outputs`` keeps its row, also where its text is null or has
    fewer than ``n`` words (no grams) or its key is repeated. The grams asked
    for make a filter of fixed size, so the reference sends 16 bytes for each
    of its grams that may be one of them, distinct by block of rows. Two grams
    are one where two 64-bit hashes agree: for a trillion pairs of different
    grams the chance that any agree is about 10⁻²⁶.
    """
    rows = outputs.select(F.col(key), F.col(text)).withColumn("_row", F.monotonically_increasing_id())
    mine = materialise(gram_table(rows, ["_row", key], text, n, every_row=True), "grams")
    theirs = gram_table(reference.select(text), [], text, n, kept=gram_filter(mine)).distinct()
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    found = mine.filter("a IS NOT NULL").join(theirs, ["a", "b"], "left_semi")
    counts = mine.select("_row", key, F.when(F.col("a").isNotNull(), one).otherwise(none).alias("n"), none.alias("m"))
    counts = counts.union(found.select("_row", key, none, one))
    summed = counts.groupBy("_row", key).agg(F.sum("n").alias("n_grams"), F.sum("m").alias("n_shared"))
    return summed.drop("_row")


def holdout_contamination(corpus: DataFrame, held_out: DataFrame, key: str, text: str, n: int = 13) -> DataFrame:
    """(key, n_shared) of the corpus rows that hold ``n``-word grams of the held-out texts.

    A filter of fixed size holds the held-out grams; a row of the corpus is
    asked where it is read and only grams that pass are shuffled, which are
    the hits and few others. Their words are then compared with the held-out
    ones, so no hash decides. Rows that share a key stay apart. Held-out
    texts of fewer than ``n`` words have no gram and are not looked for.
    """
    theirs = materialise(gram_table(held_out.select(text), [], text, n, texts=True).distinct(), "held_out")
    rows = corpus.select(F.col(key), F.col(text)).withColumn("_row", F.monotonically_increasing_id())
    passed = gram_table(rows, ["_row", key], text, n, kept=gram_filter(theirs), texts=True)
    found = passed.join(theirs.select("a", "gram"), ["a", "gram"], "left_semi")
    return found.groupBy("_row", key).agg(F.count("*").alias("n_shared")).drop("_row")


def regurgitation(outputs: DataFrame, train: DataFrame, key: str, text: str, n: int = 8) -> DataFrame:
    """Share of each output's ``n``-grams that stand word for word in the training texts; 0 where it has none."""
    return shared_grams(outputs, train, key, text, n).withColumn(
        "share_verbatim", share(F.col("n_shared"), F.col("n_grams"))
    )


def trailing_slopes(log: DataFrame, run: str, step: str, losses: list[str], span: int) -> DataFrame:
    """Add ``n_<loss>``, ``off_<loss>`` and ``slope_<loss>`` over the last ``span`` steps of each row.

    A row's stretch is the steps from ``step - span + 1`` to its own, of its
    run: ``n`` finite values, ``off`` logged ones that are not finite, and the
    least squares slope of the values by step, null below two different steps.
    A null loss is one that was not logged there. Rows of one step share their
    values.

    Steps are cut into chunks of ``span``, so a stretch is the head of its own
    chunk and the tail of the one before. Both are running sums of moments:
    forward over the own rows, backward over those that the chunk before hands
    on, so nothing is subtracted and every window holds two chunks of one run.
    """
    chunk = F.floor(F.col(step) / span)
    moments = {}
    for i, loss in enumerate(losses):
        y = F.col(loss).cast("double")
        finite = y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf"))
        # The chunk before hands its rows on with places up to -1.
        x = (F.col(step) - F.col("_chunk") * span).cast("double")
        for name, value in (("n", F.lit(1.0)), ("x", x), ("y", y), ("xx", x * x), ("xy", x * y)):
            moments[f"_{name}{i}"] = F.when(finite, value).otherwise(F.lit(0.0))
        moments[f"_off{i}"] = F.when(y.isNotNull() & ~finite, 1.0).otherwise(F.lit(0.0))
    offsets = F.explode(F.array(F.lit(0), F.lit(1))).alias("_later")
    rows = log.select("*", offsets).withColumn("_chunk", chunk + F.col("_later"))
    rows = rows.withColumns(moments).withColumn("_at", F.col(step) + F.when(F.col("_later") == 1, span - 1).otherwise(0))
    group = Window.partitionBy(run, "_chunk")
    head = group.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tail = group.orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("_later") == 0
    sums = {
        m: F.sum(F.when(own, F.col(m)).otherwise(0.0)).over(head) + F.sum(F.when(own, 0.0).otherwise(F.col(m))).over(tail)
        for m in moments
    }
    summed = rows.select(*log.columns, "_later", *[v.alias(m) for m, v in sums.items()]).filter(own)
    out = {}
    for i, loss in enumerate(losses):
        n, x, y, xx, xy = (F.col(f"_{m}{i}") for m in ("n", "x", "y", "xx", "xy"))
        spread = n * xx - x * x
        out[f"n_{loss}"] = n.cast("bigint")
        out[f"off_{loss}"] = F.col(f"_off{i}").cast("bigint")
        out[f"slope_{loss}"] = F.when(spread > 0, (n * xy - x * y) / spread)
    return summed.withColumns(out).drop("_later", *moments)


def overfit_check(log: DataFrame, window: int, span: int) -> DataFrame:
    """Trailing slopes of train and eval loss at every logged step, and where they part.

    ``log`` has (run, step, train_loss, eval_loss); the eval loss may be logged
    at few steps. ``overfits`` where, over the last ``span`` steps, the train
    loss falls and the eval loss rises; null where either has fewer than
    ``window`` finite values. Losses that are not finite are counted beside.
    """
    found = trailing_slopes(log, "run", "step", ["train_loss", "eval_loss"], span)
    enough = (F.col("n_train_loss") >= window) & (F.col("n_eval_loss") >= window)
    falls, rises = F.col("slope_train_loss") < 0, F.col("slope_eval_loss") > 0
    return found.select(
        "run",
        "step",
        F.col("n_train_loss").alias("n_train"),
        F.col("n_eval_loss").alias("n_eval"),
        (F.col("off_train_loss") + F.col("off_eval_loss")).alias("n_not_finite"),
        F.col("slope_train_loss").alias("train_slope"),
        F.col("slope_eval_loss").alias("eval_slope"),
        F.when(enough, falls & rises).alias("overfits"),
    )


def tvd_value(temperature: float = 1.0) -> Column:
    """Half the summed difference of teacher's and student's probabilities.

    Missing distributions and unequal widths fail the query.
    """
    value = bind(
        log_softmax(F.col("teacher"), temperature),
        lambda t: bind(
            log_softmax(F.col("student"), temperature),
            lambda s: total(F.zip_with(t, s, lambda p, q: F.abs(F.exp(p) - F.exp(q)))) / 2,
        ),
    )
    return or_fail(F.when(F.size("teacher") == F.size("student"), value), "teacher and student differ in width")


def tvd(df: DataFrame, temperature: float = 1.0) -> DataFrame:
    """Masked mean of the total variation distance."""
    return df.filter(counted()).agg(F.avg(tvd_value(temperature)).alias("tvd"))


def cosine_value(a: Column, b: Column) -> Column:
    """One minus the cosine of two hidden states; null where one has no length.

    Missing states and unequal widths fail the query.
    """
    dot = lambda x, y: total(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")))
    lengths = or_fail(F.when(F.size(a) == F.size(b), dot(a, a) * dot(b, b)), "hidden states differ in width")
    return 1 - F.try_divide(dot(a, b), F.when(lengths > 0, F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))))


def hidden_cosine(df: DataFrame, a: str = "teacher", b: str = "student") -> DataFrame:
    """Masked mean distance of hidden states; ``n_without_direction`` positions have none and stay out of it."""
    value = cosine_value(F.col(a), F.col(b))
    return df.filter(counted()).agg(
        F.avg(value).alias("hidden_cosine"), F.count_if(value.isNull()).alias("n_without_direction")
    )


def uld_value(shared: int) -> Column:
    """Distance across tokenizers: entries both vocabularies share stand first
    and are compared directly, the rest by their sorted probabilities, the
    shorter rest ending in zeros."""

    def distance(p: Column, q: Column) -> Column:
        zero = F.lit(0.0)
        parts = lambda x: (F.slice(x, 1, shared), F.sort_array(F.slice(x, shared + 1, F.greatest(F.size(x) - shared, F.lit(0))), False))
        (a, b), (c, d) = parts(p), parts(q)
        gap = lambda x, y: F.abs(F.coalesce(x, zero) - F.coalesce(y, zero))
        return total(F.zip_with(a, c, gap)) + total(F.zip_with(b, d, gap))

    soft = lambda c: F.transform(log_softmax(F.col(c)), lambda x: F.exp(x))
    return bind(soft("teacher"), lambda p: bind(soft("student"), lambda q: distance(p, q)))


def uld(df: DataFrame, shared: int) -> DataFrame:
    """Masked mean of the distance across tokenizers."""
    return df.filter(counted()).agg(F.avg(uld_value(shared)).alias("uld"))


def align_vocabularies(teacher: DataFrame, student: DataFrame) -> DataFrame:
    """(token, teacher_id, student_id) of two vocabularies (token, id), matched by the tokens' text.

    Tokens of one side only have a null on the other. Where a vocabulary names
    a token twice, its smallest id is matched and the others stand alone.
    """
    first = lambda v, name: v.select(
        "token", F.col("id").cast("bigint").alias(name), F.row_number().over(Window.partitionBy("token").orderBy("id")).alias("nth")
    )
    return first(teacher, "teacher_id").join(first(student, "student_id"), ["token", "nth"], "full").drop("nth")


def vocabulary_overlap(alignment: DataFrame) -> DataFrame:
    """Sizes of both vocabularies and of what they share."""
    t, s = F.col("teacher_id").isNotNull(), F.col("student_id").isNotNull()
    return alignment.agg(
        F.count_if(t).alias("n_teacher"), F.count_if(s).alias("n_student"), F.count_if(t & s).alias("n_shared")
    ).withColumn("share_of_teacher", share(F.col("n_shared"), F.col("n_teacher")))


def aligned_probabilities(logits: np.ndarray, shared: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the shared ids in their order, and of the others, largest first."""
    x = np.asarray(logits, dtype=np.float64)[np.concatenate([shared, rest])]
    p = np.exp(x - x.max(initial=-np.inf))
    p /= p.sum()
    return p[: len(shared)], np.sort(p[len(shared) :])[::-1]


def uld_aligned(df: DataFrame, alignment: DataFrame, max_vocab: int = MAX_VOCABULARY) -> DataFrame:
    """Masked mean of the distance across tokenizers, entries matched by ``align_vocabularies``.

    Both rows of logits are gathered by one index array each: the shared
    tokens in one order, compared directly, and each side's others, compared
    by sorted probability with the shorter rest ending in zeros. Ids that no
    vocabulary names, as in padded heads, have no probability. The arrays are
    as long as the vocabularies, which the models bound; more than
    ``max_vocab`` tokens are refused. A null or a row too short for its ids
    fails the query.
    """
    size = alignment.count()
    if size > max_vocab:
        raise ValueError(f"{size} tokens; a vocabulary has at most {max_vocab}")
    ids = alignment.select("teacher_id", "student_id").toPandas()
    both = ids.dropna().sort_values(["teacher_id", "student_id"])
    alone = ids[ids.isna().any(axis=1)]
    index = {
        c: (both[c].to_numpy(np.int64), np.sort(alone[c].dropna().to_numpy(np.int64))) for c in ("teacher_id", "student_id")
    }
    sent = df.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("double")
    def distance(teacher: pd.Series, student: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(teacher, student):
            if t is None or s is None:
                raise ValueError("a distribution is missing")
            (p, more), (q, others) = (aligned_probabilities(x, *sent.value[c]) for x, c in ((t, "teacher_id"), (s, "student_id")))
            width = max(len(more), len(others))
            rest = np.pad(more, (0, width - len(more))) - np.pad(others, (0, width - len(others)))
            out.append(np.abs(p - q).sum() + np.abs(rest).sum())
        return pd.Series(out, dtype="float64")

    return df.filter(counted()).agg(F.avg(distance("teacher", "student")).alias("uld"))


def format_compliance(shaped: DataFrame, text: str, short: int = 40) -> DataFrame:
    """By model: replies that are nothing but a call or nothing but prose, and short ones that equal their target."""
    bare = F.col("has_name") & F.startswith(F.trim(text), F.lit("{")) & F.endswith(F.trim(text), F.lit("}"))
    fits = F.when(F.col("expects_call"), bare).otherwise(~F.col("any_json"))
    is_short = F.length("target") <= short
    n = F.col("n")
    return (
        shaped.groupBy("model")
        .agg(
            F.count("*").alias("n"),
            F.count_if(fits).alias("n_compliant"),
            F.count_if(is_short).alias("n_short"),
            F.count_if(is_short & (F.trim(text) == F.trim("target"))).alias("n_exact"),
        )
        .withColumns(
            {
                "compliant_rate": share(F.col("n_compliant"), n),
                "exact_rate": share(F.col("n_exact"), F.col("n_short")),
            }
        )
    )
