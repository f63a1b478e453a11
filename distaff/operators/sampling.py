"""Seeded samples and exact splits.

Rows are ordered by a salted hash of their key. The n-th smallest hash is
found from the key column alone: histograms over 65,536 hash prefixes name the
bucket that holds it, two levels deep, and the few keys of the last one are
ranked. That one (hash, key) pair is fetched and rows are kept by comparing
with it, so the payload is neither sorted nor shuffled, splits of splits stay
plain projections, and the result does not depend on partitioning. Null keys
take part like any other. Copies of a key fall on the same side; where the cut
would run between them no exact size is possible and the call fails.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distaff.constants import MEDIUM_ROWS, SAMPLE_ROWS, SPLIT_SEED, TEST_SHARE
from distaff.functions.text import hash_uniform, salted_hash

# Four hexadecimal digits: each histogram has at most 65,536 rows, per task and
# in the result the driver looks at. After two of them one row in four thousand
# million is left to rank.
DIGITS_PER_LEVEL = 4
LEVELS = 2


def _last_wanted(df: DataFrame, key: str, seed, wanted):
    """(hash, key) of the last wanted row; ``wanted`` maps total to a count."""
    keys = df.select(salted_hash(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    prefix, rest = "", None
    for _ in range(LEVELS):
        counts = (
            keys.filter(F.col("h").startswith(prefix))
            .groupBy(F.substring("h", 1, len(prefix) + DIGITS_PER_LEVEL).alias("bucket"))
            .count()
            .collect()
        )
        if rest is None:
            rest = wanted(sum(r["count"] for r in counts))
            if rest < 1:
                return None
        for bucket, n in sorted(map(tuple, counts)):
            if rest <= n:
                break
            rest -= n
        prefix = bucket
    # Copies of a key are counted before they are ranked.
    upto = Window.partitionBy("bucket").orderBy("h", "k")
    last = (
        keys.filter(F.col("h").startswith(prefix))
        .groupBy("h", "k")
        .count()
        .withColumn("bucket", F.lit(prefix))
        .withColumn("upto", F.sum("count").over(upto))
        .filter(F.col("upto") >= rest)
        .orderBy("h", "k")
        .first()
    )
    if last["upto"] != rest:
        raise ValueError(f"{key} is repeated at the cut ({last['k']!r}): no exact size is possible")
    return last


def _is_low(df: DataFrame, key: str, seed, wanted) -> Column:
    """True for the ``wanted`` rows of lowest (hash, key), null keys first."""
    last = _last_wanted(df, key, seed, wanted)
    if last is None:
        return F.lit(False)
    h, k = salted_hash(F.col(key), seed), F.lit(last["k"])
    tied = F.col(key).isNull() | F.coalesce(F.col(key) <= k, F.lit(False))
    return (h < last["h"]) | ((h == last["h"]) & tied)


def seeded_sample(
    df: DataFrame, key: str, n: int = SAMPLE_ROWS, seed=SPLIT_SEED
) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, fixed by key and seed."""
    return df.filter(_is_low(df, key, seed, lambda rows: min(rows, n)))


def exact_split(
    df: DataFrame, key: str, test: float = TEST_SHARE, seed=SPLIT_SEED, name: str = "split"
) -> DataFrame:
    """Label ``ceil(test * rows)`` rows ``test`` and all others ``train``."""
    held_out = _is_low(df, key, seed, lambda rows: math.ceil(rows * test))
    return df.withColumn(name, F.when(held_out, "test").otherwise("train"))


def nested_split(
    df: DataFrame, key: str, test: float = TEST_SHARE, seed=SPLIT_SEED
) -> DataFrame:
    """Split the train rows again, for loss monitoring only."""
    train = df.filter(F.col("split") == "train")
    return exact_split(train, key, test, f"{seed}-nested", name="inner_split")


def staged_subset(df: DataFrame, key: str, mode: str, seed=SPLIT_SEED) -> DataFrame:
    """Rows of a run stage: ``smoke`` and ``full`` all, ``medium`` 300 seeded."""
    if mode == "medium":
        return seeded_sample(df, key, MEDIUM_ROWS, f"{seed}-medium")
    if mode in ("smoke", "full"):
        return df
    raise ValueError(f"unknown stage: {mode}")


def split_audit(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Counts of both sides and of keys found on both (must be 0)."""
    sides = train.select(key, F.lit(1).alias("in_train"), F.lit(0).alias("in_test")).unionAll(
        test.select(key, F.lit(0).alias("in_train"), F.lit(1).alias("in_test"))
    )
    per_key = sides.groupBy(key).agg(
        F.sum("in_train").alias("in_train"), F.sum("in_test").alias("in_test")
    )
    return per_key.agg(
        F.coalesce(F.sum("in_train"), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum("in_test"), F.lit(0)).alias("n_test"),
        F.count_if((F.col("in_train") > 0) & (F.col("in_test") > 0)).alias("n_leaked_keys"),
    )


def prompt_overlap(train: DataFrame, test: DataFrame, prompt: str) -> DataFrame:
    """Distinct prompts of both sides that agree once case and white space are ignored.

    Texts are compared by two 64-bit hashes, so only those are shuffled.
    """
    plain = F.trim(F.regexp_replace(F.lower(F.col(prompt)), r"\s+", " "))
    hashed = [F.xxhash64(plain).alias("_h"), F.xxhash64(F.reverse(plain)).alias("_r")]
    sides = train.select(*hashed, F.lit(1).alias("in_train"), F.lit(0).alias("in_test")).unionAll(
        test.select(*hashed, F.lit(0).alias("in_train"), F.lit(1).alias("in_test"))
    )
    per_prompt = sides.groupBy("_h", "_r").agg(F.sum("in_train").alias("a"), F.sum("in_test").alias("b"))
    both = (F.col("a") > 0) & (F.col("b") > 0)
    return per_prompt.agg(
        F.count_if(F.col("a") > 0).alias("n_train_prompts"),
        F.count_if(F.col("b") > 0).alias("n_test_prompts"),
        F.count_if(both).alias("n_shared_prompts"),
        F.coalesce(F.sum(F.when(both, F.col("b"))), F.lit(0)).alias("n_test_rows"),
    )


def policy_mix(df: DataFrame, step: str, lmbda: float, seed=SPLIT_SEED) -> DataFrame:
    """Mark the steps that train on the student's own rollouts."""
    return df.withColumn("on_policy", hash_uniform(F.col(step), seed) < F.lit(lmbda))


def mode_parts(split: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """(part, key) of ``held_out``, ``filtered`` and ``unfiltered`` rows, each input read once."""
    marked = split.join(kept.select(key).distinct().withColumn("_kept", F.lit(True)), key, "left")
    train = F.col("split") == "train"
    parts = F.array_compact(
        F.array(
            F.when(~train, "held_out"),
            F.when(train & F.col("_kept").isNotNull(), "filtered"),
            F.when(train, "unfiltered"),
        )
    )
    return marked.select(F.explode(parts).alias("part"), key)


def mode_select(
    df: DataFrame, kept: DataFrame | None, key: str, held_out: bool = False, filtered: bool = False
) -> DataFrame:
    """Held-out rows, all train rows, or the train rows a filter kept.

    The filter never applies to held-out rows.
    """
    if held_out:
        return df.filter(F.col("split") == "test")
    train = df.filter(F.col("split") == "train")
    if not filtered:
        return train
    return train.join(kept.select(key), key, "left_semi")
