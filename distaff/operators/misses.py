"""Which examples a model misses, and how misses of models overlap."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distaff.functions.text import percent
from distaff.operators.scoring import has_call_truth

MISS_COLUMNS = [
    "model",
    "example_id",
    "user_turn",
    "gt_name",
    "gt_args",
    "pred_name",
    "pred_args",
    "name_matched",
]


def collect_misses(scored: DataFrame) -> DataFrame:
    """Call rows a model did not get exactly, with both calls side by side."""
    return (
        scored.filter(has_call_truth() & ~F.col("exact_args"))
        .withColumn("pred_name", F.col("call.name"))
        .withColumn("pred_args", F.col("call.arguments"))
        .withColumn("name_matched", F.col("correct_name"))
        .select(*MISS_COLUMNS)
    )


def _of(model: str, value: Column) -> Column:
    return F.max(F.when(F.col("model") == model, value))


def paired_misses(misses: DataFrame, a: str, b: str) -> DataFrame:
    """One row per example that a or b missed, from one grouping."""
    wrong = F.struct("pred_name", "pred_args")
    return (
        misses.filter(F.col("model").isin(a, b))
        .groupBy("example_id")
        .agg(_of(a, wrong).alias("wrong_a"), _of(b, wrong).alias("wrong_b"))
        .withColumn("missed_a", F.col("wrong_a").isNotNull())
        .withColumn("missed_b", F.col("wrong_b").isNotNull())
    )


def miss_overlap(misses: DataFrame, a: str, b: str) -> DataFrame:
    """Misses of each model, shared ones and those of one model only."""
    in_a, in_b = F.col("missed_a"), F.col("missed_b")
    return paired_misses(misses, a, b).agg(
        F.count_if(in_a).alias("n_a"),
        F.count_if(in_b).alias("n_b"),
        F.count_if(in_a & in_b).alias("n_shared"),
        F.count_if(in_a & ~in_b).alias("n_only_a"),
        F.count_if(in_b & ~in_a).alias("n_only_b"),
    )


def unique_misses(misses: DataFrame, a: str, b: str) -> DataFrame:
    """Miss rows of ``a`` on examples ``b`` got right, from one grouping."""
    row = F.struct(*[F.col(c) for c in MISS_COLUMNS])
    return (
        misses.filter(F.col("model").isin(a, b))
        .groupBy("example_id")
        .agg(_of(a, row).alias("row"), _of(b, F.lit(1)).alias("other"))
        .filter("row IS NOT NULL AND other IS NULL")
        .select("row.*")
    )


def identical_wrong(misses: DataFrame, a: str, b: str) -> DataFrame:
    """Shared misses on which both models gave the same wrong call.

    A JSON null and an absent key read alike, as in ``dict.get``.
    """
    shared = paired_misses(misses, a, b).filter("missed_a AND missed_b")

    def got(side, field):
        return F.nullif(F.col(side)[field], F.lit("null"))

    same = got("wrong_a", "pred_name").eqNullSafe(got("wrong_b", "pred_name")) & got(
        "wrong_a", "pred_args"
    ).eqNullSafe(got("wrong_b", "pred_args"))
    return shared.filter(same).select(
        "example_id",
        F.col("wrong_a.pred_name").alias("pred_name"),
        F.col("wrong_a.pred_args").alias("pred_args"),
    )


def fp_overlap(scored: DataFrame, model: str, references: list[str]) -> DataFrame:
    """How far one model's false positives are those of reference models."""
    false_positive = ~F.col("gt_is_call") & F.col("pred_is_call")
    flags = [_of(m, F.lit(1)).isNotNull().alias(f"fp_{i}") for i, m in enumerate(references)]
    per_example = (
        scored.filter(false_positive & F.col("model").isin(model, *references))
        .groupBy("example_id")
        .agg(_of(model, F.lit(1)).isNotNull().alias("fp_model"), *flags)
    )
    mine = F.col("fp_model")
    counts = [F.count_if(mine).alias("n_fp")]
    for i, _ in enumerate(references):
        counts.append(F.count_if(F.col(f"fp_{i}")).alias(f"n_ref_{i}"))
        counts.append(F.count_if(mine & F.col(f"fp_{i}")).alias(f"n_both_{i}"))
    per_reference = F.array(
        *[
            F.struct(
                F.lit(m).alias("reference"),
                F.col(f"n_ref_{i}").alias("n_reference"),
                F.col(f"n_both_{i}").alias("n_both"),
            )
            for i, m in enumerate(references)
        ]
    )
    floor = F.greatest(F.col("n_fp"), F.lit(1))
    return (
        per_example.agg(*counts)
        .select("n_fp", F.inline(per_reference))
        .withColumn("n_only_model", F.col("n_fp") - F.col("n_both"))
        .withColumn("overlap_pct", percent(F.col("n_both"), floor))
        .withColumn("unique_pct", percent(F.col("n_only_model"), floor))
    )


def unique_false_positives(scored: DataFrame, model: str, reference: str) -> DataFrame:
    """Calls ``model`` made where none was due and ``reference`` made none, from one grouping."""
    row = F.struct("user_turn", F.col("call.name").alias("pred_name"), F.col("call.arguments").alias("pred_args"))
    wrong = ~F.col("gt_is_call") & F.col("pred_is_call") & F.col("model").isin(model, reference)
    return (
        scored.filter(wrong)
        .groupBy("example_id")
        .agg(_of(model, row).alias("row"), _of(reference, F.lit(1)).alias("other"))
        .filter("row IS NOT NULL AND other IS NULL")
        .select("example_id", "row.*")
    )


def index_set_ops(a: DataFrame, b: DataFrame, key: str = "example_id") -> DataFrame:
    """Keys in both sets and in the first only, as labelled rows.

    One grouping of the tagged union gives intersection and difference.
    """
    tagged = a.select(key, F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).unionAll(
        b.select(key, F.lit(False).alias("in_a"), F.lit(True).alias("in_b"))
    )
    return (
        tagged.groupBy(key)
        .agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
        .filter("in_a")
        .select(key, F.when(F.col("in_b"), "both").otherwise("only_a").alias("side"))
    )


def multi_model_overlap(misses: DataFrame) -> DataFrame:
    """Number of examples missed by exactly each set of models."""
    sets = misses.groupBy("example_id").agg(
        F.array_join(F.sort_array(F.collect_set("model")), "+").alias("models")
    )
    return sets.groupBy("models").agg(F.count("*").alias("n_examples"))


def miss_class(misses: DataFrame) -> DataFrame:
    """Class of each differing argument of a miss.

    The rules restate what a person found reading misses: a different call,
    placeholder arguments left out, singular for plural, a date that only the
    label's author could know, and content that is lost or changed. They are
    rules of this library and only an aid to reading.
    """

    def arguments(column):
        as_map = F.try_parse_json(F.col(column)).try_cast("map<string,variant>")
        return F.coalesce(as_map, F.create_map().cast("map<string,variant>"))

    keyed = misses.withColumn("_gt", arguments("gt_args")).withColumn(
        "_pred", arguments("pred_args")
    )
    keys = F.array_union(F.map_keys("_gt"), F.map_keys("_pred"))
    per_key = (
        keyed.select("*", F.explode_outer(keys).alias("key"))
        .withColumn("gt_value", F.to_json(F.element_at("_gt", F.col("key"))))
        .withColumn("pred_value", F.to_json(F.element_at("_pred", F.col("key"))))
    )
    gt, pred = F.col("gt_value"), F.col("pred_value")
    plural = lambda x: F.regexp_replace(F.lower(x), 's?"$', '"')
    date = r'^"\d{4}-\d{2}-\d{2}'
    # Each rule is tried in turn; the first that fits names the class.
    kind = (
        F.when(F.col("pred_name").isNull(), "no_call")
        .when(~F.col("name_matched"), "other_call")
        .when(gt.eqNullSafe(pred), "equal")
        .when(pred.isNull() & gt.isin('""', "null", "[]", "{}"), "placeholder_left_out")
        .when(gt.isNull(), "added")
        .when(pred.isNull(), "left_out")
        .when(gt.rlike(date) & pred.rlike(date), "date")
        .when(plural(gt) == plural(pred), "singular_plural")
        .otherwise("changed")
    )
    return (
        per_key.withColumn("miss_class", kind)
        .filter("miss_class <> 'equal'")
        .select("model", "example_id", "key", "gt_value", "pred_value", "miss_class")
    )
