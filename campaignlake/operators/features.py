"""Leakage-safe features, stratified splits and folds, and their checks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campaignlake.functions.bands import negative_flag, sentinel_flag, sentinel_value
from campaignlake.functions.numbers import percent
from campaignlake.operators.quality import Rule, check_counts, require_rules
from campaignlake.operators.scan import at_or_before, hash_cuts, hash_key

# Feature lists of the pre-campaign model.
CURRENT_CAMPAIGN = ["contact", "day", "month", "duration", "campaign"]
RAW_INPUTS = [
    "age", "job", "marital", "education", "default", "balance", "housing", "loan", "pdays", "previous", "poutcome",
]
NUMERIC_FEATURES = ["age", "balance", "previous", "pdays_since_previous_contact"]
CATEGORICAL_FEATURES = [
    "job", "marital", "education", "default", "housing", "loan", "poutcome", "previously_contacted", "negative_balance",
]
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
NULLABLE = "pdays_since_previous_contact"
SEED = 42
TEST_SHARE = 0.2
MOST_CLASSES = 100

# Feature, source or derived, status in the pre-campaign model, representation.
_CONTRACT = [
    ("age", "source", "included", "numeric"),
    ("job", "source", "included", "categorical"),
    ("marital", "source", "included", "categorical"),
    ("education", "source", "included", "categorical"),
    ("default", "source", "included", "categorical"),
    ("balance", "source", "included", "numeric"),
    ("housing", "source", "included", "categorical"),
    ("loan", "source", "included", "categorical"),
    ("contact", "source", "excluded", "not used"),
    ("day", "source", "excluded", "not used"),
    ("month", "source", "excluded", "not used"),
    ("duration", "source", "excluded", "not used"),
    ("campaign", "source", "excluded", "not used"),
    ("pdays", "source", "transformed", "not used directly"),
    ("previous", "source", "included", "numeric"),
    ("poutcome", "source", "included", "categorical"),
    ("previously_contacted", "derived", "included", "categorical"),
    ("pdays_since_previous_contact", "derived", "included", "numeric"),
    ("negative_balance", "derived", "included", "categorical"),
]


def engineer_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 13 model features in fixed order, after any columns to keep (key, target).

    One projection: it reads only the inputs it needs and shuffles nothing.
    """
    missing = sorted(set(RAW_INPUTS) - set(df.columns))
    if missing:
        raise ValueError(f"Required raw features are missing: {missing}")
    derived = {
        "previously_contacted": sentinel_flag(F.col("pdays")),
        NULLABLE: sentinel_value(F.col("pdays")),
        "negative_balance": negative_flag(F.col("balance")),
    }
    return df.select(*keep, *[derived[c].alias(c) if c in derived else F.col(c) for c in MODEL_FEATURES])


def feature_rules() -> list[Rule]:
    """Row rules of the feature table: nulls, the sentinel pair, and both flag values."""
    flag, days = F.col("previously_contacted"), F.col(NULLABLE)
    rules = [Rule(f"{c}_not_null", F.col(c).isNotNull()) for c in MODEL_FEATURES if c != NULLABLE]
    rules.append(Rule("missing_days_match_flag", days.isNull() == (flag == "no"), nulls_fail=True))
    rules.append(Rule("days_not_negative", (flag != "yes") | (days >= 0)))
    for c in ("previously_contacted", "negative_balance"):
        rules.append(Rule(f"{c}_is_yes_or_no", F.col(c).isin("yes", "no"), nulls_fail=True))
        for value in ("yes", "no"):
            rules.append(Rule(f"{c}_has_{value}", F.count_if(F.col(c) == value) > 0, kind="total"))
    return rules


def check_feature_columns(columns: Sequence[str], target: str = "subscribed", forbidden=tuple(CURRENT_CAMPAIGN)) -> None:
    """Column order, no current-campaign column, no target among the features."""
    found = sorted(set(columns) & set(forbidden))
    if found:
        raise ValueError(f"Current-campaign features must stay out of the model: {found}")
    if target in columns:
        raise ValueError(f"The target column {target!r} must not be a model feature.")
    if list(columns) != MODEL_FEATURES:
        raise ValueError(f"The model needs these feature columns in this order: {MODEL_FEATURES}")


def check_features(df: DataFrame, target: str = "subscribed", ignore: Sequence[str] = ()) -> None:
    """All checks of a feature table: metadata first, then one aggregation."""
    check_feature_columns([c for c in df.columns if c not in ignore], target)
    require_rules(df, feature_rules(), "the feature table")


def _class_counts(df: DataFrame, target: str) -> dict:
    """Rows per class. The driver holds one number per class and one cut point per class and split."""
    classes = df.groupBy(target).count()
    known = classes.agg(F.count(F.lit(1)).alias("classes"), F.count_if(F.col(target).isNull()).alias("nulls")).first()
    if known["classes"] > MOST_CLASSES or known["nulls"]:
        raise ValueError(
            f"The target has {known['classes']} classes, nulls included: stratification takes at most {MOST_CLASSES} "
            "and no nulls. Continuous targets need bands first."
        )
    return {row[target]: row["count"] for row in classes.collect()}


def allocate(counts: Mapping, draws: int) -> dict:
    """Split `draws` over classes in proportion, the largest remainders getting the rest."""
    total = sum(counts.values())
    exact = {c: draws * n / total for c, n in counts.items()}
    out = {c: math.floor(v) for c, v in exact.items()}
    short = draws - sum(out.values())
    for c in sorted(exact, key=lambda c: (out[c] - exact[c], str(c)))[:short]:
        out[c] += 1
    return out


def stratified_split(
    df: DataFrame, key: str, target: str, test_share: float = TEST_SHARE, seed: int = SEED, out: str = "split"
) -> DataFrame:
    """Add a column holding `train` or `test`, with exact class-proportional sizes.

    The test set has `ceil(n * test_share)` rows: in each class, the first ones in a seeded order of
    the unique key. The order's cut points are found from counts (`hash_cuts`); assigning a row is
    then a comparison, so the table is neither sorted nor shuffled.
    """
    counts = _class_counts(df, target)
    sizes = allocate(counts, math.ceil(sum(counts.values()) * test_share))
    cuts = hash_cuts(df, key, target, {c: [k] for c, k in sizes.items() if k > 0}, seed)
    test = F.lit(False)
    for (group, _), cut in cuts.items():
        test = test | ((F.col(target) == F.lit(group)) & at_or_before(F.col("_key"), key, cut))
    keyed = df.withColumn("_key", hash_key(F.col(key), seed))
    return keyed.withColumn(out, F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("_key")


def stratified_folds(
    df: DataFrame, key: str, target: str, k: int = 5, seed: int = SEED, out: str = "fold"
) -> DataFrame:
    """Add a fold number 0..k-1; every class is spread over the folds, sizes differ by one at most.

    Works like `stratified_split`, with k - 1 cut points per class.
    """
    counts = _class_counts(df, target)
    ranks = {}
    for c, n in counts.items():
        ends, at = [], 0
        for fold in range(k - 1):
            at += n // k + (1 if fold < n % k else 0)
            ends.append(at)
        ranks[c] = ends
    cuts = hash_cuts(df, key, target, {c: sorted({r for r in ends if r > 0}) for c, ends in ranks.items()}, seed)
    number: Column = F.lit(None).cast("int")
    for c, ends in ranks.items():
        fold = F.lit(0)
        for end in ends:
            past = F.lit(True) if end == 0 else ~at_or_before(F.col("_key"), key, cuts[(c, end)])
            fold = fold + past.cast("int")
        number = F.when(F.col(target) == F.lit(c), fold).otherwise(number)
    return df.withColumn("_key", hash_key(F.col(key), seed)).withColumn(out, number).drop("_key")


def split_summary(df: DataFrame, split: str, target: str) -> DataFrame:
    """Rows, classes and positive rate of the whole table and of each split, in one scan."""
    y = F.col(target)
    grouped = df.rollup(split).agg(
        F.grouping_id().alias("_all"),
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(y == 0).alias("non_subscribers"),
        F.count_if(y == 1).alias("subscribers"),
    )
    name = F.when(F.col("_all") == 1, F.lit("full_dataset")).otherwise(F.col(split))
    return grouped.select(
        name.alias("split"),
        "record_count",
        "non_subscribers",
        "subscribers",
        percent(F.col("subscribers"), F.col("record_count"), 4, True).alias("subscription_rate_percentage"),
    )


def feature_contract(spark: SparkSession) -> DataFrame:
    """The 19 documented features as a table.

    Columns of the running campaign are excluded because they are not known when clients are chosen.
    """
    return spark.createDataFrame(
        _CONTRACT,
        "feature string, source_or_derived string, primary_model_status string, model_representation string",
    )


def attach_target(features: DataFrame, targets: DataFrame, key: str, target: str = "subscribed") -> DataFrame:
    """Join features and target on their key; fails when a key repeats or is on one side only.

    Both checks run before the join is returned, over the keys alone. Both sides have a row per key, so neither
    is broadcast, however small a well compressed file makes its columns look.
    """
    sides = features.select(key, F.lit(1).alias("_f"), F.lit(0).alias("_t")).unionAll(
        targets.select(key, F.lit(0).alias("_f"), F.lit(1).alias("_t")))
    counted = sides.groupBy(key).agg(F.sum("_f").alias("_f"), F.sum("_t").alias("_t"))
    wrong = counted.agg(
        F.count_if(F.greatest("_f", "_t") > 1).alias("repeated"), F.count_if(F.least("_f", "_t") == 0).alias("apart"),
        F.count_if(F.col(key).isNull()).alias("missing"),
    ).first()
    if wrong["repeated"] or wrong["apart"] or wrong["missing"]:
        raise ValueError(
            f"Feature and target keys are not aligned: {wrong['repeated']} keys repeat, {wrong['apart']} are on one side "
            f"only, {wrong['missing']} are null."
        )
    return features.join(targets.select(key, target).hint("merge"), key)


def check_split(
    train: DataFrame,
    test: DataFrame,
    key: str,
    target: str,
    expected_train: Mapping[str, int] | None = None,
    expected_test: Mapping[str, int] | None = None,
) -> None:
    """Sizes, class counts, equal schemas and disjoint keys of a split."""
    if train.columns != test.columns:
        raise ValueError("Train and test schemas differ.")
    for part, expected in ((train, expected_train), (test, expected_test)):
        if expected:
            check_counts(part, target, expected)
    if not train.join(test.select(key), key, "left_semi").isEmpty():
        raise ValueError("Train and test rows overlap.")
