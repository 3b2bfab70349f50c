"""Registered queries: features, splits, folds and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlake.operators import features as f
from campaignlake.operators.quality import rule_violations, schema_profile
from campaignlake.plans.registry import oracle, register
from campaignlake.session import materialize
from campaignlake.sources.campaign import KEY, TARGET, short_campaign

_FLAGS = """CASE WHEN pdays >= 0 THEN 'yes' ELSE 'no' END AS previously_contacted,
            CASE WHEN pdays >= 0 THEN CAST(pdays AS DOUBLE) END AS pdays_since_previous_contact,
            CASE WHEN balance < 0 THEN 'yes' ELSE 'no' END AS negative_balance"""
_FEATURES = f"""features AS (
  SELECT campaign_record_id, subscribed, age, balance, previous, job, marital, education, "default", housing, loan, poutcome, {_FLAGS} FROM short
)"""
# Rows in the seeded order of each class, and the number of test rows per class.
_ORDERED = """ordered AS (
  SELECT *, row_number() OVER (PARTITION BY subscribed ORDER BY k, campaign_record_id) AS place,
         count(*) OVER (PARTITION BY subscribed) AS class_rows, count(*) OVER () AS all_rows
  FROM (SELECT *, CAST('0x' || substr(md5(campaign_record_id || ':42'), 1, 15) AS BIGINT) AS k FROM short)
), sizes AS (
  SELECT subscribed, CAST(base + CASE WHEN row_number() OVER (ORDER BY exact - base DESC, subscribed) <= draws - sum(base) OVER ()
                            THEN 1 ELSE 0 END AS BIGINT) AS test_rows
  FROM (SELECT subscribed, exact, floor(exact) AS base, draws
        FROM (SELECT subscribed, ceil(any_value(all_rows) * 0.2::DOUBLE) AS draws,
                     ceil(any_value(all_rows) * 0.2::DOUBLE) * any_value(class_rows) / any_value(all_rows) AS exact
              FROM ordered GROUP BY subscribed))
), divided AS (
  SELECT ordered.*, CASE WHEN place <= test_rows THEN 'test' ELSE 'train' END AS split FROM ordered JOIN sizes USING (subscribed)
)"""


def split_campaign(spark, sf_dir):
    """The campaign table with its train/test column."""
    return f.stratified_split(short_campaign(spark, sf_dir), KEY, TARGET)


@register("engineered_features", oracle("SELECT * FROM features", _FEATURES))
def _engineered_features(spark, sf_dir):
    out = f.engineer_features(short_campaign(spark, sf_dir), [KEY, TARGET])
    f.check_features(out, ignore=[KEY, TARGET])
    return out


_RULES = {f"{c}_not_null": f'"{c}" IS NULL' for c in f.MODEL_FEATURES if c != f.NULLABLE}
_RULES["missing_days_match_flag"] = "(pdays_since_previous_contact IS NULL) <> (previously_contacted = 'no')"
_RULES["days_not_negative"] = "previously_contacted = 'yes' AND pdays_since_previous_contact < 0"
for _c in ("previously_contacted", "negative_balance"):
    _RULES[f"{_c}_is_yes_or_no"] = f"{_c} NOT IN ('yes', 'no')"
_HAS = [(c, v) for c in ("previously_contacted", "negative_balance") for v in ("yes", "no")]


@register(
    "feature_checks",
    oracle(
        " UNION ALL ".join(
            [f"SELECT '{n}' AS rule, count(*) FILTER ({c}) AS violations FROM features" for n, c in _RULES.items()]
            + [f"SELECT '{c}_has_{v}', CAST(count(*) FILTER ({c} = '{v}') = 0 AS BIGINT) FROM features" for c, v in _HAS]
        ),
        _FEATURES,
    ),
)
def _feature_checks(spark, sf_dir):
    return rule_violations(f.engineer_features(short_campaign(spark, sf_dir)), f.feature_rules())


@register("stratified_split", oracle("SELECT campaign_record_id, subscribed, split FROM divided", _ORDERED))
def _stratified_split(spark, sf_dir):
    return split_campaign(spark, sf_dir).select(KEY, TARGET, "split")


@register(
    "split_summary",
    oracle(
        """SELECT coalesce(split, 'full_dataset') AS split, count(*) AS record_count, count(*) FILTER (subscribed = 0) AS non_subscribers,
            count(*) FILTER (subscribed = 1) AS subscribers, round_even(100.0::DOUBLE * avg(subscribed), 4) AS subscription_rate_percentage
        FROM divided GROUP BY ROLLUP (split)""",
        _ORDERED,
    ),
)
def _split_summary(spark, sf_dir):
    return f.split_summary(split_campaign(spark, sf_dir), "split", TARGET)


@register(
    "split_check",
    oracle("SELECT split, count(*) AS n FROM divided GROUP BY split", _ORDERED),
)
def _split_check(spark, sf_dir):
    """Sizes after the disjointness and schema check of both parts."""
    rows = materialize(split_campaign(spark, sf_dir).select(KEY, TARGET, "split"), "split")
    train, test = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")
    f.check_split(train, test, KEY, TARGET)
    return train.unionByName(test).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register(
    "stratified_folds",
    oracle(
        """SELECT campaign_record_id, subscribed, CAST(CASE WHEN place - 1 < r * (q + 1) THEN (place - 1) // (q + 1)
                  ELSE r + (place - 1 - r * (q + 1)) // q END AS INTEGER) AS fold
        FROM (SELECT *, class_rows // 5 AS q, class_rows % 5 AS r FROM ordered)""",
        _ORDERED,
    ),
)
def _stratified_folds(spark, sf_dir):
    return f.stratified_folds(short_campaign(spark, sf_dir), KEY, TARGET).select(KEY, TARGET, "fold")


_EXCLUDED = {**{c: "excluded" for c in f.CURRENT_CAMPAIGN}, "pdays": "transformed"}


@register(
    "feature_contract",
    oracle(
        " UNION ALL ".join(
            [f"""SELECT '{c}' AS feature, 'included' AS primary_model_status, count("{c}") AS non_null_count,
                 count(DISTINCT "{c}") + CAST(bool_or("{c}" IS NULL) AS BIGINT) AS distinct_count FROM features"""
             for c in f.MODEL_FEATURES]
            + [f"SELECT '{c}', '{status}', NULL, NULL" for c, status in _EXCLUDED.items()]
        ),
        _FEATURES,
    ),
)
def _feature_contract(spark, sf_dir):
    """Documented features beside what the engineered table holds of them."""
    profile = schema_profile(f.engineer_features(short_campaign(spark, sf_dir)))
    return f.feature_contract(spark).join(profile, F.col("feature") == F.col("column"), "left").select(
        "feature", "primary_model_status", "non_null_count", "distinct_count"
    )


@register("features_with_target", oracle("SELECT campaign_record_id, subscribed, age, balance, negative_balance FROM features", _FEATURES))
def _features_with_target(spark, sf_dir):
    rows = short_campaign(spark, sf_dir)
    joined = f.attach_target(f.engineer_features(rows, [KEY]), rows, KEY)
    return joined.select(KEY, TARGET, "age", "balance", "negative_balance")
