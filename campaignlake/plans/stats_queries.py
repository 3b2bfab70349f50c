"""Registered queries: tests, effect sizes, intervals, correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlake.functions.bands import sentinel_flag
from campaignlake.operators import segments, stats
from campaignlake.plans.registry import ORACLES, oracle, register
from campaignlake.sources.campaign import KEY, TARGET, campaign, short_campaign, table

FEATURES = ["job", "marital", "education", "default", "housing", "loan", "contact", "month", "poutcome",
            "previously_contacted"]
NUMBERS = ["age", "balance", "day", "duration", "campaign", "pdays", "previous"]


def analysis_table(spark, sf_dir):
    """The campaign table under short names, with the previous-contact flag."""
    return short_campaign(spark, sf_dir).withColumn("previously_contacted", sentinel_flag(F.col("pdays")))


def group_tests():
    """The six rank tests of the report."""
    contacted = F.col("pdays") >= 0
    return [
        stats.GroupTest("age", "age"),
        stats.GroupTest("balance", "balance"),
        stats.GroupTest("duration", "duration", leakage_sensitive=True),
        stats.GroupTest("campaign", "campaign"),
        stats.GroupTest("previous", "previous"),
        stats.GroupTest("pdays_previously_contacted", "pdays", "previously_contacted_clients", contacted),
    ]


def comparisons():
    return [
        stats.Comparison("Previous success vs other outcomes", "Previous outcome: success", F.col("poutcome") == "success",
                         "Other previous outcomes", F.col("poutcome") != "success"),
        stats.Comparison("Urgent vs unknown contact", "Urgent contact", F.col("contact") == "urgent",
                         "Unknown contact", F.col("contact") == "unknown"),
        stats.Comparison("One campaign contact vs multiple contacts", "One campaign contact", F.col("campaign") == 1,
                         "Multiple campaign contacts", F.col("campaign") > 1),
    ]


_ANALYSIS = """analysis AS (
  SELECT *, CASE WHEN pdays >= 0 THEN 'yes' ELSE 'no' END AS previously_contacted FROM short
)"""
_CELLS = "cells AS (" + " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, "{f}" AS segment, count(*)::DOUBLE AS n, sum(subscribed)::DOUBLE AS k FROM analysis GROUP BY 2"""
    for f in FEATURES
) + ")"
_CHI = """chi AS (
  SELECT feature, count(*) AS r, CAST(sum(n) AS BIGINT) AS total,
         sum((k - n * p / t) ^ 2 / (n * p / t) + ((n - k) - n * (t - p) / t) ^ 2 / (n * (t - p) / t)) AS stat,
         min(least(n * p / t, n * (t - p) / t)) AS low,
         count(*) FILTER (n * p / t < 5) + count(*) FILTER (n * (t - p) / t < 5) AS below
  FROM (SELECT *, sum(n) OVER (PARTITION BY feature) AS t, sum(k) OVER (PARTITION BY feature) AS p FROM cells)
  GROUP BY feature
)"""


def _tail(name: str, source: str, key: str, a: str, x: str) -> str:
    """CTE (key, p): upper tail of the regularised incomplete gamma function, by its series."""
    return f"""{name} AS (
  SELECT {key}, CASE WHEN x <= 0 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE,
           1 - sum(exp((a + i) * ln(greatest(x, 1e-300)) - x - lgamma(a + i + 1)))) END AS p
  FROM (SELECT {key}, {a} AS a, {x} AS x FROM {source}), range(0, 4000) AS steps(i)
  GROUP BY {key}, x
)"""


_CHI_P = _tail("chi_p", "chi", "feature", "(r - 1) / 2.0::DOUBLE", "stat / 2")
_LABEL = """CASE WHEN abs({e}) < 0.10 THEN 'Negligible' WHEN abs({e}) < 0.30 THEN 'Small'
            WHEN abs({e}) < 0.50 THEN 'Moderate' ELSE 'Large' END"""
_V = "sqrt(stat / total)"


@register(
    "chi_square_tests",
    oracle(
        f"""SELECT feature, r AS number_of_categories, total AS sample_size, round(stat, 6) AS chi_square_statistic,
            r - 1 AS degrees_of_freedom, round({_V}, 8) AS cramers_v, round(low, 6) AS minimum_expected_frequency,
            below AS expected_cells_below_five, round_even(100.0::DOUBLE * below / (2 * r), 2) AS expected_cells_below_five_percentage,
            low < 1 OR round_even(100.0::DOUBLE * below / (2 * r), 2) > 20 AS assumption_warning,
            {_LABEL.format(e=_V)} AS effect_size_interpretation, round(p, 9) AS p_value
        FROM chi JOIN chi_p USING (feature)""",
        _ANALYSIS, _CELLS, _CHI, _CHI_P,
    ),
)
def _chi_square_tests(spark, sf_dir):
    out = stats.chi_square_tests(analysis_table(spark, sf_dir), FEATURES, TARGET)
    places = {"chi_square_statistic": 6, "cramers_v": 8, "minimum_expected_frequency": 6, "p_value": 9}
    return out.withColumns({c: F.round(c, n) for c, n in places.items()})


@register(
    "cramers_v",
    oracle(f"SELECT feature, round({_V}, 8) AS cramers_v FROM chi", _ANALYSIS, _CELLS, _CHI),
)
def _cramers_v(spark, sf_dir):
    tests = stats.chi_square_tests(analysis_table(spark, sf_dir), FEATURES, TARGET, p_values=False)
    return tests.select("feature", F.round("cramers_v", 8).alias("cramers_v"))


@register(
    "assumption_review",
    oracle(
        """SELECT feature, round(low, 6) AS minimum_expected_frequency, below AS expected_cells_below_five,
            round_even(100.0::DOUBLE * below / (2 * r), 2) AS expected_cells_below_five_percentage,
            low < 1 OR round_even(100.0::DOUBLE * below / (2 * r), 2) > 20 AS assumption_warning FROM chi""",
        _ANALYSIS, _CELLS, _CHI,
    ),
)
def _assumption_review(spark, sf_dir):
    tests = stats.chi_square_tests(analysis_table(spark, sf_dir), FEATURES, TARGET, p_values=False)
    return stats.assumption_review(tests).withColumn("minimum_expected_frequency", F.round("minimum_expected_frequency", 6))


_NUMERIC = "numbers AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS name, '{column}' AS source, '{subset}' AS subset, {leak} AS leak, CAST({column} AS DOUBLE) AS v, subscribed AS y FROM analysis {where}"
    for name, column, subset, leak, where in (
        ("age", "age", "all_clients", "false", ""), ("balance", "balance", "all_clients", "false", ""),
        ("duration", "duration", "all_clients", "true", ""), ("campaign", "campaign", "all_clients", "false", ""),
        ("previous", "previous", "all_clients", "false", ""),
        ("pdays_previously_contacted", "pdays", "previously_contacted_clients", "false", "WHERE pdays >= 0"),
    )
) + ")"
_MWU = """mwu AS (
  SELECT *, rank_sum - n1 * (n1 + 1) / 2 AS u,
         sqrt(n1 * n0 / 12 * ((n + 1) - ties / (n * (n - 1)))) AS s
  FROM (SELECT name, any_value(source) AS source, any_value(subset) AS subset, any_value(leak) AS leak,
               sum(mid) FILTER (y = 1) AS rank_sum, count(*)::DOUBLE AS n,
               count(*) FILTER (y = 1)::DOUBLE AS n1, count(*) FILTER (y = 0)::DOUBLE AS n0,
               sum(same * same - 1) AS ties, avg(v) FILTER (y = 1) AS mean1, avg(v) FILTER (y = 0) AS mean0,
               median(v) FILTER (y = 1) AS median1, median(v) FILTER (y = 0) AS median0
        FROM (SELECT *, rank() OVER (PARTITION BY name ORDER BY v) + (same - 1) / 2 AS mid
              FROM (SELECT *, count(*) OVER (PARTITION BY name, v)::DOUBLE AS same FROM numbers))
        GROUP BY name)
)"""
_Z = "((greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5::DOUBLE) / s)"
_MWU_P = _tail("mwu_p", "mwu", "name", "0.5::DOUBLE", f"CASE WHEN {_Z} <= 0 THEN 0 ELSE {_Z} ^ 2 / 2 END")
_EFFECT = "(2 * u / (n1 * n0) - 1)"


@register(
    "mann_whitney_tests",
    oracle(
        f"""SELECT name AS analysis_name, source AS source_feature, subset, leak AS leakage_sensitive,
            CAST(n1 AS BIGINT) AS subscriber_sample_size, CAST(n0 AS BIGINT) AS non_subscriber_sample_size,
            round(mean1, 6) AS subscriber_mean, round(mean0, 6) AS non_subscriber_mean, median1 AS subscriber_median,
            median0 AS non_subscriber_median, median1 - median0 AS median_difference,
            CASE WHEN median1 > median0 THEN 'Higher among subscribers' WHEN median1 < median0 THEN 'Lower among subscribers'
                 ELSE 'Equal medians' END AS median_direction,
            u AS mann_whitney_u, round({_Z}, 6) AS z_statistic, round({_EFFECT}, 8) AS rank_biserial_correlation,
            round(abs({_EFFECT}), 8) AS absolute_effect_size, {_LABEL.format(e=_EFFECT)} AS effect_size_interpretation,
            round(p, 9) AS p_value
        FROM mwu JOIN mwu_p USING (name)""",
        _ANALYSIS, _NUMERIC, _MWU, _MWU_P,
    ),
)
def _mann_whitney_tests(spark, sf_dir):
    out = stats.mann_whitney_tests(analysis_table(spark, sf_dir), group_tests(), TARGET)
    places = {"subscriber_mean": 6, "non_subscriber_mean": 6, "z_statistic": 6, "rank_biserial_correlation": 8,
              "absolute_effect_size": 8, "p_value": 9}
    return out.withColumns({c: F.round(c, n) for c, n in places.items()})


@register(
    "event_value_rank_test",
    oracle(
        f"""SELECT name AS analysis_name, CAST(n1 AS BIGINT) AS subscriber_sample_size, CAST(n0 AS BIGINT) AS non_subscriber_sample_size,
            u AS mann_whitney_u, round({_EFFECT}, 8) AS rank_biserial_correlation FROM mwu""",
        """numbers AS (SELECT 'value' AS name, 'value' AS source, 'all' AS subset, false AS leak, value AS v,
                       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events WHERE value IS NOT NULL)""",
        _MWU,
    ),
)
def _event_value_rank_test(spark, sf_dir):
    """The rank test on a wide-domain double: event values of purchases against the rest."""
    rows = table(spark, sf_dir, "events").withColumn("y", (F.col("event_type") == "purchase").cast("int"))
    out = stats.mann_whitney_tests(rows, [stats.GroupTest("value", "value")], "y", p_values=False)
    return out.select(
        "analysis_name", "subscriber_sample_size", "non_subscriber_sample_size", "mann_whitney_u",
        F.round("rank_biserial_correlation", 8).alias("rank_biserial_correlation"),
    )


def all_tests(spark, sf_dir):
    """(family, test, effect, label, p_value) of both report families."""
    rows = analysis_table(spark, sf_dir)
    chi = stats.chi_square_tests(rows, FEATURES, TARGET).select(
        F.lit("categorical").alias("family"), F.col("feature").alias("test"), F.col("cramers_v").alias("effect"),
        "effect_size_interpretation", "p_value",
    )
    rank = stats.mann_whitney_tests(rows, group_tests(), TARGET).select(
        F.lit("numeric").alias("family"), F.col("analysis_name").alias("test"),
        F.col("rank_biserial_correlation").alias("effect"), "effect_size_interpretation", "p_value",
    )
    return stats.benjamini_hochberg(chi.unionByName(rank), "p_value", ["family"], ["test"])


_TESTS = f"""tests AS (
  SELECT 'categorical' AS family, feature AS test, {_V} AS effect, p FROM chi JOIN chi_p USING (feature)
  UNION ALL SELECT 'numeric', name, {_EFFECT}, p FROM mwu JOIN mwu_p USING (name)
), adjusted AS (
  SELECT family, test, effect, p, least(1.0::DOUBLE, min(scaled) OVER (PARTITION BY family ORDER BY rk DESC)) AS q
  FROM (SELECT *, p * count(*) OVER (PARTITION BY family) / rk AS scaled
        FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY p, test) AS rk FROM tests))
)"""
_ALL = (_ANALYSIS, _CELLS, _CHI, _CHI_P, _NUMERIC, _MWU, _MWU_P, _TESTS)


@register(
    "adjusted_p_values",
    oracle(
        f"""SELECT family, test, round(effect, 8) AS effect, {_LABEL.format(e='effect')} AS effect_size_interpretation,
            round(p, 8) AS p_value, round(q, 8) AS adjusted_p_value_bh, q < 0.05 AS reject_null_fdr_0_05 FROM adjusted""",
        *_ALL,
    ),
)
def _adjusted_p_values(spark, sf_dir):
    return all_tests(spark, sf_dir).withColumns({c: F.round(c, 8) for c in ("effect", "p_value", "adjusted_p_value_bh")})


@register(
    "practical_significance",
    oracle(
        f"""SELECT family, test, round(effect, 8) AS effect, q < 0.05 AS reject_null_fdr_0_05,
            q < 0.05 AND abs(effect) < 0.30 AS statistically_significant_but_small_or_negligible FROM adjusted""",
        *_ALL,
    ),
)
def _practical_significance(spark, sf_dir):
    return stats.practical_significance(all_tests(spark, sf_dir)).select(
        "family", "test", F.round("effect", 8).alias("effect"), "reject_null_fdr_0_05",
        "statistically_significant_but_small_or_negligible",
    )


@register(
    "effect_sizes_by_label",
    oracle(
        f"""SELECT q < 0.05 AS reject_null_fdr_0_05, {_LABEL.format(e='effect')} AS effect_size_interpretation, count(*) AS size
        FROM adjusted GROUP BY ALL""",
        *_ALL,
    ),
)
def _effect_sizes_by_label(spark, sf_dir):
    return segments.size_by(all_tests(spark, sf_dir), ["reject_null_fdr_0_05", "effect_size_interpretation"])


@register(
    "top_effects",
    oracle(
        "SELECT family, test, round(abs(effect), 8) AS strength FROM adjusted ORDER BY abs(effect) DESC, test LIMIT 5", *_ALL
    ),
)
def _top_effects(spark, sf_dir):
    sized = all_tests(spark, sf_dir).withColumn("strength", F.abs("effect"))
    top = segments.top_k(sized, [F.desc("strength"), F.col("test")], 5)
    return top.select("family", "test", F.round("strength", 8).alias("strength"))


_ZVALUE = repr(stats.z_score(stats.CONFIDENCE))


@register(
    "wilson_interval",
    oracle(
        f"""SELECT CAST(n AS BIGINT) AS total_clients, CAST(k AS BIGINT) AS subscribers,
            round(100 * k / n, 8) AS estimated_subscription_rate_percentage,
            round(100 * (k / n + z * z / (2 * n) - z * sqrt(k / n * (1 - k / n) / n + z * z / (4 * n * n))) / (1 + z * z / n), 8)
              AS ci_lower_percentage,
            round(100 * (k / n + z * z / (2 * n) + z * sqrt(k / n * (1 - k / n) / n + z * z / (4 * n * n))) / (1 + z * z / n), 8)
              AS ci_upper_percentage,
            0.95::DOUBLE AS confidence_level, 'Wilson score interval' AS method
        FROM (SELECT count(*)::DOUBLE AS n, sum(subscribed)::DOUBLE AS k, {_ZVALUE}::DOUBLE AS z FROM campaign)"""
    ),
)
def _wilson_interval(spark, sf_dir):
    out = stats.wilson_interval(campaign(spark, sf_dir), TARGET)
    rates = ["estimated_subscription_rate_percentage", "ci_lower_percentage", "ci_upper_percentage"]
    return out.withColumns({c: F.round(c, 8) for c in rates})


_PAIRS = " UNION ALL ".join(
    f"""SELECT '{name}' AS comparison, '{a}' AS group_a, '{b}' AS group_b,
        count(*) FILTER ({pa})::DOUBLE AS na, count(*) FILTER ({pb})::DOUBLE AS nb,
        sum(subscribed) FILTER ({pa})::DOUBLE AS ka, sum(subscribed) FILTER ({pb})::DOUBLE AS kb FROM short"""
    for name, a, pa, b, pb in (
        ("Previous success vs other outcomes", "Previous outcome: success", "poutcome = 'success'", "Other previous outcomes", "poutcome <> 'success'"),
        ("Urgent vs unknown contact", "Urgent contact", "contact = 'urgent'", "Unknown contact", "contact = 'unknown'"),
        ("One campaign contact vs multiple contacts", "One campaign contact", "campaign = 1", "Multiple campaign contacts", "campaign > 1"),
    )
)
_DIFF = f"""pairs AS ({_PAIRS}), diffs AS (
  SELECT *, ka / na AS ra, kb / nb AS rb, {_ZVALUE}::DOUBLE * sqrt(ka / na * (1 - ka / na) / na + kb / nb * (1 - kb / nb) / nb) AS half FROM pairs
)"""


@register(
    "proportion_differences",
    oracle(
        """SELECT comparison, group_a, group_b, CAST(na AS BIGINT) AS group_a_size, CAST(nb AS BIGINT) AS group_b_size,
            CAST(ka AS BIGINT) AS group_a_subscribers, CAST(kb AS BIGINT) AS group_b_subscribers,
            round(100 * ra, 8) AS group_a_rate_percentage, round(100 * rb, 8) AS group_b_rate_percentage,
            round(100 * (ra - rb), 8) AS difference_percentage_points,
            round(100 * (ra - rb - half), 8) AS ci_lower_percentage_points,
            round(100 * (ra - rb + half), 8) AS ci_upper_percentage_points, 0.95::DOUBLE AS confidence_level FROM diffs""",
        _DIFF,
    ),
)
def _proportion_differences(spark, sf_dir):
    out = stats.proportion_differences(short_campaign(spark, sf_dir), comparisons(), TARGET)
    rounded = [c for c, t in out.dtypes if t == "double" and c != "confidence_level"]
    return out.withColumns({c: F.round(c, 8) for c in rounded})


@register(
    "interval_half_widths",
    oracle(
        """SELECT comparison, round(100 * (ra - rb), 8) AS difference_percentage_points, round(100 * half, 8) AS lower_error,
            round(100 * half, 8) AS upper_error FROM diffs""",
        _DIFF,
    ),
)
def _interval_half_widths(spark, sf_dir):
    out = stats.half_widths(stats.proportion_differences(short_campaign(spark, sf_dir), comparisons(), TARGET))
    return out.withColumns({c: F.round(c, 8) for c, t in out.dtypes if t == "double"})


_RANKS = "ranks AS (SELECT campaign_record_id, " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in [*NUMBERS, TARGET]
) + " FROM short)"


@register(
    "spearman_matrix",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 8) AS correlation FROM ranks"
            for a in [*NUMBERS, TARGET] for b in [*NUMBERS, TARGET] if a != b
        )
        + " UNION ALL "
        + " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0::DOUBLE" for c in [*NUMBERS, TARGET]),
        _RANKS,
    ),
)
def _spearman_matrix(spark, sf_dir):
    out = stats.spearman_matrix(short_campaign(spark, sf_dir), [*NUMBERS, TARGET], KEY)
    return out.withColumn("correlation", F.round("correlation", 8))


@register("spearman_matrix_by_shuffle", ORACLES["spearman_matrix"])
def _spearman_matrix_by_shuffle(spark, sf_dir):
    """The same correlations with every rank looked up by a shuffle join, as for wide value ranges."""
    out = stats.spearman_matrix(short_campaign(spark, sf_dir), [*NUMBERS, TARGET], KEY, small=0)
    return out.withColumn("correlation", F.round("correlation", 8))


@register(
    "target_correlations",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(corr({c}, {TARGET}), 8) AS spearman_correlation_with_target,
                round(abs(corr({c}, {TARGET})), 8) AS absolute_correlation FROM ranks"""
            for c in NUMBERS
        ),
        _RANKS,
    ),
)
def _target_correlations(spark, sf_dir):
    out = stats.target_correlations(short_campaign(spark, sf_dir), NUMBERS, TARGET)
    return out.withColumns({c: F.round(c, 8) for c in ("spearman_correlation_with_target", "absolute_correlation")})
