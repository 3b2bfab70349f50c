"""Registered queries: evaluation of a scored table."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlake.operators import evaluation as e
from campaignlake.plans.registry import oracle, register
from campaignlake.session import materialize
from campaignlake.sources.campaign import KEY, TARGET, campaign, scored_campaign

THRESHOLDS = {"selected_training_oof_f1": 0.25, "default_0_50": 0.5}

# Counts per distinct score, from the top: at or above (tp, n) and strictly below (negatives).
_COUNTS = """counts AS (
  SELECT score, n, k, sum(n) OVER up AS at_n, sum(k) OVER up AS at_k, sum(n) OVER () AS total, sum(k) OVER () AS pos,
         lead(n) OVER up AS next_n, lead(k) OVER up AS next_k, row_number() OVER up AS place, count(*) OVER () AS places
  FROM (SELECT score, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS k FROM scored GROUP BY score)
  WINDOW up AS (ORDER BY score DESC)
), curve AS (
  SELECT score AS threshold, at_k / at_n AS precision, at_k / pos AS recall, 2 * at_k / (at_n + pos) AS f1,
         5 * at_k / (at_n + 4 * pos) AS f2, at_n / total AS share FROM counts
)"""
_CURVE = """round(threshold, 8) AS threshold, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1,
            round(f2, 8) AS f2, round(share, 8) AS predicted_positive_rate, round(100 * share, 8) AS predicted_positive_percentage"""
_AUC = """sum(k * ((total - pos) - (at_n - at_k) + (n - k) / 2)) / any_value(pos * (total - pos))"""
_AP = "sum(k / pos * (at_k / at_n))"


def _rounded(df, digits: int = 8):
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


@register("threshold_curve", oracle(f"SELECT {_CURVE} FROM curve", _COUNTS))
def _threshold_curve(spark, sf_dir):
    return _rounded(e.threshold_curve(scored_campaign(spark, sf_dir)))


@register("roc_auc", oracle(f"SELECT round({_AUC}, 8) AS roc_auc FROM counts", _COUNTS))
def _roc_auc(spark, sf_dir):
    return _rounded(e.roc_auc(scored_campaign(spark, sf_dir)))


@register("average_precision", oracle(f"SELECT round({_AP}, 8) AS average_precision FROM counts", _COUNTS))
def _average_precision(spark, sf_dir):
    return _rounded(e.average_precision(scored_campaign(spark, sf_dir)))


_LOSS = """(SELECT -avg(label * ln(p) + (1 - label) * ln(1 - p))
            FROM (SELECT label, greatest(2.220446049250313e-16, least(1 - 2.220446049250313e-16, score)) AS p FROM scored))"""


@register(
    "probability_metrics",
    oracle(
        f"""SELECT CAST(any_value(total) AS BIGINT) AS test_records, CAST(any_value(pos) AS BIGINT) AS test_subscribers,
            round(any_value(pos / total), 8) AS positive_class_prevalence, round({_AUC}, 8) AS roc_auc,
            round({_AP}, 8) AS average_precision, round((SELECT avg((score - label) ^ 2) FROM scored), 8) AS brier_score,
            round({_LOSS}, 6) AS log_loss FROM counts""",
        _COUNTS,
    ),
)
def _probability_metrics(spark, sf_dir):
    out = e.probability_metrics(scored_campaign(spark, sf_dir))
    return _rounded(out).withColumn("log_loss", F.round("log_loss", 6))


_BY_JOB = """by_job AS (
  SELECT job, score, n, k, sum(n) OVER (PARTITION BY job ORDER BY score DESC) AS at_n, sum(k) OVER (PARTITION BY job ORDER BY score DESC) AS at_k,
         sum(n) OVER (PARTITION BY job) AS total, sum(k) OVER (PARTITION BY job) AS pos
  FROM (SELECT job, ((campaign_record_id * 7919) % 1000) / 1000::DOUBLE AS score, count(*)::DOUBLE AS n, sum(subscribed)::DOUBLE AS k
        FROM campaign GROUP BY 1, 2)
)"""


@register(
    "probability_metrics_by_group",
    oracle(f"SELECT job, round({_AUC}, 8) AS roc_auc, round({_AP}, 8) AS average_precision FROM by_job GROUP BY job", _BY_JOB),
)
def _probability_metrics_by_group(spark, sf_dir):
    rows = campaign(spark, sf_dir).select(
        "job", F.col(KEY).alias("id"), F.col(TARGET).alias("label"), (((F.col(KEY) * 7919) % 1000) / F.lit(1000.0)).alias("score")
    )
    return _rounded(e.probability_metrics(rows, ["job"]).select("job", "roc_auc", "average_precision"))


_CONFUSION = "confusion AS (" + " UNION ALL ".join(
    f"""SELECT '{name}' AS threshold_name, {t}::DOUBLE AS threshold, count(*) FILTER (score < {t} AND label = 0)::DOUBLE AS tn,
        count(*) FILTER (score >= {t} AND label = 0)::DOUBLE AS fp, count(*) FILTER (score < {t} AND label = 1)::DOUBLE AS fn,
        count(*) FILTER (score >= {t} AND label = 1)::DOUBLE AS tp, count(*)::DOUBLE AS n FROM scored"""
    for name, t in THRESHOLDS.items()
) + ")"
_FOUR = """CAST(tn AS BIGINT) AS true_negatives, CAST(fp AS BIGINT) AS false_positives, CAST(fn AS BIGINT) AS false_negatives,
           CAST(tp AS BIGINT) AS true_positives"""


@register(
    "threshold_metrics",
    oracle(
        f"""SELECT threshold_name, threshold, round((tp + tn) / n, 8) AS accuracy,
            round((tp / (tp + fn) + tn / (tn + fp)) / 2, 8) AS balanced_accuracy, round(tp / (tp + fp), 8) AS precision,
            round(tp / (tp + fn), 8) AS recall, round(tn / (tn + fp), 8) AS specificity,
            round(tn / (tn + fn), 8) AS negative_predictive_value, round(2 * tp / (2 * tp + fp + fn), 8) AS f1,
            round(5 * tp / (5 * tp + fp + 4 * fn), 8) AS f2, round(tp / (tp + fp) / ((tp + fn) / n), 8) AS lift_over_baseline,
            CAST(tp + fp AS BIGINT) AS predicted_positive_count, round(100 * (tp + fp) / n, 8) AS predicted_positive_percentage, {_FOUR}
        FROM confusion""",
        _CONFUSION,
    ),
)
def _threshold_metrics(spark, sf_dir):
    return _rounded(e.threshold_metrics(scored_campaign(spark, sf_dir), THRESHOLDS))


@register("confusion_matrices", oracle(f"SELECT threshold_name, threshold, {_FOUR} FROM confusion", _CONFUSION))
def _confusion_matrices(spark, sf_dir):
    return e.confusion_matrices(scored_campaign(spark, sf_dir), THRESHOLDS)


_C0 = ("tn / (tn + fn)", "tn / (tn + fp)", "2 * tn / (2 * tn + fn + fp)")
_C1 = ("tp / (tp + fp)", "tp / (tp + fn)", "2 * tp / (2 * tp + fp + fn)")
_ACC = "(tp + tn) / n"


def _report_row(name: str, values) -> str:
    cells = ", ".join(f"round({v}, 8) AS {c}" for v, c in zip(values, ("precision", "recall", "f1_score", "support")))
    return f"SELECT threshold_name, threshold, '{name}' AS class_or_average, {cells} FROM confusion"


@register(
    "classification_report",
    oracle(
        " UNION ALL ".join([
            _report_row("non_subscriber", [*_C0, "tn + fp"]),
            _report_row("subscriber", [*_C1, "tp + fn"]),
            _report_row("accuracy", [_ACC] * 4),
            _report_row("macro avg", [*[f"({a} + {b}) / 2" for a, b in zip(_C0, _C1)], "n"]),
            _report_row("weighted avg", [*[f"({a} * (tn + fp) + {b} * (tp + fn)) / n" for a, b in zip(_C0, _C1)], "n"]),
        ]),
        _CONFUSION,
    ),
)
def _classification_report(spark, sf_dir):
    return _rounded(e.classification_report(scored_campaign(spark, sf_dir), THRESHOLDS))


def _roc(where: str) -> str:
    return f"""SELECT 0.0::DOUBLE AS false_positive_rate, 0.0::DOUBLE AS true_positive_rate, 'inf' AS threshold
        UNION ALL SELECT round((at_n - at_k) / (total - pos), 8), round(at_k / pos, 8), CAST(round(score, 3) AS VARCHAR)
        FROM counts {where}"""


def _roc_query(spark, sf_dir, drop):
    out = _rounded(e.roc_points(scored_campaign(spark, sf_dir), drop))
    text = F.when(F.col("threshold") == F.lit(float("inf")), F.lit("inf")).otherwise(F.round("threshold", 3).cast("string"))
    return out.withColumn("threshold", text)


@register(
    "roc_points",
    oracle(_roc("WHERE place = 1 OR place = places OR next_k <> k OR next_n - next_k <> n - k"), _COUNTS),
)
def _roc_points(spark, sf_dir):
    return _roc_query(spark, sf_dir, True)


@register("roc_points_all", oracle(_roc(""), _COUNTS))
def _roc_points_all(spark, sf_dir):
    return _roc_query(spark, sf_dir, False)


@register(
    "precision_recall_points",
    oracle(
        """SELECT round(at_k / at_n, 8) AS precision, round(at_k / pos, 8) AS recall, round(score, 8) AS threshold FROM counts
        UNION ALL SELECT 1.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE""",
        _COUNTS,
    ),
)
def _precision_recall_points(spark, sf_dir):
    return _rounded(e.pr_points(scored_campaign(spark, sf_dir)))


_LIFT = """lift AS (
  SELECT f, ceil(total * f) AS k, captured::DOUBLE AS captured, total::DOUBLE AS total, pos::DOUBLE AS pos
  FROM (SELECT f, any_value(total) AS total, any_value(pos) AS pos, sum(label) FILTER (place <= ceil(total * f)) AS captured
        FROM (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS place, count(*) OVER () AS total, sum(label) OVER () AS pos
              FROM scored), (SELECT unnest([0.05, 0.1, 0.2, 0.3, 0.5, 1.0])::DOUBLE AS f) GROUP BY f)
)"""
_LIFT_COLUMNS = {
    "targeting_percentage": "f * 100", "targeted_clients": None, "subscriber_capture_percentage": "captured / pos * 100",
    "targeting_precision_percentage": "captured / k * 100", "lift_over_random_targeting": "captured / k / (pos / total)",
    "additional_subscribers_vs_random_expectation": "captured - k * pos / total",
}
_CAPTURED = "CAST(k AS BIGINT) AS targeted_clients, CAST(captured AS BIGINT) AS subscribers_captured"
_SCENARIO = ", ".join(f"round({v}, 8) AS {c}" for c, v in _LIFT_COLUMNS.items() if v)


@register(
    "targeting_lift",
    oracle(
        f"""SELECT f AS targeting_fraction, {_CAPTURED}, {_SCENARIO}, round(captured / pos, 8) AS subscriber_capture_rate,
            round(captured / k, 8) AS targeting_precision, round(pos / total, 8) AS baseline_subscription_rate,
            round(k * pos / total, 8) AS expected_subscribers_under_random_targeting FROM lift""",
        _LIFT,
    ),
)
def _targeting_lift(spark, sf_dir):
    return _rounded(e.lift_table(scored_campaign(spark, sf_dir)))


@register(
    "targeting_scenarios", oracle(f"SELECT {_CAPTURED}, {_SCENARIO} FROM lift WHERE f IN (0.05, 0.1, 0.2, 0.3)", _LIFT)
)
def _targeting_scenarios(spark, sf_dir):
    return _rounded(e.operational_scenarios(e.lift_table(scored_campaign(spark, sf_dir))))


@register(
    "selected_threshold",
    oracle(f"SELECT {_CURVE} FROM curve ORDER BY curve.f1 DESC, curve.recall DESC, curve.precision DESC, curve.threshold DESC LIMIT 1", _COUNTS),
)
def _selected_threshold(spark, sf_dir):
    """The chosen threshold, checked against the F1 of the default one."""
    rows = scored_campaign(spark, sf_dir)
    default = e.threshold_metrics(rows, {"default": e.DEFAULT_THRESHOLD}).first()["f1"]
    return _rounded(e.select_threshold(materialize(e.threshold_curve(rows), "curve"), default))


@register(
    "labelled_rows",
    oracle(
        """SELECT id, label, score, CAST(score >= 0.25 AS INTEGER) AS selected_threshold_prediction,
            CAST(score >= 0.5 AS INTEGER) AS default_threshold_prediction FROM scored"""
    ),
)
def _labelled_rows(spark, sf_dir):
    return e.label_at(scored_campaign(spark, sf_dir), {"selected_threshold": 0.25, "default_threshold": 0.5})


@register(
    "compare_stages",
    oracle(
        f"""SELECT 'All clients' AS evaluation_stage, 'ROC-AUC' AS metric, round({_AUC}, 8) AS score FROM counts
        UNION ALL SELECT 'All clients', 'Average Precision', round({_AP}, 8) FROM counts
        UNION ALL SELECT 'Household clients', 'ROC-AUC', round({_AUC}, 8) FROM by_job WHERE job = 'household'
        UNION ALL SELECT 'Household clients', 'Average Precision', round({_AP}, 8) FROM by_job WHERE job = 'household'""",
        _COUNTS, _BY_JOB,
    ),
)
def _compare_stages(spark, sf_dir):
    rows = scored_campaign(spark, sf_dir)
    household = campaign(spark, sf_dir).where(F.col("job") == "household").select(F.col(KEY).alias("id"))
    stages = {
        "All clients": e.probability_metrics(rows),
        "Household clients": e.probability_metrics(rows.join(household, "id", "left_semi")),
    }
    labels = {"roc_auc": "ROC-AUC", "average_precision": "Average Precision"}
    return _rounded(e.compare_stages(stages, list(labels), labels))
