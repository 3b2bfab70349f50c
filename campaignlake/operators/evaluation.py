"""Evaluation of scored tables (id, label, score), optionally per group of `by` columns.

Everything starts from one row per distinct score with its counts and their running sums, so ties
are exact, rows are counted before they are shuffled, and nothing sorts the raw rows in one place.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from campaignlake.functions.numbers import fail_rows, ratio
from campaignlake.operators.scan import ordered_scan
from campaignlake.operators.segments import argmax_row
from campaignlake.session import materialize

# The default threshold and the shares of clients to target.
DEFAULT_THRESHOLD = 0.5
TARGETING_FRACTIONS = [0.05, 0.10, 0.20, 0.30, 0.50, 1.00]


def score_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts per distinct score with running sums from the top, and the group totals.

    Columns: by…, score, n, positives, negatives; `at_n`, `at_positives`, `at_negatives` count the
    rows scored at or above; `below_negatives` those strictly below; `next_positives`,
    `next_negatives` belong to the next lower score; `total_n`, `total_positives`.
    """
    by = list(by)
    counts = (
        df.groupBy(*by, "score")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("positives"))
        .withColumn("negatives", F.col("n") - F.col("positives"))
    )
    sums = ["n", "positives", "negatives"]
    scanned = ordered_scan(counts, ["score"], by, sums=sums, lags=sums[1:], totals=True)
    return scanned.select(
        *by, "score", *sums,
        *[(F.col(f"total_{c}") - F.col(f"cum_{c}") + F.col(c)).alias(f"at_{c}") for c in sums],
        (F.col("cum_negatives") - F.col("negatives")).alias("below_negatives"),
        F.col("prev_positives").alias("next_positives"),
        F.col("prev_negatives").alias("next_negatives"),
        "total_n",
        "total_positives",
    )


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    """F-beta score, 0 where precision and recall are both 0."""
    b2 = F.lit(beta * beta)
    return F.coalesce(F.try_divide((1 + b2) * precision * recall, b2 * precision + recall), F.lit(0.0))


def threshold_curve(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1, F2 and share predicted positive for every distinct score."""
    precision = _d("at_positives") / _d("at_n")
    recall = F.try_divide(_d("at_positives"), _d("total_positives"))
    share = _d("at_n") / _d("total_n")
    return score_counts(df, by).select(
        *by,
        F.col("score").alias("threshold"),
        precision.alias("precision"),
        recall.alias("recall"),
        f_beta(precision, recall, 1.0).alias("f1"),
        f_beta(precision, recall, 2.0).alias("f2"),
        share.alias("predicted_positive_rate"),
        (share * 100).alias("predicted_positive_percentage"),
    )


def _area(by: Sequence[str]) -> list[Column]:
    """Aggregates over `score_counts` for the area under ROC and the average precision."""
    positives, negatives = _d("total_positives"), _d("total_n") - _d("total_positives")
    wins = _d("positives") * (_d("below_negatives") + _d("negatives") / 2)
    step = F.try_divide(_d("positives"), positives) * (_d("at_positives") / _d("at_n"))
    return [
        F.sum(F.try_divide(wins, positives * negatives)).alias("roc_auc"),
        F.sum(step).alias("average_precision"),
    ]


def roc_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve: the share of (positive, negative) pairs ranked right, ties half."""
    return score_counts(df, by).groupBy(*by).agg(_area(by)[0])


def average_precision(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of recall steps times precision over distinct scores (no trapezoids)."""
    return score_counts(df, by).groupBy(*by).agg(_area(by)[1])


def probability_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, positives, prevalence, AUC, average precision, Brier score and log loss.

    Probabilities are clipped to double epsilon for the log loss. All of it comes from the counts
    per distinct score.
    """
    epsilon = sys.float_info.epsilon
    p = F.greatest(F.lit(epsilon), F.least(F.lit(1.0 - epsilon), F.col("score")))
    loss = -(_d("positives") * F.ln(p) + _d("negatives") * F.ln(1 - p))
    error = _d("positives") * F.pow(F.col("score") - 1, F.lit(2)) + _d("negatives") * F.pow(F.col("score"), F.lit(2))
    grouped = score_counts(df, by).groupBy(*by, "total_n", "total_positives")
    return grouped.agg(*_area(by), F.sum(error).alias("_error"), F.sum(loss).alias("_loss")).select(
        *by,
        F.col("total_n").alias("test_records"),
        F.col("total_positives").alias("test_subscribers"),
        (_d("total_positives") / _d("total_n")).alias("positive_class_prevalence"),
        "roc_auc",
        "average_precision",
        (F.col("_error") / _d("total_n")).alias("brier_score"),
        (F.col("_loss") / _d("total_n")).alias("log_loss"),
    )


def threshold_metrics(df: DataFrame, thresholds: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and derived metrics at several named thresholds, in one aggregation.

    A row is predicted positive when `score >= threshold`. Ratios with an empty denominator are 0.
    """
    y = F.col("label").cast("long")
    aggregates = [F.count(F.lit(1)).alias("_n"), F.sum(y).alias("_p")]
    for i, value in enumerate(thresholds.values()):
        hit = F.col("score") >= F.lit(float(value))
        aggregates += [F.count_if(hit).alias(f"_c{i}"), F.coalesce(F.sum(F.when(hit, y)), F.lit(0)).alias(f"_t{i}")]
    cells = [
        F.struct(
            F.lit(name).alias("threshold_name"),
            F.lit(float(value)).alias("threshold"),
            F.col(f"_c{i}").alias("predicted_positive_count"),
            F.col(f"_t{i}").alias("true_positives"),
        )
        for i, (name, value) in enumerate(thresholds.items())
    ]
    rows = df.groupBy(*by).agg(*aggregates).select(*by, "_n", "_p", F.inline(F.array(*cells)))
    counted = (
        rows.withColumn("false_positives", F.col("predicted_positive_count") - F.col("true_positives"))
        .withColumn("false_negatives", F.col("_p") - F.col("true_positives"))
        .withColumn("true_negatives", F.col("_n") - F.col("_p") - F.col("false_positives"))
    )
    tn, fp, fn, tp = (_d(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives"))
    zero = lambda a, b: ratio(a, b, 0.0)
    precision, recall, specificity = zero(tp, tp + fp), zero(tp, tp + fn), zero(tn, tn + fp)
    prevalence = _d("_p") / _d("_n")
    return counted.select(
        *by,
        "threshold_name",
        "threshold",
        ((tp + tn) / _d("_n")).alias("accuracy"),
        ((recall + specificity) / 2).alias("balanced_accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        specificity.alias("specificity"),
        zero(tn, tn + fn).alias("negative_predictive_value"),
        zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        zero(5 * tp, 5 * tp + fp + 4 * fn).alias("f2"),
        zero(precision, prevalence).alias("lift_over_baseline"),
        "predicted_positive_count",
        (F.lit(100.0) * F.col("predicted_positive_count") / _d("_n")).alias("predicted_positive_percentage"),
        "true_negatives", "false_positives", "false_negatives", "true_positives",
    )


def confusion_matrices(df: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """The four confusion counts per threshold."""
    return threshold_metrics(df, thresholds).select(
        "threshold_name", "threshold", "true_negatives", "false_positives", "false_negatives", "true_positives"
    )


def classification_report(
    df: DataFrame, thresholds: Mapping[str, float], names: Sequence[str] = ("non_subscriber", "subscriber")
) -> DataFrame:
    """Per class, accuracy, macro and weighted rows of precision, recall, F1 and support.

    The accuracy row repeats its value in every column, support included.
    """
    m = threshold_metrics(df, thresholds)
    tn, fp, fn, tp = (_d(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives"))
    zero = lambda a, b: ratio(a, b, 0.0)
    n0, n1 = tn + fp, tp + fn
    class0 = [zero(tn, tn + fn), zero(tn, n0), zero(2 * tn, 2 * tn + fn + fp)]
    class1 = [zero(tp, tp + fp), zero(tp, n1), zero(2 * tp, 2 * tp + fp + fn)]
    accuracy = [F.col("accuracy")] * 4
    macro = [(a + b) / 2 for a, b in zip(class0, class1)] + [n0 + n1]
    weighted = [(a * n0 + b * n1) / (n0 + n1) for a, b in zip(class0, class1)] + [n0 + n1]
    rows = {
        names[0]: [*class0, n0], names[1]: [*class1, n1], "accuracy": accuracy, "macro avg": macro, "weighted avg": weighted,
    }
    cells = [
        F.struct(F.lit(label).alias("class_or_average"), *[v.alias(c) for v, c in zip(values, ("precision", "recall", "f1_score", "support"))])
        for label, values in rows.items()
    ]
    return m.select("threshold_name", "threshold", F.inline(F.array(*cells)))


def roc_points(df: DataFrame, drop_collinear: bool = True) -> DataFrame:
    """(false_positive_rate, true_positive_rate, threshold) points, starting at threshold +inf.

    A point between two steps with equal counts lies on a straight line and is dropped; the first
    and the last score always stay.
    """
    counts = score_counts(df)
    last = F.col("next_positives").isNull()
    first = F.col("at_n") == F.col("n")
    bends = (F.col("positives") != F.col("next_positives")) | (F.col("negatives") != F.col("next_negatives"))
    kept = counts.where(first | last | bends) if drop_collinear else counts
    total_negatives = _d("total_n") - _d("total_positives")
    fpr = F.try_divide(_d("at_negatives"), total_negatives).alias("false_positive_rate")
    tpr = F.try_divide(_d("at_positives"), _d("total_positives")).alias("true_positive_rate")
    # The top score also yields the starting point.
    start = F.struct(F.lit(0.0).alias("false_positive_rate"), F.lit(0.0).alias("true_positive_rate"), F.lit(math.inf).alias("threshold"))
    point = F.struct(fpr, tpr, F.col("score").alias("threshold"))
    points = F.when(first, F.array(start, point)).otherwise(F.array(point))
    return kept.select(F.inline(points))


def pr_points(df: DataFrame) -> DataFrame:
    """(precision, recall, threshold) for every distinct score, and the end point (1, 0, null)."""
    precision = (_d("at_positives") / _d("at_n")).alias("precision")
    recall = F.try_divide(_d("at_positives"), _d("total_positives")).alias("recall")
    point = F.struct(precision, recall, F.col("score").alias("threshold"))
    end = F.struct(F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold"))
    top = F.col("at_n") == F.col("n")
    return score_counts(df).select(F.inline(F.when(top, F.array(point, end)).otherwise(F.array(point))))


def lift_table(df: DataFrame, fractions: Sequence[float] = tuple(TARGETING_FRACTIONS)) -> DataFrame:
    """Positives captured when the top `ceil(n * fraction)` rows are targeted, per fraction.

    Equal scores are taken in id order. Counts per score settle every cut but the score it falls
    into; only the rows of those scores, one per fraction at most, are ranked by id.
    """
    counts = materialize(score_counts(df), "scores")
    targets = F.array(
        *[
            F.struct(F.lit(float(f)).alias("fraction"), F.ceil(F.col("total_n") * F.lit(float(f))).alias("targeted"))
            for f in fractions
        ]
    )
    start = F.col("at_n") - F.col("n")
    inside = F.filter(targets, lambda t: (t["targeted"] > start) & (t["targeted"] <= F.col("at_n")))
    cuts = counts.select("*", F.explode(inside).alias("_t")).select(
        F.col("_t.fraction").alias("fraction"),
        F.col("_t.targeted").alias("targeted"),
        F.col("score").alias("_score"),
        (F.col("_t.targeted") - start).alias("_need"),
        (F.col("at_positives") - F.col("positives")).alias("_sure"),
        "total_n",
        "total_positives",
    )
    cut_scores = cuts.select(F.col("_score").alias("score")).distinct()
    tied = df.join(F.broadcast(cut_scores), "score").select(
        "score", "id", F.col("label").cast("long").alias("_y"), F.lit(1).cast("long").alias("_one")
    )
    ranked = ordered_scan(tied, ["id"], ["score"], sums=["_one", "_y"])
    taken = ranked.select(
        F.col("score").alias("_score"), F.col("cum__one").alias("_need"), F.col("cum__y").alias("_extra")
    )
    rows = taken.join(F.broadcast(cuts), ["_score", "_need"])
    captured = F.col("_sure") + F.col("_extra")
    k, n, p = _d("targeted"), _d("total_n"), _d("total_positives")
    base, precision = p / n, captured / k
    capture = F.try_divide(captured.cast("double"), p)
    return rows.select(
        F.col("fraction").alias("targeting_fraction"),
        (F.col("fraction") * 100).alias("targeting_percentage"),
        F.col("targeted").alias("targeted_clients"),
        captured.alias("subscribers_captured"),
        capture.alias("subscriber_capture_rate"),
        (capture * 100).alias("subscriber_capture_percentage"),
        precision.alias("targeting_precision"),
        (precision * 100).alias("targeting_precision_percentage"),
        base.alias("baseline_subscription_rate"),
        F.try_divide(precision, base).alias("lift_over_random_targeting"),
        (k * base).alias("expected_subscribers_under_random_targeting"),
        (captured - k * base).alias("additional_subscribers_vs_random_expectation"),
    ).orderBy("targeting_fraction")


def operational_scenarios(lift: DataFrame, percentages: Sequence[float] = (5.0, 10.0, 20.0, 30.0)) -> DataFrame:
    """The rows and columns of the lift table a campaign planner looks at."""
    kept = F.round("targeting_percentage", 6).isin([float(p) for p in percentages])
    return lift.where(kept).select(
        "targeting_percentage", "targeted_clients", "subscribers_captured", "subscriber_capture_percentage",
        "targeting_precision_percentage", "lift_over_random_targeting",
        "additional_subscribers_vs_random_expectation",
    )


def select_threshold(curve: DataFrame, default_f1: float | None = None) -> DataFrame:
    """Row of the curve with the largest F1; ties by recall, precision, then threshold.

    With `default_f1`, a selection that does worse than the default threshold fails the job.
    """
    best = argmax_row(curve, ["f1", "recall", "precision", "threshold"])
    if default_f1 is None:
        return best
    worse = F.col("f1") < F.lit(float(default_f1))
    return fail_rows(best, worse, "The selected threshold underperformed the default one in F1.")


def label_at(df: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Row-level 0/1 predictions, one column `<name>_prediction` per threshold."""
    return df.withColumns(
        {f"{name}_prediction": (F.col("score") >= F.lit(float(t))).cast("int") for name, t in thresholds.items()}
    )


def compare_stages(stages: Mapping[str, DataFrame], metrics: Sequence[str], labels: Mapping[str, str]) -> DataFrame:
    """(evaluation_stage, metric, score) rows from one-row results of several stages."""
    out = None
    for stage, frame in stages.items():
        cells = [
            F.struct(F.lit(labels.get(m, m)).alias("metric"), F.col(m).alias("score")) for m in metrics
        ]
        part = frame.select(F.lit(stage).alias("evaluation_stage"), F.inline(F.array(*cells)))
        out = part if out is None else out.unionByName(part)
    return out
