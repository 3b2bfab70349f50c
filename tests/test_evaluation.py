import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from campaignlake.operators import evaluation as e


def _scored(spark, pairs):
    return spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(pairs)], "id long, label int, score double")


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(2)
    # A third of the rows share one score.
    return [(int(rng.random() < 0.3), 0.5 if rng.random() < 0.33 else round(rng.random(), 2)) for _ in range(600)]


def _auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def _ap(pairs):
    total, last, out = sum(y for y, _ in pairs), 0.0, 0.0
    for t in sorted({s for _, s in pairs}, reverse=True):
        chosen = [y for y, s in pairs if s >= t]
        recall = sum(chosen) / total
        out, last = out + (recall - last) * sum(chosen) / len(chosen), recall
    return out


def test_areas_match_pair_counting(spark, pairs):
    row = e.probability_metrics(_scored(spark, pairs)).first()
    assert row["roc_auc"] == pytest.approx(_auc(pairs), rel=1e-12)
    assert row["average_precision"] == pytest.approx(_ap(pairs), rel=1e-12)
    assert row["brier_score"] == pytest.approx(sum((s - y) ** 2 for y, s in pairs) / len(pairs))


def test_areas_per_group(spark, pairs):
    groups = {g: [p for i, p in enumerate(pairs) if i % 3 == g] for g in range(3)}
    df = _scored(spark, pairs).withColumn("g", (F.col("id") % 3).cast("int"))
    found = {r["g"]: r for r in e.probability_metrics(df, ["g"]).collect()}
    for g, part in groups.items():
        assert found[g]["roc_auc"] == pytest.approx(_auc(part), rel=1e-12)
        assert found[g]["average_precision"] == pytest.approx(_ap(part), rel=1e-12)


@pytest.mark.parametrize("rows, auc", [([(1, 0.5), (0, 0.5), (0, 0.5)], 0.5), ([(1, 0.9), (0, 0.1)], 1.0), ([(1, 0.1), (0, 0.9)], 0.0)])
def test_area_edge_cases(spark, rows, auc):
    assert e.roc_auc(_scored(spark, rows)).first()[0] == auc


def test_log_loss_clips_certain_scores(spark):
    row = e.probability_metrics(_scored(spark, [(1, 1.0), (0, 0.0), (1, 0.0)])).first()
    eps = 2.220446049250313e-16
    assert row["log_loss"] == pytest.approx((-math.log(eps) - 2 * math.log(1 - eps)) / 3)


def _from_confusion(spark, tn, fp, fn, tp):
    cells = [(0, 0.1, tn), (0, 0.9, fp), (1, 0.1, fn), (1, 0.9, tp)]
    out = None
    for label, score, n in cells:
        part = spark.range(n).select("id", F.lit(label).alias("label"), F.lit(score).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def test_threshold_metrics_published_values(spark):
    row = e.threshold_metrics(_from_confusion(spark, 7350, 635, 634, 424), {"t": 0.5}).first()
    expected = {
        "accuracy": 0.8596704633418113, "balanced_accuracy": 0.6606160179826778, "precision": 0.4003777148253069,
        "recall": 0.4007561436672968, "specificity": 0.9204758922980588, "negative_predictive_value": 0.9205911823647295,
        "f1": 0.4005668398677374, "f2": 0.4006804006804007, "lift_over_baseline": 3.422132018114603,
        "predicted_positive_count": 1059, "predicted_positive_percentage": 11.71071547052969,
    }
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, rel=1e-12), name


def test_classification_report_published_values(spark):
    rows = {r["class_or_average"]: r for r in e.classification_report(_from_confusion(spark, 6613, 1372, 494, 564), {"t": 0.5}).collect()}
    assert rows["non_subscriber"]["precision"] == pytest.approx(0.9304910651470382, rel=1e-12)
    assert rows["subscriber"]["f1_score"] == pytest.approx(0.37675350701402804, rel=1e-12)
    assert rows["macro avg"]["recall"] == pytest.approx(0.680629559440965, rel=1e-12)
    assert rows["weighted avg"]["f1_score"] == pytest.approx(0.8179062832825151, rel=1e-12)
    assert rows["accuracy"]["support"] == pytest.approx(0.7936525489328763, rel=1e-12)
    assert rows["weighted avg"]["support"] == 9043.0


def test_nothing_predicted_positive_gives_zeros(spark):
    row = e.threshold_metrics(_scored(spark, [(1, 0.1), (0, 0.2)]), {"t": 0.9}).first()
    assert (row["precision"], row["recall"], row["f1"], row["lift_over_baseline"]) == (0.0, 0.0, 0.0, 0.0)


def test_lift_table_against_a_sort(spark, pairs):
    df = _scored(spark, pairs)
    order = sorted(range(len(pairs)), key=lambda i: (-pairs[i][1], i))
    for row in e.lift_table(df).collect():
        k = math.ceil(len(pairs) * row["targeting_fraction"])
        assert row["targeted_clients"] == k
        assert row["subscribers_captured"] == sum(pairs[i][0] for i in order[:k])
    last = e.lift_table(df).where("targeting_fraction = 1.0").first()
    assert last["lift_over_random_targeting"] == pytest.approx(1.0)


def test_lift_when_all_scores_are_equal(spark):
    rows = [(int(i < 10), 0.5) for i in range(100)]
    found = {r["targeting_fraction"]: r["subscribers_captured"] for r in e.lift_table(_scored(spark, rows)).collect()}
    assert found == {0.05: 5, 0.1: 10, 0.2: 10, 0.3: 10, 0.5: 10, 1.0: 10}


def test_lift_published_rates(spark):
    # 9,043 rows, 1,058 positives, 256 of them among the top 453.
    i = F.col("id")
    df = spark.range(9043).select(
        "id", ((i < 256) | ((i >= 453) & (i < 453 + 802))).cast("int").alias("label"), ((F.lit(9043) - i) / 10000.0).alias("score")
    )
    row = e.lift_table(df, [0.05]).first()
    assert (row["targeted_clients"], row["subscribers_captured"]) == (453, 256)
    assert row["lift_over_random_targeting"] == pytest.approx(4.830239069926598, rel=1e-12)
    assert row["additional_subscribers_vs_random_expectation"] == pytest.approx(203.000552913856, rel=1e-9)


def test_roc_points_keep_corners_only(spark):
    # Three steps up with equal counts, then two steps to the right.
    rows = [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5)]
    points = sorted((r["threshold"], r["false_positive_rate"], r["true_positive_rate"]) for r in e.roc_points(_scored(spark, rows)).collect())
    assert points[::-1] == [(math.inf, 0.0, 0.0), (0.9, 0.0, pytest.approx(1 / 3)), (0.7, 0.0, 1.0), (0.5, 1.0, 1.0)]
    assert e.roc_points(_scored(spark, rows), drop_collinear=False).count() == 6


def test_precision_recall_end_point(spark):
    rows = e.pr_points(_scored(spark, [(1, 0.9), (0, 0.5)])).collect()
    assert {(r["precision"], r["recall"], r["threshold"]) for r in rows} == {(1.0, 1.0, 0.9), (0.5, 1.0, 0.5), (1.0, 0.0, None)}


def test_threshold_selection_ties_and_guard(spark, pairs):
    curve = e.threshold_curve(_scored(spark, pairs))
    best = e.select_threshold(curve).first()
    assert best["f1"] == max(r["f1"] for r in curve.collect())
    with pytest.raises(PySparkException, match="underperformed"):
        e.select_threshold(curve, 1.1).collect()
