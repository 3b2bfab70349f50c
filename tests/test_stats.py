import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from campaignlake.functions.survival import normal_two_sided
from campaignlake.operators import segments, stats


def test_benjamini_hochberg_known_answer(spark):
    df = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03)], "test string, p double")
    found = {r["test"]: r["adjusted_p_value_bh"] for r in stats.benjamini_hochberg(df, "p").collect()}
    assert found == pytest.approx({"a": 0.03, "b": 0.04, "c": 0.04})


@pytest.mark.parametrize("bad", [-0.2, 1.2, float("nan"), None])
def test_benjamini_hochberg_rejects_bad_values(spark, bad):
    df = spark.createDataFrame([(0.1,), (bad,)], "p double")
    with pytest.raises(PySparkException, match="between 0 and 1"):
        stats.benjamini_hochberg(df, "p").collect()


def test_benjamini_hochberg_per_family(spark):
    df = spark.createDataFrame([("x", 0.04), ("x", 0.05), ("y", 0.04)], "family string, p double")
    found = sorted((r["family"], round(r["adjusted_p_value_bh"], 9)) for r in stats.benjamini_hochberg(df, "p", ["family"]).collect())
    assert found == [("x", 0.05), ("x", 0.05), ("y", 0.04)]


def test_effect_labels(spark):
    df = spark.createDataFrame([(0.01,), (0.15,), (-0.35,), (0.75,)], "e double")
    assert [r[0] for r in df.select(stats.effect_label(F.col("e"))).collect()] == ["Negligible", "Small", "Moderate", "Large"]


def _two_class(spark, negatives, positives):
    return spark.range(negatives + positives).select((F.col("id") < positives).cast("int").alias("y"))


def test_wilson_interval_published_values(spark):
    row = stats.wilson_interval(_two_class(spark, 39922, 5289), "y").first()
    assert row["estimated_subscription_rate_percentage"] == pytest.approx(11.698480458295547, rel=1e-12)
    assert row["ci_lower_percentage"] == pytest.approx(11.405468024851945, rel=1e-12)
    assert row["ci_upper_percentage"] == pytest.approx(11.998001095919115, rel=1e-12)


def test_wilson_rejects_impossible_counts(spark):
    df = spark.createDataFrame([(5, 4)], "k int, n int")
    with pytest.raises(PySparkException, match="between zero and total"):
        df.select(*stats.wilson_columns(F.col("k"), F.col("n"))).collect()
    with pytest.raises(PySparkException, match="must be positive"):
        stats.wilson_interval(_two_class(spark, 0, 0), "y").collect()


def test_proportion_difference_published_values(spark):
    # 1,511 rows with 978 positives against 43,700 rows with 4,311 positives.
    i = F.col("id")
    df = spark.range(45211).select(
        (i < 1511).alias("a"), ((i < 978) | ((i >= 1511) & (i < 1511 + 4311))).cast("int").alias("y")
    )
    row = stats.proportion_differences(df, [stats.Comparison("c", "a", F.col("a"), "b", ~F.col("a"))], "y").first()
    assert row["group_a_rate_percentage"] == pytest.approx(64.72534745201854, rel=1e-12)
    assert row["difference_percentage_points"] == pytest.approx(54.86035889366613, rel=1e-12)
    assert row["ci_lower_percentage_points"] == pytest.approx(52.4349274653475, rel=1e-12)
    assert row["ci_upper_percentage_points"] == pytest.approx(57.285790321984756, rel=1e-12)


def test_proportion_difference_rejects_overlap_and_empty_groups(spark):
    df = _two_class(spark, 3, 3)
    everyone, nobody = F.lit(True), F.lit(False)
    for a, b, message in ((everyone, everyone, "overlap"), (everyone, nobody, "empty")):
        with pytest.raises(PySparkException, match=message):
            stats.proportion_differences(df, [stats.Comparison("c", "a", a, "b", b)], "y").collect()


def test_chi_square_with_null_category_and_empty_cell(spark):
    rows = [("a", 1)] * 8 + [("a", 0)] * 12 + [("b", 0)] * 10 + [(None, 1)] * 4 + [(None, 0)] * 6
    df = spark.createDataFrame(rows, "f string, y int")
    row = stats.chi_square_tests(df, ["f"], "y").first()
    observed = np.array([[12, 8], [10, 0], [6, 4]], dtype=float)
    expected = observed.sum(1, keepdims=True) * observed.sum(0, keepdims=True) / observed.sum()
    statistic = ((observed - expected) ** 2 / expected).sum()
    assert row["chi_square_statistic"] == pytest.approx(statistic, rel=1e-12)
    assert (row["number_of_categories"], row["degrees_of_freedom"], row["sample_size"]) == (3, 2, 40)
    assert row["cramers_v"] == pytest.approx(math.sqrt(statistic / 40), rel=1e-12)
    assert row["p_value"] == pytest.approx(math.exp(-statistic / 2), rel=1e-12)
    assert row["minimum_expected_frequency"] == pytest.approx(expected.min())
    assert row["expected_cells_below_five"] == int((expected < 5).sum())


def test_cramers_v_needs_two_categories(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1)], "f string, y int")
    with pytest.raises(PySparkException, match="at least two categories"):
        stats.chi_square_tests(df, ["f"], "y", p_values=False).collect()


def _pairs_u(positives, negatives):
    return sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)


def test_mann_whitney_against_pair_counting(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, 1, 2, 3, 9]), rng.random() < 0.4, rng.randrange(20) - 1) for _ in range(400)]
    df = spark.createDataFrame([(a, int(y), b) for a, y, b in rows], "a int, y int, b int")
    specs = [stats.GroupTest("a", "a"), stats.GroupTest("b_real", "b", "real", F.col("b") >= 0)]
    found = {r["analysis_name"]: r for r in stats.mann_whitney_tests(df, specs, "y").collect()}
    for name, pick in (("a", lambda r: r[0]), ("b_real", lambda r: r[2] if r[2] >= 0 else None)):
        pos = [pick(r) for r in rows if r[1] and pick(r) is not None]
        neg = [pick(r) for r in rows if not r[1] and pick(r) is not None]
        u, n1, n0 = _pairs_u(pos, neg), len(pos), len(neg)
        n = n1 + n0
        ties = sum(c**3 - c for c in pd.Series(pos + neg).value_counts())
        s = math.sqrt(n1 * n0 / 12 * ((n + 1) - ties / (n * (n - 1))))
        z = (max(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5) / s
        row = found[name]
        assert row["mann_whitney_u"] == u
        assert row["rank_biserial_correlation"] == pytest.approx(2 * u / (n1 * n0) - 1)
        assert row["p_value"] == pytest.approx(normal_two_sided(z), rel=1e-10)
        assert row["subscriber_median"] == np.median(pos) and row["non_subscriber_median"] == np.median(neg)


def test_mann_whitney_rejects_empty_group(spark):
    df = spark.createDataFrame([(1, 1), (2, 1)], "a int, y int")
    with pytest.raises(PySparkException, match="empty group"):
        stats.mann_whitney_tests(df, [stats.GroupTest("a", "a")], "y").collect()


@pytest.mark.parametrize("small", [1_000_000, 60, 0])
def test_spearman_matches_pandas_on_every_path(spark, small):
    rng = random.Random(8)
    # One value of `a` holds most rows: the path that splits frequent values from the rest.
    rows = [(i, -1 if rng.random() < 0.7 else rng.randrange(300), rng.random(), rng.randrange(6)) for i in range(1500)]
    pdf = pd.DataFrame(rows, columns=["id", "a", "b", "c"])
    df = spark.createDataFrame(rows, "id long, a long, b double, c long")
    want = pdf[["a", "b", "c"]].rank().corr()
    got = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in stats.spearman_matrix(df, ["a", "b", "c"], "id", small).collect()}
    assert len(got) == 9
    for x in "abc":
        for y in "abc":
            assert got[(x, y)] == pytest.approx(want.loc[x, y], abs=1e-10)


def test_spearman_of_many_columns(spark):
    """200 columns with ties, some of them alike, opposite or constant, against the plain library."""
    rng = np.random.default_rng(3)
    rows, names = 300, [f"c{k}" for k in range(200)]
    base = rng.integers(0, 40, size=(rows, 5))
    values = {c: base[:, k % 5] * (1 - 2 * (k % 2)) + rng.integers(0, 1 + 3 * (k % 7), size=rows) for k, c in enumerate(names)}
    values["c7"] = np.full(rows, 4)
    frame = pd.DataFrame(values)
    df = spark.createDataFrame(frame.assign(id=range(rows))).repartition(3)
    found = {(r.feature_a, r.feature_b): r.correlation for r in stats.spearman_matrix(df, names, "id").collect()}
    expected = frame.rank().corr()
    assert len(found) == 200 * 200
    for a in names:
        for b in names:
            if a == b:
                assert found[a, b] == 1.0
            elif "c7" in (a, b):
                assert found[a, b] is None
            else:
                assert found[a, b] == pytest.approx(expected.at[a, b], abs=1e-12)


def test_spearman_rejects_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 3.0), (3, 4.0, 1.0)], "id int, a double, b double")
    with pytest.raises(PySparkException, match="hold nulls"):
        stats.spearman_matrix(df, ["a", "b"], "id").collect()


def test_profiles_match_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"v": np.round(rng.exponential(1e4, 500), 1), "y": rng.integers(0, 2, 500)})
    df = spark.createDataFrame(pdf)
    row = segments.numeric_profile(df, ["v"]).first()
    for name, value in (("mean", pdf.v.mean()), ("std", pdf.v.std()), ("median", pdf.v.median()), ("q1", pdf.v.quantile(0.25)),
                        ("skewness", pdf.v.skew()), ("max", pdf.v.max())):
        assert row[name] == pytest.approx(value, rel=1e-10), name
    bands = segments.quantile_bands(df, "v", "y", 10).orderBy("band").collect()
    cut = pd.qcut(pdf.v, 10, duplicates="drop")
    assert [r["client_count"] for r in bands] == pdf.groupby(cut, observed=True).size().tolist()
    assert [r["subscriber_count"] for r in bands] == pdf.groupby(cut, observed=True).y.sum().tolist()
    counts, edges = np.histogram(pdf.v, bins=30)
    found = {r["bin"]: r["count"] for r in segments.histogram(df, ["v"]).collect()}
    assert [found.get(i, 0) for i in range(30)] == counts.tolist()


def test_quantile_bands_of_a_constant_column(spark):
    df = spark.createDataFrame([(7, 0), (7, 1)], "v int, y int")
    rows = segments.quantile_bands(df, "v", "y").collect()
    assert [(r["band"], r["client_count"], r["lower_edge"], r["upper_edge"]) for r in rows] == [(1, 2, 7.0, 7.0)]


def test_best_segment_needs_an_eligible_one(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("f"), F.lit("x").alias("g"), (F.col("id") % 2).cast("int").alias("y"))
    assert segments.best_scalable_segment(df, ["g"], "y").first()["client_count"] == 300
    with pytest.raises(PySparkException, match="No eligible segments found for f"):
        segments.best_scalable_segment(df, ["f", "g"], "y", 0.01).collect()


def test_category_mode_ties_take_the_smallest_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "f string")
    row = segments.category_profile(df, ["f"]).first()
    assert (row["most_common_category"], row["most_common_count"], row["unique_categories"]) == ("a", 2, 3)
