"""Association tests, effect sizes, intervals and multiple-testing correction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlake.functions.numbers import fail_rows, fail_when, ratio
from campaignlake.functions.survival import chi_square_p_value, normal_p_value
from campaignlake.operators.scan import mid_rank, quantiles, ranked_histogram
from campaignlake.operators.segments import segment_counts
from campaignlake.session import materialize

ALPHA = 0.05
CONFIDENCE = 0.95
TOO_SMALL = "Cramér's V needs rows and at least two categories on both sides."


def z_score(confidence: float) -> float:
    return NormalDist().inv_cdf(1 - (1 - confidence) / 2)


def effect_label(column: Column) -> Column:
    """Descriptive label of an effect size, by its absolute value."""
    size = F.abs(column)
    return (
        F.when(size < 0.10, F.lit("Negligible"))
        .when(size < 0.30, F.lit("Small"))
        .when(size < 0.50, F.lit("Moderate"))
        .otherwise(F.lit("Large"))
    )


def cramers_v(chi_square: Column, n: Column, rows: Column, columns: Column) -> Column:
    """sqrt(chi2 / (n * min(r - 1, c - 1))); fails on an empty table or a single category."""
    smaller = F.least(rows - 1, columns - 1)
    value = F.sqrt(ratio(chi_square, n * smaller))
    return fail_when(
        (n <= 0) | (smaller <= 0),
        TOO_SMALL,
        value,
        "double",
    )


def chi_square_tests(df: DataFrame, features, target: str, p_values: bool = True) -> DataFrame:
    """Pearson chi-square without continuity correction, per feature, with Cramér's V.

    All features are counted in one scan; a null counts as a category. The expected counts of both
    classes follow from the row of a category, so empty cells need no row of their own.
    """
    counts = materialize(segment_counts(df, features, target), "segments")
    totals = counts.groupBy("feature").agg(
        F.sum("client_count").alias("_n"), F.sum("subscriber_count").alias("_p"), F.count(F.lit(1)).alias("_r")
    )
    n, p = F.col("_n").cast("double"), F.col("_p").cast("double")
    size, hits = F.col("client_count").cast("double"), F.col("subscriber_count").cast("double")
    expected1, expected0 = size * p / n, size * (n - p) / n
    cell1 = F.try_divide((hits - expected1) * (hits - expected1), expected1)
    cell0 = F.try_divide((size - hits - expected0) * (size - hits - expected0), expected0)
    tested = (
        counts.join(F.broadcast(totals), "feature")
        .groupBy("feature", "_n", "_p", "_r")
        .agg(
            F.sum(cell0 + cell1).alias("chi_square_statistic"),
            F.min(F.least(expected0, expected1)).alias("minimum_expected_frequency"),
            (F.count_if(expected0 < 5) + F.count_if(expected1 < 5)).alias("expected_cells_below_five"),
        )
    )
    classes = F.when((F.col("_p") > 0) & (F.col("_p") < F.col("_n")), F.lit(2)).otherwise(F.lit(1))
    tested = fail_rows(tested, (F.col("_n") <= 0) | (F.least(F.col("_r"), classes) <= 1), TOO_SMALL)
    share = F.bround(F.lit(100.0) * F.col("expected_cells_below_five") / (F.col("_r") * 2), 2)
    out = tested.select(
        "feature",
        F.col("_r").alias("number_of_categories"),
        F.col("_n").alias("sample_size"),
        "chi_square_statistic",
        (F.col("_r") - 1).alias("degrees_of_freedom"),
        cramers_v(F.col("chi_square_statistic"), F.col("_n"), F.col("_r"), classes).alias("cramers_v"),
        "minimum_expected_frequency",
        "expected_cells_below_five",
        share.alias("expected_cells_below_five_percentage"),
        ((F.col("minimum_expected_frequency") < 1) | (share > 20)).alias("assumption_warning"),
    ).withColumn("effect_size_interpretation", effect_label(F.col("cramers_v")))
    if not p_values:
        return out
    return out.withColumn("p_value", chi_square_p_value("chi_square_statistic", "degrees_of_freedom"))


@dataclass(frozen=True)
class GroupTest:
    """One rank test: its name, the numeric column, and the rows it uses."""

    name: str
    column: str
    subset: str = "all_clients"
    rows: Column | None = None
    leakage_sensitive: bool = False


def mann_whitney_tests(df: DataFrame, specs: Sequence[GroupTest], target: str, p_values: bool = True) -> DataFrame:
    """Mann-Whitney U of positives against negatives with rank-biserial effect sizes.

    All tests share one count per (test, value). U sums, over the values, positives times the
    negatives below plus half of those tied. The two-sided p-value is the normal approximation with
    tie and continuity correction. A test with an empty class fails the job.
    """
    values = {s.name: F.col(s.column) if s.rows is None else F.when(s.rows, F.col(s.column)) for s in specs}
    ranked = ranked_histogram(df, values, target)
    medians = quantiles(
        ranked, {"subscriber_median": ("positives", 0.5), "non_subscriber_median": ("negatives", 0.5)}
    )
    d = lambda c: F.col(c).cast("double")
    below = d("cum_negatives") - d("negatives")
    sums = ranked.groupBy("feature").agg(
        F.sum(d("positives") * (below + d("negatives") / 2)).alias("mann_whitney_u"),
        F.sum(d("n") * d("n") * d("n") - d("n")).alias("_ties"),
        F.sum(F.col("value") * F.col("positives")).alias("_s1"),
        F.sum(F.col("value") * F.col("negatives")).alias("_s0"),
        F.sum("positives").alias("subscriber_sample_size"),
        F.sum("negatives").alias("non_subscriber_sample_size"),
    )
    n1, n0 = d("subscriber_sample_size"), d("non_subscriber_sample_size")
    described = F.create_map(
        *[
            x
            for s in specs
            for x in (
                F.lit(s.name),
                F.struct(
                    F.lit(s.column).alias("source_feature"),
                    F.lit(s.subset).alias("subset"),
                    F.lit(s.leakage_sensitive).alias("leakage_sensitive"),
                ),
            )
        ]
    )
    wanted = df.sparkSession.createDataFrame([(s.name,) for s in specs], "feature string")
    joined = wanted.join(sums, "feature", "left").join(F.broadcast(medians), "feature", "left")
    empty = F.coalesce(n1, F.lit(0.0)) * F.coalesce(n0, F.lit(0.0)) == 0
    total = n1 + n0
    variance = n1 * n0 / 12 * ((total + 1) - F.try_divide(F.col("_ties"), total * (total - 1)))
    distance = F.greatest(F.col("mann_whitney_u"), n1 * n0 - F.col("mann_whitney_u")) - n1 * n0 / 2 - 0.5
    gap = F.col("subscriber_median") - F.col("non_subscriber_median")
    effect = F.lit(2.0) * F.col("mann_whitney_u") / (n1 * n0) - 1
    whole = fail_rows(joined, empty, F.concat(F.lit("Test '"), F.col("feature"), F.lit("' has an empty group.")))
    out = whole.select(
        F.col("feature").alias("analysis_name"),
        *[described[F.col("feature")][c].alias(c) for c in ("source_feature", "subset", "leakage_sensitive")],
        "subscriber_sample_size",
        "non_subscriber_sample_size",
        F.try_divide(F.col("_s1"), n1).alias("subscriber_mean"),
        F.try_divide(F.col("_s0"), n0).alias("non_subscriber_mean"),
        "subscriber_median",
        "non_subscriber_median",
        gap.alias("median_difference"),
        F.when(gap > 0, F.lit("Higher among subscribers"))
        .when(gap < 0, F.lit("Lower among subscribers"))
        .otherwise(F.lit("Equal medians"))
        .alias("median_direction"),
        "mann_whitney_u",
        F.try_divide(distance, F.sqrt(variance)).alias("z_statistic"),
        effect.alias("rank_biserial_correlation"),
        F.abs(effect).alias("absolute_effect_size"),
        effect_label(effect).alias("effect_size_interpretation"),
    )
    return out.withColumn("p_value", normal_p_value("z_statistic")) if p_values else out


def benjamini_hochberg(
    df: DataFrame, p_column: str, family: Sequence[str] = (), key: Sequence[str] = (), alpha: float = ALPHA
) -> DataFrame:
    """Add `adjusted_p_value_bh` and `reject_null_fdr_0_05`; one row per test, adjusted per family.

    A missing p-value or one outside 0..1 fails the job.
    """
    p = F.col(p_column)
    bad = p.isNull() | F.isnan(p) | (p < 0) | (p > 1)
    checked = fail_rows(df, bad, "A p-value is missing or not between 0 and 1.")
    groups = list(family) or [F.lit(0)]
    window = Window.partitionBy(*groups)
    upward = window.orderBy(F.col(p_column), *key)
    downward = window.orderBy(F.col("_rank").desc())
    ranked = checked.withColumn("_rank", F.row_number().over(upward)).withColumn(
        "_scaled", p * F.count(F.lit(1)).over(window) / F.col("_rank")
    )
    running = F.min("_scaled").over(downward.rowsBetween(Window.unboundedPreceding, 0))
    adjusted = F.least(F.lit(1.0), F.greatest(F.lit(0.0), running))
    return (
        ranked.withColumn("adjusted_p_value_bh", adjusted)
        .withColumn("reject_null_fdr_0_05", F.col("adjusted_p_value_bh") < alpha)
        .drop("_rank", "_scaled")
    )


def wilson_columns(successes: Column, total: Column, confidence: float = CONFIDENCE) -> tuple[Column, Column, Column]:
    """Estimate, lower and upper Wilson bound; fails on impossible counts."""
    z = z_score(confidence)
    n, k = total.cast("double"), successes.cast("double")
    checked = fail_when(
        n <= 0,
        "The number of rows of a rate must be positive.",
        fail_when((k < 0) | (k > n), "Successes must lie between zero and total rows.", F.try_divide(k, n), "double"),
        "double",
    )
    z2 = F.lit(z * z)
    denominator = F.lit(1.0) + F.try_divide(z2, n)
    center = (checked + F.try_divide(z2, 2 * n)) / denominator
    spread = F.try_divide(checked * (1 - checked), n) + F.try_divide(z2, 4 * n * n)
    margin = F.lit(z) / denominator * F.sqrt(spread)
    return checked, center - margin, center + margin


def wilson_interval(df: DataFrame, target: str, confidence: float = CONFIDENCE) -> DataFrame:
    """One row: the positive rate in percent with its Wilson interval."""
    counted = df.agg(F.count(F.lit(1)).alias("total"), F.sum(F.col(target).cast("long")).alias("positives"))
    counted = fail_rows(counted, F.col("total") <= 0, "The number of rows of a rate must be positive.")
    estimate, low, high = wilson_columns(F.col("positives"), F.col("total"), confidence)
    return counted.select(
        F.col("total").alias("total_clients"),
        F.col("positives").alias("subscribers"),
        (estimate * 100).alias("estimated_subscription_rate_percentage"),
        (low * 100).alias("ci_lower_percentage"),
        (high * 100).alias("ci_upper_percentage"),
        F.lit(confidence).alias("confidence_level"),
        F.lit("Wilson score interval").alias("method"),
    )


@dataclass(frozen=True)
class Comparison:
    """Two groups of rows, given by predicates, whose positive rates are compared."""

    name: str
    group_a: str
    rows_a: Column
    group_b: str
    rows_b: Column


def proportion_differences(
    df: DataFrame, comparisons: Sequence[Comparison], target: str, confidence: float = CONFIDENCE
) -> DataFrame:
    """Rate difference in points with a Wald interval per comparison; one aggregation for all.

    Overlapping or empty groups fail the job.
    """
    y = F.col(target).cast("long")
    aggregates = []
    for i, c in enumerate(comparisons):
        aggregates += [
            F.count_if(c.rows_a).alias(f"na{i}"),
            F.count_if(c.rows_b).alias(f"nb{i}"),
            F.coalesce(F.sum(F.when(c.rows_a, y)), F.lit(0)).alias(f"ka{i}"),
            F.coalesce(F.sum(F.when(c.rows_b, y)), F.lit(0)).alias(f"kb{i}"),
            F.count_if(c.rows_a & c.rows_b).alias(f"both{i}"),
        ]
    structs = [
        F.struct(
            F.lit(c.name).alias("comparison"),
            F.lit(c.group_a).alias("group_a"),
            F.lit(c.group_b).alias("group_b"),
            F.col(f"na{i}").alias("group_a_size"),
            F.col(f"nb{i}").alias("group_b_size"),
            F.col(f"ka{i}").alias("group_a_subscribers"),
            F.col(f"kb{i}").alias("group_b_subscribers"),
            F.col(f"both{i}").alias("_both"),
        )
        for i, c in enumerate(comparisons)
    ]
    rows = df.agg(*aggregates).select(F.inline(F.array(*structs)))
    na, nb = F.col("group_a_size").cast("double"), F.col("group_b_size").cast("double")
    ra, rb = F.try_divide(F.col("group_a_subscribers"), na), F.try_divide(F.col("group_b_subscribers"), nb)
    error = F.sqrt(F.try_divide(ra * (1 - ra), na) + F.try_divide(rb * (1 - rb), nb))
    z = F.lit(z_score(confidence))
    rows = fail_rows(rows, F.col("_both") > 0, F.concat(F.lit("Groups overlap in the comparison "), F.col("comparison")))
    rows = fail_rows(
        rows, (na == 0) | (nb == 0), F.concat(F.lit("A group is empty in the comparison "), F.col("comparison"))
    )
    return rows.select(
        "comparison", "group_a", "group_b", "group_a_size", "group_b_size",
        "group_a_subscribers", "group_b_subscribers",
        (ra * 100).alias("group_a_rate_percentage"),
        (rb * 100).alias("group_b_rate_percentage"),
        ((ra - rb) * 100).alias("difference_percentage_points"),
        ((ra - rb - z * error) * 100).alias("ci_lower_percentage_points"),
        ((ra - rb + z * error) * 100).alias("ci_upper_percentage_points"),
        F.lit(confidence).alias("confidence_level"),
    )


def half_widths(intervals: DataFrame) -> DataFrame:
    """Distances from the difference to both bounds (error bars)."""
    gap = F.col("difference_percentage_points")
    return intervals.select(
        "comparison",
        gap.alias("difference_percentage_points"),
        (gap - F.col("ci_lower_percentage_points")).alias("lower_error"),
        (F.col("ci_upper_percentage_points") - gap).alias("upper_error"),
    )


def rank_columns(df: DataFrame, columns: Sequence[str], key: str, small: int = 1_000_000) -> DataFrame:
    """Replace each column by the average rank of its value, null where the value is null.

    Columns whose distinct values number at most `small` in all get their ranks by a broadcast
    join, its size checked here. The others go through the long form once: values so frequent that
    they would overload one task are matched by broadcast (there can be few of them), all the rest
    by a shuffle join on (column, value). `key` must be unique.
    """
    ranks = materialize(mid_rank(ranked_histogram(df, columns)).select("feature", "value", "n", "mid_rank"), "ranks")
    distinct = {r["feature"]: (r["d"], r["n"]) for r in ranks.groupBy("feature").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n")).collect()}
    out = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    large, used = [], 0
    for c in sorted(columns, key=lambda name: distinct.get(name, (0, 0))[0]):
        used += distinct.get(c, (0, 0))[0]
        if used > small:
            large.append(c)
            continue
        lookup = ranks.where(F.col("feature") == c).select(F.col("value").alias("_v"), F.col("mid_rank").alias(f"_rank_{c}"))
        out = out.join(F.broadcast(lookup), F.col(c) == F.col("_v"), "left").drop("_v")
    near = [c for c in columns if c not in large]
    result = out.select(key, *[F.col(f"_rank_{c}").alias(c) for c in near])
    if not large:
        return result.select(key, *columns)
    rows = max(distinct[c][1] for c in large)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = F.col("n") * parts >= rows  # at most `parts` values per column
    picked = ranks.where(F.col("feature").isin(large))
    hot = picked.where(frequent).select("feature", "value", F.col("mid_rank").alias("_hot"))
    cold = picked.where(~frequent).select("feature", "value", F.col("mid_rank").alias("_cold"))
    long = df.select(key, *[F.col(c).cast("double").alias(c) for c in large]).unpivot(
        [key], large, "feature", "value"
    )
    tagged = long.where(F.col("value").isNotNull()).join(F.broadcast(hot), ["feature", "value"], "left")
    direct = tagged.where(F.col("_hot").isNotNull()).select(key, "feature", F.col("_hot").alias("_rank"))
    looked_up = (
        tagged.where(F.col("_hot").isNull()).join(cold, ["feature", "value"]).select(key, "feature", F.col("_cold").alias("_rank"))
    )
    wide = (
        direct.unionByName(looked_up)
        .groupBy(key)
        .agg(*[F.max(F.when(F.col("feature") == c, F.col("_rank"))).alias(c) for c in large])
    )
    return result.join(wide, key, "left").select(key, *columns)


# Columns of one block of a Gram matrix, and columns beyond which ranks are looked up in the long form.
GRAM_BLOCK = 64
WIDE = 40


def gram_matrix(df: DataFrame, columns: Sequence[str], shift: float) -> DataFrame:
    """(i, j, value): sums over all rows of (column i - shift) * (column j - shift), for i <= j.

    Each task adds the products of its Arrow batches up as matrices, one pair of column blocks at a time,
    and gives one row per pair of columns; sums over tasks follow by a grouping. A null fails the job.
    """
    names = list(columns)

    def sums(batches):
        total = np.zeros((len(names), len(names)))
        for batch in batches:
            gaps = [name for name, column in zip(names, batch.columns) if column.null_count]
            if gaps:
                raise ValueError(f"Columns of a correlation hold nulls: {gaps}")
            rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - shift
            for i in range(0, len(names), GRAM_BLOCK):
                total[i:i + GRAM_BLOCK, i:] += rows[:, i:i + GRAM_BLOCK].T @ rows[:, i:]
        i, j = np.triu_indices(len(names))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "value"])

    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(names)])
    return parts.mapInArrow(sums, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))


def spearman_matrix(df: DataFrame, columns: Sequence[str], key: str, small: int = 1_000_000) -> DataFrame:
    """(feature_a, feature_b, correlation) for all pairs of columns; columns hold no nulls.

    Pearson correlation of average ranks: one Gram matrix of centred ranks, so hundreds of columns take one
    pass. Ranks of more than WIDE columns are looked up in the long form, not by a join per column. A
    constant column correlates with nothing (null), and with itself by 1.
    """
    columns = list(columns)
    ranked = rank_columns(df, columns, key, 0 if len(columns) > WIDE else small)
    middle = (df.count() + 1) / 2
    gram = materialize(gram_matrix(ranked, columns, middle), "gram")
    diagonal = gram.where("i = j").select("i", F.col("value").alias("own"))
    # One row per column.
    spread = [F.broadcast(diagonal.select(F.col("i").alias(k), F.col("own").alias(f"own_{k}"))) for k in "ij"]
    value = F.try_divide(F.col("value"), F.sqrt("own_i") * F.sqrt("own_j"))
    pairs = gram.where("i < j").join(spread[0], "i").join(spread[1], "j").select("i", "j", value.alias("correlation"))
    both = pairs.unionByName(pairs.select(F.col("j").alias("i"), F.col("i").alias("j"), "correlation"))
    own = gram.where("i = j").select("i", "j", F.lit(1.0).alias("correlation"))
    names = F.array(*[F.lit(c) for c in columns])
    return both.unionByName(own).select(
        F.get(names, "i").alias("feature_a"), F.get(names, "j").alias("feature_b"), "correlation")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Spearman correlation of each column with a 0/1 target, strongest first.

    The target has two ranks, so the counts per value are enough: no row is ranked.
    """
    ranked = mid_rank(ranked_histogram(df, columns, target))
    totals = [F.col("total_n").cast("double").alias("_n"), F.col("total_positives").cast("double").alias("_p")]
    gap = F.col("mid_rank") - (F.col("total_n") + 1) / 2
    sums = ranked.groupBy("feature", *totals).agg(
        F.sum(gap * gap * F.col("n")).alias("_xx"), F.sum(gap * F.col("positives")).alias("_xy")
    )
    # Positives rank n/2 above negatives, which gives the target's spread in closed form.
    share = F.col("_p") / F.col("_n")
    spread = F.sqrt(F.col("_n") * share * (1 - share))
    value = F.try_divide(F.col("_xy"), F.sqrt(F.col("_xx")) * spread)
    return sums.select(
        "feature",
        value.alias("spearman_correlation_with_target"),
        F.abs(value).alias("absolute_correlation"),
    ).orderBy(F.desc("absolute_correlation"), "feature")


def practical_significance(tests: DataFrame) -> DataFrame:
    """Flag tests that are significant although their effect is small or negligible."""
    minor = F.col("effect_size_interpretation").isin("Negligible", "Small")
    return tests.withColumn(
        "statistically_significant_but_small_or_negligible", F.col("reject_null_fdr_0_05") & minor
    )


def assumption_review(tests: DataFrame) -> DataFrame:
    """Chi-square assumption columns, warnings first."""
    return tests.select(
        "feature",
        "minimum_expected_frequency",
        "expected_cells_below_five",
        "expected_cells_below_five_percentage",
        "assumption_warning",
    ).orderBy(F.desc("assumption_warning"), F.desc("expected_cells_below_five_percentage"), "feature")
