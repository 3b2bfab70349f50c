"""Segment rates, profiles, bands and rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlake.functions.bands import category_position, label_map
from campaignlake.functions.numbers import fail_rows, percent, ratio
from campaignlake.operators.scan import MINIMUM, bracketed_quantiles, ordered_fold, ordered_scan, quantiles, ranked_histogram, value_histogram
from campaignlake.session import broadcast_checked, materialize


def overview(df: DataFrame, target: str) -> DataFrame:
    """One row: total, positives, negatives and the positive rate in percent."""
    y = F.col(target)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(y.cast("long")).alias("positives"),
        (F.count(F.lit(1)) - F.sum(y.cast("long"))).alias("negatives"),
        percent(F.sum(y), F.count(F.lit(1)), 2).alias("rate"),
    )


def segment_rates(
    df: DataFrame,
    by: str | Column,
    target: str,
    name: str | None = None,
    averages: Mapping[str, str] | None = None,
    half_even: bool = True,
) -> DataFrame:
    """Per segment: size, positives, rate in percent, share of all rows, optional averages.

    `averages` maps output names to columns. Null is a segment of its own. The total behind the
    share is a scalar subquery that counts rows without reading a column, so a segment column of
    any cardinality works.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    segment = F.col(by) if isinstance(by, str) else by
    label = name or (by if isinstance(by, str) else "segment")
    extra = [F.round(F.avg(c), 2).alias(out) for out, c in (averages or {}).items()]
    grouped = df.groupBy(segment.alias(label)).agg(
        F.count(F.lit(1)).alias("client_count"), F.sum(F.col(target).cast("long")).alias("subscriber_count"), *extra
    )
    return grouped.select(
        label,
        "client_count",
        "subscriber_count",
        percent(F.col("subscriber_count"), F.col("client_count"), 2, half_even).alias("subscription_rate"),
        percent(F.col("client_count"), total, 2, half_even).alias("share_of_all_clients"),
        *(averages or {}),
    )


def ordered_rates(rates: DataFrame, segment: str, order: Sequence[str] | None = None) -> DataFrame:
    """Sort segment rates by a category order, or by rate, size and name."""
    if order is None:
        return rates.orderBy(F.desc("subscription_rate"), F.desc("client_count"), segment)
    return rates.orderBy(category_position(F.col(segment), order))


def value_by_target(df: DataFrame, column: str, target: str, labels: Mapping[int, str]) -> DataFrame:
    """Per class: label, count, mean, minimum and maximum of a column."""
    grouped = df.groupBy(target).agg(
        F.count(F.lit(1)).alias("client_count"),
        F.avg(column).alias("mean_value"),
        F.min(column).alias("minimum_value"),
        F.max(column).alias("maximum_value"),
    )
    return grouped.withColumn("label", label_map(F.col(target), labels))


def value_by_target_with_median(df: DataFrame, column: str, target: str, labels: Mapping[int, str]) -> DataFrame:
    """`value_by_target` with the exact median, all from one count per (class, value)."""
    ranked = ranked_histogram(df, [column], by=[target])
    medians = quantiles(ranked, {"median_value": ("n", 0.5)}, by=[target, "feature"])
    moments = ranked.groupBy(target).agg(
        F.sum("n").alias("client_count"),
        ratio(F.sum(F.col("value") * F.col("n")), F.sum("n")).alias("mean_value"),
        F.min("value").alias("minimum_value"),
        F.max("value").alias("maximum_value"),
    )
    joined = moments.join(broadcast_checked(medians.select(target, "median_value")), target)
    return joined.withColumn("label", label_map(F.col(target), labels))


def segment_counts(df: DataFrame, features: Mapping[str, Column] | Sequence[str], target: str) -> DataFrame:
    """(feature, segment, client_count, subscriber_count) for many features in one scan."""
    if not isinstance(features, Mapping):
        features = {c: F.col(c) for c in features}
    wide = df.select(
        F.col(target).cast("long").alias("_y"),
        *[column.cast("string").alias(f"_f{i}") for i, column in enumerate(features.values())],
    )
    long = wide.unpivot(["_y"], [f"_f{i}" for i in range(len(features))], "_name", "segment")
    counted = long.groupBy("_name", "segment").agg(
        F.count(F.lit(1)).alias("client_count"), F.sum("_y").alias("subscriber_count")
    )
    names = F.create_map(*[F.lit(x) for i, f in enumerate(features) for x in (f"_f{i}", f)])
    return counted.select(names[F.col("_name")].alias("feature"), "segment", "client_count", "subscriber_count")


def multi_segment_rates(df: DataFrame, features, target: str, half_even: bool = False) -> DataFrame:
    """`segment_counts` with the rate in percent."""
    counts = segment_counts(df, features, target)
    return counts.withColumn(
        "subscription_rate", percent(F.col("subscriber_count"), F.col("client_count"), 2, half_even)
    )


def target_distribution(df: DataFrame, target: str, labels: Mapping | None = None) -> DataFrame:
    """Count and percentage per class."""
    grouped = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    out = grouped.withColumn("percentage", percent(F.col("count"), total, 2, True))
    return out.withColumn("label", label_map(F.col(target), labels)) if labels else out


def _moments(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and adjusted skewness from value counts.

    Deviations are taken from the mean in a second step over the counts, which avoids the
    cancellation of raw power sums.
    """
    by = list(by)
    v, n = F.col("value"), F.col("n")
    means = ranked.groupBy(*by).agg(
        F.sum("n").alias("count"), (F.sum(v * n) / F.sum(n)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")
    )
    gap = v - F.col("mean")
    central = (
        ranked.join(F.broadcast(means), by)
        .groupBy(*by, "count", "mean", "min", "max")
        .agg(F.sum(gap * gap * n).alias("_m2"), F.sum(gap * gap * gap * n).alias("_m3"))
    )
    total = F.col("count").cast("double")
    population_variance = F.col("_m2") / total
    skew = ratio(F.col("_m3") / total, F.pow(population_variance, F.lit(1.5)))
    adjust = F.try_divide(F.sqrt(total * (total - 1)), total - 2)
    return central.select(
        *by, "count", "mean", F.sqrt(F.try_divide(F.col("_m2"), total - 1)).alias("std"), "min", "max",
        F.when(F.col("_m2") == 0, F.lit(0.0)).otherwise(skew * adjust).alias("skewness"),
    )


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count, mean, median, sample deviation, extremes, quartiles, adjusted skewness."""
    ranked = ranked_histogram(df, columns)
    quartiles = quantiles(ranked, {"q1": ("n", 0.25), "median": ("n", 0.5), "q3": ("n", 0.75)})
    joined = _moments(ranked, ["feature"]).join(F.broadcast(quartiles), "feature")
    return joined.select("feature", "count", "mean", "median", "std", "min", "q1", "q3", "max", "skewness")


def skewness_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adjusted skewness per column with a label, strongest first."""
    size = F.abs("skewness")
    return (
        _moments(value_histogram(df, columns), ["feature"])
        .select(
            "feature",
            "skewness",
            size.alias("absolute_skewness"),
            F.when(size < 0.5, F.lit("Approximately symmetric"))
            .when(size < 1, F.lit("Moderately skewed"))
            .otherwise(F.lit("Highly skewed"))
            .alias("interpretation"),
        )
        .orderBy(F.desc("absolute_skewness"), "feature")
    )


def numeric_by_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, statistic): mean and median per class and their difference, long form."""
    ranked = ranked_histogram(df, columns, target)
    medians = quantiles(ranked, {"m0": ("negatives", 0.5), "m1": ("positives", 0.5)})
    v = F.col("value")
    means = ranked.groupBy("feature").agg(
        ratio(F.sum(v * F.col("negatives")), F.sum("negatives")).alias("a0"),
        ratio(F.sum(v * F.col("positives")), F.sum("positives")).alias("a1"),
    )
    cells = [
        F.struct(F.lit(name).alias("statistic"), F.col(low).alias("non_subscribers"), F.col(high).alias("subscribers"))
        for name, low, high in (("mean", "a0", "a1"), ("median", "m0", "m1"))
    ]
    return (
        means.join(F.broadcast(medians), "feature")
        .select("feature", F.inline(F.array(*cells)))
        .withColumn("difference", F.col("subscribers") - F.col("non_subscribers"))
    )


def category_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: distinct values (null included), the most frequent one, its count and share.

    Ties go to the smallest value.
    """
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counted = wide.unpivot([], list(columns), "feature", "value").groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    # The smallest (-count, value) is the mode with the tie rule; min works map-side.
    first = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").isNull().alias("missing"), F.col("value")))
    grouped = counted.groupBy("feature").agg(
        F.count(F.lit(1)).alias("unique_categories"), first.alias("_top"), F.sum("n").alias("_rows")
    )
    return grouped.select(
        "feature",
        "unique_categories",
        F.col("_top.value").alias("most_common_category"),
        (-F.col("_top.neg")).alias("most_common_count"),
        percent(-F.col("_top.neg"), F.col("_rows"), 2, True).alias("most_common_percentage"),
    )


def quantile_bands(df: DataFrame, column: str, target: str, q: int = 10) -> DataFrame:
    """Segment rates over quantile bands, right-closed, with equal edges merged.

    Equal values always share a band. The lower edge of the first band belongs to it.
    """
    names = [f"e{i}" for i in range(q + 1)]
    # One row of q + 1 numbers.
    found = bracketed_quantiles(df, [column], {name: i / q for i, name in enumerate(names)}).first()
    edges = list(dict.fromkeys(found[name] for name in names)) if found else []
    rows = df.select(F.col(column).cast("double").alias("value"), F.col(target).cast("long").alias("_y")).where("value IS NOT NULL")
    rows = rows.withColumn("_edges", F.array(*[F.lit(x) for x in edges]).cast("array<double>"))
    upper = F.slice("_edges", 2, q)
    index = F.least(F.size(F.filter(upper, lambda e: e < F.col("value"))), F.greatest(F.size("_edges") - 2, F.lit(0)))
    banded = (
        rows.withColumn("band", (index + 1).cast("int"))
        .groupBy("band", "_edges")
        .agg(F.count(F.lit(1)).alias("client_count"), F.sum("_y").alias("subscriber_count"))
    )
    low = F.element_at("_edges", F.col("band"))
    high = F.element_at("_edges", F.least(F.col("band") + 1, F.size("_edges")))
    return banded.select(
        "band",
        low.alias("lower_edge"),
        high.alias("upper_edge"),
        F.concat(
            F.when(F.col("band") == 1, F.lit("[")).otherwise(F.lit("(")),
            F.round(low, 3).cast("string"), F.lit(", "), F.round(high, 3).cast("string"), F.lit("]"),
        ).alias("value_range"),
        "client_count",
        "subscriber_count",
        percent(F.col("subscriber_count"), F.col("client_count"), 2, True).alias("subscription_rate"),
    )


def contingency(df: DataFrame, feature: str, target: str) -> DataFrame:
    """(category, class_0, class_1) counts; null is a category."""
    return df.groupBy(F.col(feature).alias("category")).agg(
        F.count_if(F.col(target) == 0).alias("class_0"), F.count_if(F.col(target) == 1).alias("class_1")
    )


def size_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per combination of columns."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("size"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins per numeric column, last bin closed; an empty bin has a count of zero.

    The maximum belongs to the last bin. A constant column gets a range of one around its value.
    """
    counted = materialize(value_histogram(df, columns), "histogram")
    ends = counted.groupBy("feature").agg(F.min("value").alias("_a"), F.max("value").alias("_b"))
    flat = F.col("_a") == F.col("_b")
    ends = ends.select(
        "feature",
        F.when(flat, F.col("_a") - 0.5).otherwise(F.col("_a")).alias("_low"),
        F.when(flat, F.col("_b") + 0.5).otherwise(F.col("_b")).alias("_high"),
    )
    width = (F.col("_high") - F.col("_low")) / F.lit(bins)
    index = F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("_low")) / width))
    filled = (
        counted.join(F.broadcast(ends), "feature")
        .groupBy("feature", index.cast("int").alias("bin"))
        .agg(F.sum("n").alias("count"))
    )
    return (
        ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .join(filled, ["feature", "bin"], "left")
        .withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
        .select(
            "feature",
            "bin",
            (F.col("_low") + F.col("bin") * width).alias("lower_edge"),
            (F.col("_low") + (F.col("bin") + 1) * width).alias("upper_edge"),
            "count",
        )
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Per column and class: quartiles and whiskers, the extreme values inside the 1.5 * IQR fences."""
    ranked = ranked_histogram(df, columns, by=[by])
    keys = [by, "feature"]
    box = quantiles(ranked, {"q1": ("n", 0.25), "median": ("n", 0.5), "q3": ("n", 0.75)}, by=keys)
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        ranked.join(broadcast_checked(box), keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("upper_whisker"),
        )
    )


def rank_segments(rates: DataFrame, segment: str) -> DataFrame:
    """Dense rank of segments by rate and each one's share of all positives.

    Rates have two decimals, so at most 10,001 different ones are ranked, however many segments
    there are.
    """
    places = rates.select("subscription_rate").distinct().withColumn(
        "subscription_rate_rank",
        F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("subscription_rate"))),
    )
    positives = rates.agg(F.sum("subscriber_count")).scalar()
    return rates.join(F.broadcast(places), "subscription_rate").select(
        segment,
        "client_count",
        "subscriber_count",
        "subscription_rate",
        "subscription_rate_rank",
        percent(F.col("subscriber_count"), positives, 2).alias("share_of_all_subscribers"),
    )


def rank_within_feature(rates: DataFrame, min_size: int | Column) -> DataFrame:
    """Rank the segments of each feature that are large enough by rate, positives, then name."""
    order = Window.partitionBy("feature").orderBy(
        F.desc("subscription_rate"), F.desc("subscriber_count"), F.col("segment")
    )
    kept = rates.where(F.col("client_count") >= min_size)
    return kept.withColumn("segment_rank", F.row_number().over(order))


def best_scalable_segment(df: DataFrame, features, target: str, min_share: float = 0.01) -> DataFrame:
    """Best segment per feature among those with at least `floor(rows * min_share)` rows.

    At most `1 / min_share` segments per feature reach the ranking. A feature without any segment
    large enough fails the job.
    """
    names = list(features)
    smallest = F.floor(df.agg(F.count(F.lit(1))).scalar() * F.lit(min_share))
    ranked = rank_within_feature(multi_segment_rates(df, features, target, half_even=True), smallest)
    best = ranked.where(F.col("segment_rank") == 1).drop("segment_rank")
    wanted = df.sparkSession.createDataFrame([(f,) for f in names], "feature string")
    joined = wanted.join(best, "feature", "left")
    return fail_rows(
        joined, F.col("client_count").isNull(), F.concat(F.lit("No eligible segments found for "), F.col("feature"))
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of an order; Spark keeps only k rows per task for this."""
    return df.orderBy(*order).limit(k)


def argmax_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row with the largest keys, compared one after the other."""
    return df.orderBy(*[F.desc(k) for k in keys]).limit(1)


def cumulative_min_reverse(df: DataFrame, value: str, order: Sequence[str], by: Sequence[str], out: str) -> DataFrame:
    """Running minimum from the last row of each group to the first; groups may be of any size."""
    return ordered_fold(df, order, by, {out: (value, MINIMUM)}, descending=True)


def dense_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """1..n in a unique order, over any number of rows."""
    numbered = ordered_scan(df.withColumn("_one", F.lit(1).cast("long")), order, sums=["_one"])
    return numbered.withColumnRenamed("cum__one", name).drop("_one")
