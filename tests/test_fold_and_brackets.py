import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlake.operators import quality as q
from campaignlake.operators import segments as s
from campaignlake.operators import stats
from campaignlake.operators.scan import EVERY, MAXIMUM, MINIMUM, TOTAL, bracketed_quantiles, ordered_fold


def plain_fold(rows, descending):
    """Running minimum, maximum, sum and conjunction per group, row by row; nulls are passed over."""
    out, state = {}, {}
    for g, k, v in sorted(rows, key=lambda r: r[1], reverse=descending):
        held = state.setdefault(g, [])
        if v is not None:
            held.append(v)
        out[g, k] = (min(held, default=None), max(held, default=None), sum(held) if held else None, all(x > 0 for x in held) if held else None)
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("groups", [1, 7, 400])
@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_fold_equals_a_loop(spark, descending, groups, partitions):
    rng = random.Random(groups)
    rows = [(None if g == 0 else f"g{g}", k, None if rng.random() < 0.1 else rng.randint(-3, 90))
            for k, g in enumerate(rng.randrange(groups) for _ in range(800))]
    df = spark.createDataFrame(rows, "g string, k int, v long").withColumn("positive", F.col("v") > 0)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        folds = {"low": ("v", MINIMUM), "high": ("v", MAXIMUM), "total": ("v", TOTAL), "each": ("positive", EVERY)}
        found = ordered_fold(df, ["k"], ["g"], folds, descending).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    expected = plain_fold(rows, descending)
    assert len(found) == len(rows)
    assert {(r.g, r.k): (r.low, r.high, r.total, r.each) for r in found} == expected


def test_reverse_minimum_has_no_window_by_group(spark):
    df = spark.range(2000).select(F.lit("one").alias("g"), "id", F.pmod(F.xxhash64("id"), F.lit(5000)).alias("v"))
    out = s.cumulative_min_reverse(df, "v", ["id"], ["g"], "low")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" not in plan
    rows = sorted(out.collect(), key=lambda r: r.id)
    assert [r.low for r in rows] == np.minimum.accumulate([r.v for r in rows][::-1])[::-1].tolist()


def test_adjusted_p_values_of_a_large_family(spark):
    p = [((i * 7919) % 1000) / 1000 for i in range(600)] + [1.0] * 200
    df = spark.createDataFrame([(i, x) for i, x in enumerate(p)], "test long, p double").repartition(5)
    found = {r.test: r.adjusted_p_value_bh for r in stats.benjamini_hochberg(df, "p").collect()}
    order = np.argsort(p, kind="stable")
    scaled = np.array(p)[order] * len(p) / np.arange(1, len(p) + 1)
    expected = np.minimum(1, np.minimum.accumulate(scaled[::-1])[::-1])
    for place, i in enumerate(order):
        assert found[i] == pytest.approx(expected[place])


@pytest.mark.parametrize("n", [1, 2, 3, 10, 999, 30_000])
def test_brackets_give_exact_quantiles(spark, n):
    i = F.col("id")
    df = spark.range(n).select(
        (F.pmod(F.xxhash64(i), F.lit(10**9)) / 7.0).alias("spread"), F.pmod(F.xxhash64(i, F.lit(2)), F.lit(3)).alias("few"),
        F.when(i % 3 > 0, F.lit(5)).otherwise(i).alias("heavy"), F.when(i % 2 == 0, -F.exp(i % 50)).alias("holes"),
        F.lit(None).cast("double").alias("none")).repartition(4).persist()
    points = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "top": 1.0}
    found = {r.feature: r for r in bracketed_quantiles(df, df.columns, points).collect()}
    rows = df.toPandas()
    assert set(found) == {"spread", "few", "heavy", "holes"}
    for c, r in found.items():
        values = rows[c].dropna().to_numpy(dtype=float)
        assert r.total_n == len(values)
        for name, p in points.items():
            assert r[name] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert bracketed_quantiles(df.where("false"), ["spread"], points).collect() == []


def test_only_brackets_are_counted_by_value(spark):
    df = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(10**12)) / 3.0).alias("v")).persist()
    import campaignlake.operators.scan as scan

    seen, real = [], scan.ordered_scan
    scan.ordered_scan = lambda counts, *a, **b: seen.append(counts.count()) or real(counts, *a, **b)
    try:
        bracketed_quantiles(df, ["v"], {"a": 0.25, "b": 0.75}).collect()
    finally:
        scan.ordered_scan = real
    assert seen and seen[0] < 400


def test_outliers_of_text_and_constant_columns(spark):
    rows = [(str(x), 4) for x in [1, 2, 3, 4, 100]] + [("bad", None), (None, 4)]
    found = {r["column"]: r for r in q.outlier_summary(spark.createDataFrame(rows, "v string, c int"), ["v", "c"]).collect()}
    assert (found["v"]["potential_outlier_count"], found["v"]["q1"], found["v"]["upper_bound"]) == (1, 2.0, 7.0)
    assert (found["c"]["potential_outlier_count"], found["c"]["potential_outlier_percentage"]) == (0, 0.0)
    assert q.outlier_summary(spark.createDataFrame([], "v int"), ["v"]).collect() == []


def test_sketches_of_parts_add_up(spark, tmp_path):
    df = spark.range(60_000).select("id", (F.col("id") % 7).alias("few"), F.when(F.col("id") % 3 > 0, F.col("id") % 5000).alias("holes"),
                                    F.lit(None).cast("string").alias("none"))
    for k in range(3):
        q.store_sketches(df.where(F.col("id") % 3 == k), f"{tmp_path}/parts", F.col("few"))
    q.store_sketches(df, f"{tmp_path}/whole")
    parts = {r["column"]: r for r in q.sketched_profile(spark, f"{tmp_path}/parts").collect()}
    whole = {r["column"]: r for r in q.sketched_profile(spark, f"{tmp_path}/whole").collect()}
    exact = {"id": (60_000, 60_000), "few": (60_000, 7), "holes": (40_000, 5001), "none": (0, 1)}
    for c, (filled, distinct) in exact.items():
        for found in (parts[c], whole[c]):
            assert found["non_null_count"] == filled
            assert abs(found["distinct_estimate"] - distinct) <= q.SKETCH_ERROR * distinct
    assert spark.read.parquet(f"{tmp_path}/parts").count() == 3 * 7 * 4
