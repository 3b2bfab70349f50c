import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from campaignlake.operators import scan


def _frame(spark, n=3000, seed=1):
    rng = random.Random(seed)
    # Group `a` holds more than a third of the rows.
    rows = [(i, rng.choice("aaabcd"), rng.randrange(50), rng.randrange(5)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g string, x long, w long"), pd.DataFrame(rows, columns=["id", "g", "x", "w"])


@pytest.mark.parametrize("partitions", [1, 3, 8])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_ordered_scan_matches_pandas_for_any_partitioning(spark, partitions, by):
    df, pdf = _frame(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        out = scan.ordered_scan(df.repartition(5), ["x", "id"], by, sums=["w"], lags=["w", "id"], totals=True).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    pdf = pdf.sort_values([*by, "x", "id"])
    groups = pdf.groupby(by) if by else pdf.groupby(lambda _: 0)
    pdf["cum"], pdf["prev"], pdf["prev_id"] = groups["w"].cumsum(), groups["w"].shift(1), groups["id"].shift(1)
    pdf["total"] = groups["w"].transform("sum")
    out, pdf = out.sort_values("id"), pdf.sort_values("id")
    assert (out["cum_w"].to_numpy() == pdf["cum"].to_numpy()).all()
    assert (out["total_w"].to_numpy() == pdf["total"].to_numpy()).all()
    assert out["prev_w"].fillna(-1).tolist() == pdf["prev"].fillna(-1).tolist()
    assert out["prev_id"].fillna(-1).tolist() == pdf["prev_id"].fillna(-1).tolist()


def test_scan_of_many_small_groups(spark):
    df = spark.range(2000).select((F.col("id") % 700).alias("g"), "id", F.lit(1).cast("long").alias("one"))
    out = scan.ordered_scan(df, ["id"], ["g"], sums=["one"], lags=["id"]).toPandas()
    assert (out["cum_one"] == out["id"] // 700 + 1).all()
    assert (out["prev_id"].fillna(-700) == out["id"] - 700).where(out["id"] >= 700, True).all()


def test_lag_keeps_a_real_null(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "id long, v long")
    out = {r["id"]: r["prev_v"] for r in scan.ordered_scan(df, ["id"], lags=["v"]).collect()}
    assert out == {1: None, 2: 5, 3: None}


def test_quantiles_are_exact_and_interpolated(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=999), 2)
    labels = rng.integers(0, 2, size=999)
    df = spark.createDataFrame(list(zip(values.tolist(), labels.tolist())), "v double, y long")
    ranked = scan.ranked_histogram(df, ["v"], "y")
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    specs = {f"a{i}": ("n", p) for i, p in enumerate(probs)} | {f"p{i}": ("positives", p) for i, p in enumerate(probs)}
    row = scan.quantiles(ranked, specs).first()
    for i, p in enumerate(probs):
        assert row[f"a{i}"] == pytest.approx(np.quantile(values, p), abs=1e-12)
        assert row[f"p{i}"] == pytest.approx(np.quantile(values[labels == 1], p), abs=1e-12)


def test_hash_cuts_match_a_full_sort(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    keys = df.select("id", "y", scan.hash_key(F.col("id"), 7).alias("k")).collect()
    ranks = {0: [1, 1000, 3333], 1: [10, 1667]}
    cuts = scan.hash_cuts(df, "id", "y", ranks, 7, small=2)
    for group, wanted in ranks.items():
        order = sorted((r["k"], r["id"]) for r in keys if r["y"] == group)
        for rank in wanted:
            assert cuts[(group, rank)] == order[rank - 1]


def test_hash_cuts_reject_repeated_ids(spark):
    df = spark.range(100).select(F.lit(1).alias("id"), F.lit(0).alias("y"))
    with pytest.raises(ValueError, match="not unique"):
        scan.hash_cuts(df, "id", "y", {0: [50]}, 1, small=10)


def test_plan_has_no_single_partition_exchange_of_rows(spark):
    df, _ = _frame(spark)
    plan = scan.ordered_scan(df, ["x", "id"], sums=["w"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
