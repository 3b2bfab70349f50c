import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from campaignlake.operators import features as f


def _raw(spark, n=200):
    i = F.col("id")
    return spark.range(n).select(
        "id", (i % 50 + 20).cast("int").alias("age"), F.lit("job").alias("job"), F.lit("single").alias("marital"),
        F.lit("primary").alias("education"), F.lit("no").alias("default"), (i % 7 - 2).cast("int").alias("balance"),
        F.lit("yes").alias("housing"), F.lit("no").alias("loan"), (i % 4 - 1).cast("int").alias("pdays"),
        (i % 3).cast("int").alias("previous"), F.lit("unknown").alias("poutcome"), (i % 5 == 0).cast("int").alias("subscribed"),
    )


def test_engineered_features(spark):
    out = f.engineer_features(_raw(spark), ["id"])
    assert out.columns == ["id", *f.MODEL_FEATURES]
    f.check_features(out, ignore=["id"])
    rows = {r["id"]: r for r in out.where("id < 4").collect()}
    assert [rows[i]["previously_contacted"] for i in range(4)] == ["no", "yes", "yes", "yes"]
    assert [rows[i]["pdays_since_previous_contact"] for i in range(4)] == [None, 0.0, 1.0, 2.0]
    assert [rows[i]["negative_balance"] for i in range(4)] == ["yes", "yes", "no", "no"]


def test_missing_input_and_forbidden_columns(spark):
    with pytest.raises(ValueError, match="Required raw features"):
        f.engineer_features(_raw(spark).drop("job"))
    features = f.engineer_features(_raw(spark))
    with pytest.raises(ValueError, match="Current-campaign features"):
        f.check_features(features.withColumn("duration", F.lit(1)))
    with pytest.raises(ValueError, match="target column"):
        f.check_features(features.withColumn("subscribed", F.lit(1)))
    with pytest.raises(ValueError, match="missing_days_match_flag"):
        f.check_features(features.withColumn(f.NULLABLE, F.lit(None).cast("double")))
    with pytest.raises(ValueError, match="age_not_null"):
        f.check_features(features.withColumn("age", F.lit(None).cast("int")))
    with pytest.raises(ValueError, match="negative_balance_has_yes"):
        f.check_features(features.withColumn("negative_balance", F.lit("no")))


def test_allocation_of_published_sizes():
    assert f.allocate({0: 39922, 1: 5289}, 9043) == {0: 7985, 1: 1058}


@pytest.mark.parametrize("n", [10, 997])
def test_split_is_exact_disjoint_and_repeatable(spark, n):
    rows = _raw(spark, n)
    out = f.stratified_split(rows, "id", "subscribed")
    first = {r["id"]: r["split"] for r in out.collect()}
    assert first == {r["id"]: r["split"] for r in f.stratified_split(rows.repartition(7), "id", "subscribed").collect()}
    counts = {(r["split"], r["subscribed"]): r["count"] for r in out.groupBy("split", "subscribed").count().collect()}
    want = f.allocate({0: n - (n + 4) // 5, 1: (n + 4) // 5}, -(-n // 5))
    assert {c: counts.get(("test", c), 0) for c in (0, 1)} == want
    assert f.stratified_split(rows, "id", "subscribed", seed=1).join(out, ["id", "split"]).count() < n


def test_split_needs_no_shuffle_of_the_table(spark):
    plan = f.stratified_split(_raw(spark), "id", "subscribed")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_split_check(spark):
    out = f.stratified_split(_raw(spark), "id", "subscribed")
    train, test = out.where("split = 'train'"), out.where("split = 'test'")
    f.check_split(train, test, "id", "subscribed", {"row_count": 160}, {"row_count": 40, "positives": 8})
    with pytest.raises(ValueError, match="overlap"):
        f.check_split(train, train, "id", "subscribed")
    with pytest.raises(ValueError, match="row_count"):
        f.check_split(train, test, "id", "subscribed", {"row_count": 1})
    summary = {r["split"]: r for r in f.split_summary(out, "split", "subscribed").collect()}
    assert summary["full_dataset"]["record_count"] == 200 and summary["test"]["subscription_rate_percentage"] == 20.0


def test_folds_cover_and_balance(spark):
    out = f.stratified_folds(_raw(spark, 203), "id", "subscribed", 5)
    counts = {}
    for r in out.groupBy("fold", "subscribed").count().collect():
        counts.setdefault(r["subscribed"], {})[r["fold"]] = r["count"]
    for c, total in ((0, 162), (1, 41)):
        sizes = counts[c]
        assert sorted(sizes) == [0, 1, 2, 3, 4] and sum(sizes.values()) == total
        assert max(sizes.values()) - min(sizes.values()) <= 1


def test_folds_with_fewer_rows_than_folds(spark):
    rows = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 0), (5, 0), (6, 1), (7, 1)], "id long, y int")
    out = f.stratified_folds(rows, "id", "y", 5)
    assert sorted(r["fold"] for r in out.where("y = 1").collect()) == [0, 1]
    assert sorted(r["fold"] for r in out.where("y = 0").collect()) == [0, 1, 2, 3, 4]


def test_attach_target_rejects_other_keys(spark):
    rows = _raw(spark)
    features = f.engineer_features(rows, ["id"])
    assert f.attach_target(features, rows, "id").where(F.col("subscribed").isNotNull()).count() == 200
    with pytest.raises(ValueError, match="not aligned"):
        f.attach_target(features, rows.where("id > 0"), "id")
    with pytest.raises(ValueError, match="1 keys repeat"):
        f.attach_target(features, rows.union(rows.where("id = 5")), "id")
    with pytest.raises(ValueError, match="1 keys repeat"):
        f.attach_target(features.union(features.where("id = 5")), rows, "id")


def test_attach_target_broadcasts_neither_side(spark):
    rows = _raw(spark)
    joined = f.attach_target(f.engineer_features(rows, ["id"]), rows, "id")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in joined.select("id").collect()) == sorted(r["id"] for r in rows.select("id").collect())
