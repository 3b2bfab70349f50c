import statistics

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from campaignlake.operators import evaluation as e
from campaignlake.operators import features as f
from campaignlake.operators import models as m
from campaignlake.operators.scan import hash_key

FOREST = {"n_estimators": 10, "max_depth": 4, "min_samples_leaf": 2}


@pytest.fixture(scope="module")
def planted(spark):
    """Feature table in which `balance` and `poutcome` drive the label."""
    u = lambda salt: (hash_key(F.col("id"), salt) % 100000) / F.lit(100000.0)
    rows = spark.range(1200).select(
        "id", (F.lit(20) + F.floor(u(1) * 50)).cast("int").alias("age"), ((u(2) - 0.5) * 4000).cast("int").alias("balance"),
        F.floor(u(3) * 4).cast("int").alias("previous"),
        F.when(u(4) < 0.6, F.lit(-1)).otherwise(F.floor(u(5) * 300)).cast("int").alias("pdays"),
        *[F.when(u(10 + i) < 0.5, F.lit("a")).otherwise(F.lit("b")).alias(c)
          for i, c in enumerate(["job", "marital", "education", "default", "housing", "loan"])],
        F.when(u(6) < 0.3, F.lit("success")).otherwise(F.lit("unknown")).alias("poutcome"),
        u(7).alias("_u"),
    )
    logit = F.col("balance") / 500.0 + F.when(F.col("poutcome") == "success", 2.5).otherwise(-1.0)
    labelled = rows.withColumn("subscribed", (F.col("_u") < 1 / (1 + F.exp(-logit))).cast("int"))
    return f.engineer_features(labelled, ["id", "subscribed"]).persist()


def test_preprocessing_learns_on_training_rows_only(spark, planted):
    train = planted.where("id < 800")
    fitted = Pipeline(stages=m.preprocessing_stages()).fit(train)
    odd = planted.where("id = 800").withColumn("job", F.lit("never seen")).withColumn("age", F.lit(None).cast("int"))
    vector = fitted.transform(odd).select(vector_to_array("features").alias("v")).first()["v"]
    # 4 numbers and one missing flag, then the blocks: job and five more with 2, poutcome 2, two flags 2 each.
    assert len(vector) == 5 + 2 * 9
    assert vector[5:7] == [0.0, 0.0]
    median = train.agg(F.percentile("age", F.lit(0.5))).first()[0]
    filled = fitted.transform(odd).first()["age_filled"]
    assert filled == median
    scaled = fitted.transform(train).select(vector_to_array("features").alias("v")).agg(
        F.avg(F.col("v")[0]), F.stddev_samp(F.col("v")[0])).first()
    assert abs(scaled[0]) < 1e-9 and scaled[1] == pytest.approx(1.0)


def test_wide_categories_keep_all_slots(spark):
    df = spark.range(1300).select(
        "id", F.col("id").cast("double").alias("v"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("c"))
    fitted = Pipeline(stages=m.preprocessing_stages(["v"], ["c"])).fit(df)
    slots = fitted.transform(df).select(F.aggregate(
        vector_to_array("features"), F.lit(0.0), lambda s, x: s + F.when(x == 1.0, 1.0).otherwise(0.0)).alias("ones"),
        F.size(vector_to_array("features")).alias("width"))
    assert slots.agg(F.min("ones"), F.min("width"), F.max("width")).first()[1:] == (1301, 1301)


def test_fit_does_not_depend_on_input_partitions(spark, planted):
    fitted = Pipeline(stages=m.preprocessing_stages()).fit(planted)
    ready = fitted.transform(planted).select("id", "subscribed", "features").persist()
    spec = m.ModelSpec("forest", "forest", True, FOREST)
    sums = set()
    for parts in (1, 4, 8):
        for key in ("id", None):
            model = m.fit_classifier(spec, ready.repartition(parts), "subscribed", key=key)
            total = m.score(model, ready).agg(F.sum(F.round("score", 12))).first()[0]
            sums.add((key, round(total, 6)))
    assert len(sums) == 2


def test_fills_of_all_folds_from_one_count(spark):
    rows = [(i, i % 3, float(i * i % 17) if i % 5 else None, "ab"[i % 2] if i % 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, fold int, v double, c string")
    parts = {f_: F.col("fold") != f_ for f_ in range(3)}
    for number, fills in m.learn_fills(df, ["v", "id"], ["c"], parts).items():
        kept = [r for r in rows if r[1] != number]
        values = [r[2] for r in kept if r[2] is not None]
        letters = [r[3] for r in kept if r[3] is not None]
        assert fills.medians["v"] == statistics.median(values)
        assert fills.modes["c"] == min(set(letters), key=lambda x: (-letters.count(x), x))
        assert list(fills.indicators) == ["v"]


def test_candidates_beat_the_prior_on_planted_signal(spark, planted):
    specs = m.candidate_models(FOREST)
    folds, summary = m.cross_validate(planted, specs, "id", "subscribed", k=3, parallelism=4)
    m.check_cv(folds, summary, specs, 3, beat_prior=True)
    rows = {r["model"]: r for r in summary.collect()}
    assert rows["dummy_prior"]["mean_roc_auc"] == 0.5
    assert rows["logistic_regression"]["mean_roc_auc"] > 0.75


def test_check_cv_reports_candidates_that_do_not_beat_the_prior(spark):
    specs = m.candidate_models(FOREST)[:2]
    row = lambda name, auc: (name, 1, auc, 0.2, 0.5, 0.1, 0.1, 0.1)
    folds = spark.createDataFrame([row("dummy_prior", 0.5), row("logistic_regression", 0.4)],
                                  "model string, fold int, " + ", ".join(f"{c} double" for c in m.METRICS))
    summary = folds.select("model", *[F.col(c).alias(f"mean_{c}") for c in m.METRICS])
    m.check_cv(folds, summary, specs, 1)
    with pytest.raises(ValueError, match="candidates_beat_prior"):
        m.check_cv(folds, summary, specs, 1, beat_prior=True)


def test_search_draws_are_seeded_and_distinct():
    drawn = m.draw_candidates()
    assert drawn == m.draw_candidates() and len(drawn) == 16
    assert len({tuple(sorted(map(str, d.items()))) for d in drawn}) == 16
    assert all(d[name] in values for d in drawn for name, values in m.SEARCH_SPACE.items())


def test_search_ranks_candidates_and_compares_with_the_baseline(spark, planted):
    space = {"n_estimators": [5, 8], "max_depth": [2, 4], "max_features": ["sqrt", 0.5], "max_samples": [None, 0.7]}
    results = m.random_search(planted, "id", "subscribed", space, n=3, k=2, parallelism=3)
    rows = results.collect()
    assert [r["rank_average_precision"] for r in rows] == [1, 2, 3]
    assert rows[0]["mean_average_precision"] >= rows[1]["mean_average_precision"]
    summary = spark.createDataFrame([("random_forest_balanced", 0.5)], "model string, mean_average_precision double")
    best = m.best_candidate(results, summary).first()
    assert best["difference"] == pytest.approx(rows[0]["mean_average_precision"] - 0.5)
    with pytest.raises(ValueError, match="one_baseline"):
        m.best_candidate(results, summary.unionAll(summary))


def test_out_of_fold_flow_to_a_threshold(spark, planted):
    scores = m.out_of_fold_scores(m.ModelSpec("lr", "logistic"), planted, "id", "subscribed", k=3, parallelism=3)
    assert scores.count() == 1200
    best = e.select_threshold(e.threshold_curve(scores)).first()
    default = e.threshold_metrics(scores, {"d": 0.5}).first()["f1"]
    assert best["f1"] >= default


def test_save_reload_and_importance(spark, planted, tmp_path):
    model = m.fit_final(m.ModelSpec("forest", "forest", True, FOREST), planted, "subscribed")
    m.save_model(model, f"{tmp_path}/model", 0.4, "subscribed", spark)
    reloaded, threshold = m.load_model(spark, f"{tmp_path}/model")
    assert threshold == 0.4
    pairs = m.check_reload(model, reloaded, planted, "id").collect()
    assert len(pairs) == 50 and all(r["original_score"] == r["reloaded_score"] for r in pairs)
    importance = m.permutation_importance(model, planted, "id", "subscribed", repeats=2).collect()
    assert [r["importance_rank"] for r in importance] == list(range(1, 14))
    assert {importance[0]["feature"], importance[1]["feature"]} <= {"balance", "poutcome", "negative_balance"}


def test_donors_are_permutations(spark):
    df = spark.range(500).select("id", (F.col("id") * 3).alias("v"))
    rows = m.shuffled_donors(df, "id", ["v"], 3).collect()
    for repeat in (1, 2, 3):
        part = [r for r in rows if r["repeat"] == repeat]
        assert sorted(r["id"] for r in part) == list(range(500))
        assert sorted(r["donor"]["v"] for r in part) == [3 * i for i in range(500)]
        assert sum(r["donor"]["v"] == r["v"] for r in part) < 50
    orders = {tuple(r["donor"]["v"] for r in sorted((x for x in rows if x["repeat"] == k), key=lambda x: x["id"])) for k in (1, 2, 3)}
    assert len(orders) == 3


def test_contracts(spark):
    assert m.preprocessing_contract(spark).count() == 2
    assert f.feature_contract(spark).count() == 19


def test_registered_search_draws_from_the_whole_space(spark, monkeypatch):
    from campaignlake.plans import model_queries as q

    seen = {}

    def search(df, key, target, space=m.SEARCH_SPACE, n=16, k=5, **options):
        seen.update(space=space, n=n, k=k)
        return df

    monkeypatch.setattr(q, "parts", lambda spark, sf_dir: (spark.range(1), None))
    monkeypatch.setattr(q, "materialize", lambda df, name: df)
    monkeypatch.setattr(q.m, "random_search", search)
    q.search(spark, "whole space")
    assert seen == {"space": m.SEARCH_SPACE, "n": 16, "k": 5}


def test_donor_oracle_covers_all_features_and_repeats():
    from campaignlake.operators.features import MODEL_FEATURES
    from campaignlake.plans.catalogue import ORACLES

    assert all(f'"donor_{c}"' in ORACLES["shuffled_donors"] for c in MODEL_FEATURES)
    assert all(f":{42 + r}'" in ORACLES["shuffled_donors"] for r in range(11))


def test_fit_partitions_do_not_grow_like_the_rows(spark):
    found = {n: m.fit_layout(spark.range(10).withColumn("label", F.lit(1)), n, "id").rdd.getNumPartitions()
             for n in (10, 10_000, 720_000, 7_200_000)}
    assert found == {10: 1, 10_000: 2, 720_000: 24, 7_200_000: 24}
    assert m.fit_partitions(43_200_000) * m.FIT_MOST_ROWS >= 43_200_000


def test_node_ids_are_kept_where_few_and_never_stored(spark, planted, monkeypatch):
    ready = Pipeline(stages=m.preprocessing_stages()).fit(planted).transform(planted).select("id", "subscribed", "features")
    made, forest = [], m.RandomForestClassifier

    def record(**settings):
        made.append((settings["cacheNodeIds"], settings["checkpointInterval"]))
        return forest(**settings)

    monkeypatch.setattr(m, "RandomForestClassifier", record)
    scores = []
    for most in (m.NODE_ID_BYTES, 4 * 1200 * 10 - 1):
        monkeypatch.setattr(m, "NODE_ID_BYTES", most)
        model = m.fit_classifier(m.ModelSpec("forest", "forest", True, FOREST), ready, "subscribed", key="id")
        scores.append(sorted(tuple(r) for r in m.score(model, ready).select("id", "score").collect()))
    assert made == [(True, -1), (False, -1)] and scores[0] == scores[1]


def test_importance_makes_only_what_the_model_reads(spark, planted, monkeypatch):
    prior = m.fit_final(m.ModelSpec("dummy_prior", "prior"), planted, "subscribed", key="id")
    seen, precision = [], m.average_precision

    def record(df, by=()):
        seen.append(df)
        return precision(df, by)

    monkeypatch.setattr(m, "average_precision", record)
    assert all(r["importance_mean"] == 0 for r in m.permutation_importance(prior, planted, "id", "subscribed", repeats=2).collect())
    plan = seen[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "donor" not in plan
    assert seen[1].count() == 2 * 13 * 1200


@pytest.mark.parametrize("depth", [4, None])
def test_many_rows_score_as_by_sparks_forest(spark, planted, depth):
    model = m.fit_final(m.ModelSpec("forest", "forest", True, {**FOREST, "max_depth": depth}), planted, "subscribed", key="id")
    # Categories and numbers that were not seen, and nulls.
    odd = planted.withColumn("job", F.when(F.col("id") % 3 == 0, F.lit("never seen")).otherwise(F.col("job"))).withColumn(
        "age", F.when(F.col("id") % 5 != 0, F.col("age") * 3 - 50))
    trees = m.StoredTrees.of(model.stages[-1])
    assert len(trees.trees) == 10 and {kind for _, kind, _ in trees.slots} == {0, 1, 2}
    by_row, by_tree = (sorted(tuple(r) for r in x.select("id", "score").collect()) for x in (m.score(model, odd), m.scorer(model)(odd)))
    assert by_row == by_tree


def test_importance_scores_in_partitions_for_all_cores(spark, planted, monkeypatch):
    model = m.fit_final(m.ModelSpec("forest", "forest", True, FOREST), planted, "subscribed", key="id")
    seen, precision = [], m.average_precision

    def record(df, by=()):
        seen.append(df)
        return precision(df, by)

    monkeypatch.setattr(m, "average_precision", record)
    m.permutation_importance(model, planted, "id", "subscribed", repeats=2).collect()
    assert seen[1].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    plan = seen[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "score(" in plan and "probability" not in plan
