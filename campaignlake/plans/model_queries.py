"""Registered queries: model training, tuning, scoring and importance on the campaign table.

Fitted models have no SQL form; fills, the prior, bags and the shuffles do. Forests have their full settings,
those of the random search too: 16 candidates of the whole space and 5 folds.
"""

from __future__ import annotations

import threading

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from campaignlake.operators import evaluation as e
from campaignlake.operators import features as f
from campaignlake.operators import forest as fo
from campaignlake.operators import models as m
from campaignlake.plans.feature_queries import _FLAGS, _ORDERED, split_campaign
from campaignlake.plans.registry import oracle, register
from campaignlake.session import materialize, scratch_path
from campaignlake.sources.campaign import KEY, TARGET

FOREST = next(spec for spec in m.candidate_models() if spec.kind == "forest")

_made: dict[tuple, object] = {}
_lock = threading.RLock()


def _once(name, spark, sf_dir, make):
    """Keep split tables and the fitted model per application and folder; several queries use them."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _made:
            _made[key] = make()
        return _made[key]


def parts(spark, sf_dir):
    """(train, test) feature tables with key and target."""

    def make():
        rows = split_campaign(spark, sf_dir)
        return tuple(
            materialize(f.engineer_features(rows.where(F.col("split") == name), [KEY, TARGET]), name)
            for name in ("train", "test")
        )

    return _once("parts", spark, sf_dir, make)


def final_model(spark, sf_dir):
    return _once("model", spark, sf_dir, lambda: m.fit_final(FOREST, parts(spark, sf_dir)[0], TARGET, key=KEY))


def comparison(spark, sf_dir):
    """(fold results, summary) of all candidates at their full settings."""
    train = parts(spark, sf_dir)[0]
    return _once(
        "comparison", spark, sf_dir,
        lambda: m.cross_validate(train, m.candidate_models(), KEY, TARGET, parallelism=4),
    )


def search(spark, sf_dir):
    train = parts(spark, sf_dir)[0]
    return _once(
        "search", spark, sf_dir,
        lambda: materialize(m.random_search(train, KEY, TARGET, parallelism=4), "search"),
    )


def test_scores(spark, sf_dir):
    scored = m.score(final_model(spark, sf_dir), parts(spark, sf_dir)[1])
    return scored.select(F.col(KEY).alias("id"), F.col(TARGET).alias("label"), "score")


_TRAIN = f"""train AS (
  SELECT campaign_record_id, subscribed, age, balance, previous, job, marital, education, "default", housing, loan, poutcome, {_FLAGS}
  FROM divided WHERE split = 'train'
)"""


@register(
    "median_fills",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS fill, bool_or({c} IS NULL) AS has_indicator FROM train"""
            for c in f.NUMERIC_FEATURES
        ),
        _ORDERED, _TRAIN,
    ),
)
def _median_fills(spark, sf_dir):
    """Medians learned from the training rows, and which columns get a missing indicator."""
    train, _ = parts(spark, sf_dir)
    fills = m.learn_fills(train, f.NUMERIC_FEATURES, [], {"train": F.lit(True)})["train"]
    rows = [(c, float(fills.medians[c]), c in fills.indicators) for c in f.NUMERIC_FEATURES]
    return spark.createDataFrame(rows, "feature string, fill double, has_indicator boolean")


@register(
    "mode_fills",
    oracle(
        " UNION ALL ".join(
            f"""(SELECT '{c}' AS feature, "{c}" AS fill FROM train GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 1)"""
            for c in f.CATEGORICAL_FEATURES
        ),
        _ORDERED, _TRAIN,
    ),
)
def _mode_fills(spark, sf_dir):
    """Most frequent categories of the training rows."""
    train, _ = parts(spark, sf_dir)
    fills = m.learn_fills(train, f.NUMERIC_FEATURES, f.CATEGORICAL_FEATURES, {"train": F.lit(True)})["train"]
    return spark.createDataFrame(sorted(fills.modes.items()), "feature string, fill string")


@register(
    "prior_scores",
    oracle(
        """SELECT campaign_record_id AS id, subscribed AS label,
                  round((SELECT avg(subscribed) FROM divided WHERE split = 'train'), 8) AS score
        FROM divided WHERE split = 'test'""",
        _ORDERED,
    ),
)
def _prior_scores(spark, sf_dir):
    """Test rows scored with the positive rate of the training rows."""
    train, test = parts(spark, sf_dir)
    prior = m.fit_classifier(m.ModelSpec("dummy_prior", "prior"), train.withColumn("features", F.lit(0)), TARGET)
    scored = m.score(prior, test)
    return scored.select(F.col(KEY).alias("id"), F.col(TARGET).alias("label"), F.round("score", 8).alias("score"))


_FEATURE_LIST = ", ".join(f'"{c}"' for c in f.MODEL_FEATURES)
_DONATED = ", ".join(f'd."{c}" AS "donor_{c}"' for c in f.MODEL_FEATURES)
_ORDERS = "orders_by_hash AS (" + " UNION ALL ".join(
    f"""SELECT {r} AS repeat, campaign_record_id, {_FEATURE_LIST}, row_number() OVER (
          ORDER BY CAST('0x' || substr(md5(campaign_record_id || ':{42 + r}'), 1, 15) AS BIGINT), campaign_record_id) AS place
        FROM (SELECT *, {_FLAGS} FROM divided WHERE split = 'test')"""
    for r in range(11)
) + ")"


@register(
    "shuffled_donors",
    oracle(
        f"""SELECT b.campaign_record_id, b.age, d.repeat, {_DONATED}
        FROM orders_by_hash b JOIN orders_by_hash d ON b.place = d.place AND b.repeat = 0 AND d.repeat > 0""",
        _ORDERED, _ORDERS,
    ),
)
def _shuffled_donors(spark, sf_dir):
    """Ten random permutations of the test rows with all features, as used for permutation importance."""
    _, test = parts(spark, sf_dir)
    pairs = m.shuffled_donors(test.select(KEY, *f.MODEL_FEATURES), KEY, f.MODEL_FEATURES, 10)
    return pairs.select(KEY, "age", "repeat", *[F.col("donor")[c].alias(f"donor_{c}") for c in f.MODEL_FEATURES])


_FILLED = {c: f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM train))" for c in f.NUMERIC_FEATURES}
_FILLED["missing"] = "CAST(pdays_since_previous_contact IS NULL AS DOUBLE)"
_PREPROCESSED = f"""both_parts AS (
  SELECT split, campaign_record_id, subscribed, {", ".join(f"{e_} AS x{i}" for i, e_ in enumerate(_FILLED.values()))},
         {", ".join(f'"{c}"' for c in f.CATEGORICAL_FEATURES)}
  FROM (SELECT *, {_FLAGS} FROM divided)
), moments AS (
  SELECT {", ".join(f"avg(x{i}) AS m{i}, stddev_samp(x{i}) AS s{i}" for i in range(5))} FROM both_parts WHERE split = 'train'
), categories AS (
  SELECT {", ".join(f'list_sort(list_distinct(list("{c}"))) AS c{i}' for i, c in enumerate(f.CATEGORICAL_FEATURES))} FROM train
)"""


@register(
    "preprocessed_features",
    oracle(
        f"""SELECT campaign_record_id, subscribed, {", ".join(f"round((x{i} - m{i}) / s{i}, 6) AS z{i}" for i in range(5))},
            {" || ',' || ".join(f"""list_aggregate(list_transform(c{i}, lambda c: CAST(CAST(c = "{c}" AS INTEGER) AS VARCHAR)), 'string_agg', ',')"""
                                for i, c in enumerate(f.CATEGORICAL_FEATURES))} AS one_hot
        FROM both_parts, moments, categories WHERE split = 'test'""",
        _ORDERED, _TRAIN, _PREPROCESSED,
    ),
)
def _preprocessed_features(spark, sf_dir):
    """Test rows through preprocessing learned from the training rows: scaled numbers, then 0/1 blocks."""
    train, test = parts(spark, sf_dir)
    fitted = Pipeline(stages=m.preprocessing_stages()).fit(train)
    vector = fitted.transform(test).select(KEY, TARGET, vector_to_array("features").alias("v"))
    # The fitted stages know how wide the numeric block is; the rest of the vector is 0/1 slots.
    width = len(fitted.stages[1].getInputCols())
    blocks = F.transform(
        F.slice("v", F.lit(width + 1), F.size("v") - width), lambda x: x.cast("int").cast("string"))
    return vector.select(
        KEY, TARGET, *[F.round(F.col("v")[i], 6).alias(f"z{i}") for i in range(width)],
        F.array_join(blocks, ",").alias("one_hot"),
    )


@register("cross_validation_folds")
def _cross_validation_folds(spark, sf_dir):
    folds, summary = comparison(spark, sf_dir)
    m.check_cv(folds, summary, m.candidate_models(), 5)
    return folds


@register("cross_validation_summary")
def _cross_validation_summary(spark, sf_dir):
    return comparison(spark, sf_dir)[1]


@register("random_search")
def _random_search(spark, sf_dir):
    return search(spark, sf_dir)


@register("best_candidate")
def _best_candidate(spark, sf_dir):
    return m.best_candidate(search(spark, sf_dir), comparison(spark, sf_dir)[1])


BAGGED = m.ModelSpec(
    "bagged_forest", "bagged", False,
    {"n_estimators": 300, "max_depth": 12, "min_samples_split": 20, "min_samples_leaf": 5, "class_weight": "balanced_subsample"})


@register("bagged_forest_scores")
def _bagged_forest_scores(spark, sf_dir):
    """Test rows scored by a forest with the settings that Spark's forest lacks."""
    train, test = parts(spark, sf_dir)
    prepared = Pipeline(stages=m.preprocessing_stages()).fit(train.select(*f.MODEL_FEATURES))
    ready = [materialize(prepared.transform(x).select(KEY, TARGET, "features"), "ready") for x in (train, test)]
    scored = m.score(m.fit_classifier(BAGGED, ready[0], TARGET, key=KEY), ready[1])
    return scored.select(F.col(KEY).alias("id"), F.col(TARGET).alias("label"), "score")


_BAG_TREES, _BAG_RATE = 40, 0.85
_MOD = f"{2**64}::HUGEINT"


def _hashed(value: str) -> str:
    """The forest's hash of a column, two multiplications modulo 2**64, as nested selects give it in SQL."""
    first, second = (f"{x}::HUGEINT" for x in fo._MIX)
    return f"""(SELECT xor(v2, v2 >> 32) FROM (SELECT xor(v1, v1 >> 29) * {second} % {_MOD} AS v2
               FROM (SELECT ({value}) * {first} % {_MOD} AS v1)))"""


@register(
    "bag_table",
    oracle(
        f"""SELECT tree, label, count(*) FILTER (times > 0) AS bagged, CAST(sum(times) AS BIGINT) AS draws,
                   CAST(sum(sum(times)) OVER (PARTITION BY tree) AS DOUBLE) / (2 * sum(times)) AS class_weight
        FROM drawn GROUP BY tree, label""",
        _ORDERED, _TRAIN,
        "hashed_rows AS (SELECT subscribed AS label, " + _hashed("campaign_record_id::HUGEINT") + " AS h FROM train)",
        "salts AS (SELECT * FROM (VALUES " + ", ".join(
            f"({t}::BIGINT, {((f.SEED * fo._ROW) ^ (t * fo._TREE)) % 2**64}::HUGEINT)" for t in range(_BAG_TREES)) + ") AS s(tree, salt))",
        "drawn AS (SELECT tree, label, len(list_filter([" + ", ".join(f"{c}::HUGEINT" for c in fo.poisson_cuts(_BAG_RATE))
        + "], lambda c: c <= draw)) AS times FROM (SELECT tree, label, " + _hashed("xor(h, salt)") + " >> 11 AS draw FROM hashed_rows, salts))",
    ),
)
def _bag_table(spark, sf_dir):
    """Bags of the first trees over the training rows, and the class weights they give."""
    return fo.bag_table(parts(spark, sf_dir)[0], KEY, TARGET, _BAG_TREES, _BAG_RATE, f.SEED)


@register("out_of_fold_scores")
def _out_of_fold_scores(spark, sf_dir):
    train = parts(spark, sf_dir)[0]
    return _once("oof", spark, sf_dir, lambda: m.out_of_fold_scores(FOREST, train, KEY, TARGET, parallelism=4))


_TRAIN_FOLDS = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY subscribed ORDER BY k, campaign_record_id) AS train_place,
         count(*) OVER (PARTITION BY subscribed) AS train_rows
  FROM divided WHERE split = 'train'
), folded AS (
  SELECT campaign_record_id, subscribed,
         CAST(CASE WHEN train_place - 1 < r * (q + 1) THEN (train_place - 1) // (q + 1)
                   ELSE r + (train_place - 1 - r * (q + 1)) // q END AS INTEGER) AS fold
  FROM (SELECT *, train_rows // 5 AS q, train_rows % 5 AS r FROM numbered)
)"""
PRIOR = m.ModelSpec("dummy_prior", "prior")


@register(
    "prior_out_of_fold_scores",
    oracle(
        """SELECT campaign_record_id AS id, subscribed AS label, fold + 1 AS fold,
                  round((sum(subscribed) OVER () - sum(subscribed) OVER (PARTITION BY fold))
                        / CAST(count(*) OVER () - count(*) OVER (PARTITION BY fold) AS DOUBLE), 8) AS score
        FROM folded""",
        _ORDERED, _TRAIN_FOLDS,
    ),
)
def _prior_out_of_fold_scores(spark, sf_dir):
    """Every training row scored with the positive rate of the other folds, through the whole fold machinery."""
    scored = m.out_of_fold_scores(PRIOR, parts(spark, sf_dir)[0], KEY, TARGET)
    return scored.withColumn("score", F.round("score", 8))


@register(
    "prior_cross_validation",
    oracle(
        """SELECT fold + 1 AS fold, 0.5::DOUBLE AS roc_auc, round(avg(subscribed), 8) AS average_precision,
                  0.0::DOUBLE + CASE WHEN rate >= 0.5 THEN 1 ELSE 0 END AS recall
        FROM (SELECT *, (sum(subscribed) OVER () - sum(subscribed) OVER (PARTITION BY fold))
                        / CAST(count(*) OVER () - count(*) OVER (PARTITION BY fold) AS DOUBLE) AS rate FROM folded)
        GROUP BY fold, rate""",
        _ORDERED, _TRAIN_FOLDS,
    ),
)
def _prior_cross_validation(spark, sf_dir):
    """Fold metrics of the prior: chance-level areas, and recall by the side of 0.5 that its rate lies on."""
    folds, _ = m.cross_validate(parts(spark, sf_dir)[0], [PRIOR], KEY, TARGET)
    return folds.select("fold", F.round("roc_auc", 8).alias("roc_auc"), F.round("average_precision", 8).alias(
        "average_precision"), "recall")


@register(
    "prior_reload_check",
    oracle(
        """SELECT campaign_record_id, round(rate, 8) AS original_score, round(rate, 8) AS reloaded_score
        FROM (SELECT campaign_record_id FROM divided WHERE split = 'test' ORDER BY campaign_record_id LIMIT 50),
             (SELECT avg(subscribed) AS rate FROM divided WHERE split = 'train')""",
        _ORDERED,
    ),
)
def _prior_reload_check(spark, sf_dir):
    """The prior fitted on all training rows, stored, read again and compared on the first test rows."""
    train, test = parts(spark, sf_dir)
    model, path = m.fit_final(PRIOR, train, TARGET, key=KEY), scratch_path(spark, "prior")
    m.save_model(model, path, 0.5, TARGET, spark)
    checked = m.check_reload(model, m.load_model(spark, path)[0], test, KEY)
    return checked.withColumns({c: F.round(c, 8) for c in ("original_score", "reloaded_score")})


@register(
    "prior_permutation_importance",
    oracle(
        "SELECT feature, 0.0::DOUBLE AS importance_mean, 0.0::DOUBLE AS importance_std, "
        "CAST(row_number() OVER (ORDER BY feature) AS INTEGER) AS importance_rank FROM (SELECT unnest(["
        + ", ".join(f"'{c}'" for c in f.MODEL_FEATURES) + "]) AS feature)"
    ),
)
def _prior_permutation_importance(spark, sf_dir):
    """A model that reads no feature: shuffling any of them changes nothing."""
    train, test = parts(spark, sf_dir)
    prior = m.fit_final(PRIOR, train, TARGET, key=KEY)
    out = m.permutation_importance(prior, test, KEY, TARGET)
    rounded = {c: F.round(c, 10) + F.lit(0.0) for c in ("importance_mean", "importance_std")}
    return out.withColumns(rounded).select("feature", "importance_mean", "importance_std", "importance_rank")


@register("threshold_selection")
def _threshold_selection(spark, sf_dir):
    """Out-of-fold scores, their curve, the chosen threshold, and both thresholds compared."""
    scores = materialize(_out_of_fold_scores(spark, sf_dir), "oof")
    default = e.threshold_metrics(scores, {"default": e.DEFAULT_THRESHOLD}).first()["f1"]
    chosen = e.select_threshold(materialize(e.threshold_curve(scores), "curve"), default).first()["threshold"]
    return e.threshold_metrics(scores, {"selected_max_f1": chosen, "default_0_50": e.DEFAULT_THRESHOLD})


@register("final_test_scores")
def _final_test_scores(spark, sf_dir):
    return test_scores(spark, sf_dir)


@register("final_test_metrics")
def _final_test_metrics(spark, sf_dir):
    return e.probability_metrics(test_scores(spark, sf_dir))


@register("final_test_lift")
def _final_test_lift(spark, sf_dir):
    return e.lift_table(materialize(test_scores(spark, sf_dir), "scores"))


@register("model_reload_check")
def _model_reload_check(spark, sf_dir):
    model, path = final_model(spark, sf_dir), scratch_path(spark, "model")
    m.save_model(model, path, 0.5, TARGET, spark)
    reloaded, _ = m.load_model(spark, path)
    return m.check_reload(model, reloaded, parts(spark, sf_dir)[1], KEY)


@register("permutation_importance")
def _permutation_importance(spark, sf_dir):
    return m.permutation_importance(final_model(spark, sf_dir), parts(spark, sf_dir)[1], KEY, TARGET)
