"""Preprocessing, candidate models, cross-validation, search, scoring and importance."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlake.functions.numbers import fail_rows
from campaignlake.operators.evaluation import average_precision, probability_metrics, threshold_metrics
from campaignlake.operators.features import CATEGORICAL_FEATURES, MODEL_FEATURES, NUMERIC_FEATURES, SEED, stratified_folds
from campaignlake.operators.forest import StoredTrees, fit_forest
from campaignlake.operators.quality import Rule, require_rules
from campaignlake.operators.scan import hash_key, ordered_scan, quantiles
from campaignlake.operators.tuning import search_scores, tree_params
from campaignlake.session import materialize, scratch_path
from campaignlake.sources.files import read_metadata, write_metadata

METRICS = ["roc_auc", "average_precision", "balanced_accuracy", "precision", "recall", "f1"]

# Settings of the untuned forest and the search space.
FOREST = {"n_estimators": 250, "max_depth": 12, "min_samples_leaf": 5, "max_features": "sqrt"}
SEARCH_SPACE = {
    "n_estimators": [200, 300, 450, 600],
    "max_depth": [8, 10, 12, 16, 20, None],
    "min_samples_split": [2, 5, 10, 20],
    "min_samples_leaf": [1, 2, 5, 10, 20],
    "max_features": ["sqrt", "log2", 0.5],
    "class_weight": ["balanced", "balanced_subsample"],
    "max_samples": [None, 0.70, 0.85],
}
DEEPEST_TREE = 30  # limit of Spark's trees; stands for "no limit"
# A fit lays its rows out in partitions of FIT_ROWS, in FIT_SPREAD partitions once these do not do, and in more
# only when one would hold over FIT_MOST_ROWS.
FIT_ROWS, FIT_SPREAD, FIT_MOST_ROWS = 8192, 24, 1 << 19
# Partitions per core of rows that are each scored many times.
SPREAD = 4
# Bytes of node ids, 4 per row and tree, that a fit keeps on the executors.
NODE_ID_BYTES = 8 << 30


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Fills:
    """What filling learned from a set of rows: medians, modes, and columns that had nulls."""

    medians: Mapping[str, float]
    modes: Mapping[str, str]
    indicators: Sequence[str]


def learn_fills(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], parts: Mapping[object, Column]
) -> dict[object, Fills]:
    """Fills for several subsets of rows, each given by a predicate, from one count of values.

    The training rows of all folds share their scans this way. Medians are exact and interpolated;
    modes ignore nulls and take the smallest value on ties.
    """
    weights = [f"w{i}" for i in range(len(parts))]
    flags = [condition.alias(w) for condition, w in zip(parts.values(), weights)]
    counted = [F.count_if(w).alias(w) for w in weights]

    def counts(columns: Sequence[str], dtype: str) -> DataFrame:
        wide = df.select(*flags, *[F.col(c).cast(dtype).alias(c) for c in columns])
        long = wide.unpivot(weights, list(columns), "feature", "value").where(F.col("value").isNotNull())
        return long.groupBy("feature", "value").agg(*counted)

    scanned = ordered_scan(counts(numeric, "double"), ["value"], ["feature"], sums=weights, totals=True, few_groups=True)
    medians = quantiles(scanned, {f"m_{w}": (w, 0.5) for w in weights}).collect()
    modes = []
    if categorical:
        first = [F.min(F.when(F.col(w) > 0, F.struct((-F.col(w)).alias("n"), "value"))).alias(w) for w in weights]
        modes = counts(categorical, "string").groupBy("feature").agg(*first).collect()
    rows = df.select(*flags).agg(*counted).first()
    return {
        part: Fills(
            {r["feature"]: r[f"m_{w}"] for r in medians},
            {r["feature"]: r[w]["value"] for r in modes if r[w] is not None},
            [c for c in numeric if sum(r[f"total_{w}"] for r in medians if r["feature"] == c) < rows[w]],
        )
        for part, w in zip(parts, weights)
    }


class FillMissing(Estimator):
    """Median and mode fills; fits to a SQLTransformer, which pipelines can save.

    Adds `<c>_filled` per column, and `<c>_missing` (0/1) for numeric columns with nulls at fit.
    Given `fills`, it uses those instead of learning from the rows it is fitted on.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], fills: Fills | None = None):
        super().__init__()
        self.numeric, self.categorical, self.fills = list(numeric), list(categorical), fills

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        if self.fills is None:
            self.fills = learn_fills(dataset, self.numeric, self.categorical, {"all": F.lit(True)})["all"]
        f = self.fills
        parts = [f"coalesce(cast(`{c}` as double), {(f.medians.get(c) or 0.0)!r}D) AS `{c}_filled`" for c in self.numeric]
        parts += [f"cast(`{c}` IS NULL AS double) AS `{c}_missing`" for c in f.indicators]
        parts += [f"coalesce(`{c}`, {_sql_text(f.modes.get(c, ''))}) AS `{c}_filled`" for c in self.categorical]
        return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


class NumericAssembler(Estimator):
    """Assembles filled numeric columns and the indicators a fitted `FillMissing` decided on."""

    def __init__(self, fill: FillMissing, out: str):
        super().__init__()
        self.fill, self.out = fill, out

    def _fit(self, dataset: DataFrame) -> VectorAssembler:
        columns = [f"{c}_filled" for c in self.fill.numeric] + [f"{c}_missing" for c in self.fill.fills.indicators]
        return VectorAssembler(inputCols=columns, outputCol=self.out)


def preprocessing_stages(
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
    fills: Fills | None = None,
) -> list:
    """Median fill, missing indicator and standardising; mode fill and one-hot.

    Everything is learned from the rows the pipeline is fitted on. A category not seen there gives
    an all-zero block: the indexer keeps an extra slot for it and the encoder drops that slot.
    """
    fill = FillMissing(numeric, categorical, fills)
    indexed = [f"{c}_index" for c in categorical]
    encoded = [f"{c}_onehot" for c in categorical]
    return [
        fill,
        NumericAssembler(fill, "numeric_raw"),
        StandardScaler(inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True, withStd=True),
        StringIndexer(
            inputCols=[f"{c}_filled" for c in categorical], outputCols=indexed, handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=["numeric_scaled", *encoded], outputCol="features"),
    ]


def preprocessing_contract(spark) -> DataFrame:
    """Two documented rows: what happens to numeric and to categorical features."""
    rows = [
        ("numerical", ", ".join(NUMERIC_FEATURES), "exact median of the fitted rows",
         "centred and divided by the deviation of the fitted rows",
         "columns with nulls among the fitted rows get a 0/1 column beside them"),
        ("categorical", ", ".join(CATEGORICAL_FEATURES), "most frequent value of the fitted rows, smallest on ties",
         "one 0/1 slot per value of the fitted rows, in alphabetical order",
         "a value that was not fitted has zeros in all slots"),
    ]
    return spark.createDataFrame(
        rows, "feature_group string, features string, missing_value_strategy string, encoding_or_scaling string, notes string"
    )


@dataclass(frozen=True)
class ModelSpec:
    """A candidate: `prior`, `logistic`, `forest` or `bagged`, with parameters by their usual names.

    `forest` is Spark's, `bagged` that of `operators.forest`, which also knows `min_samples_split` and
    `class_weight`.
    """

    name: str
    kind: str
    balanced: bool = False
    params: Mapping = field(default_factory=dict)


def candidate_models(forest: Mapping = FOREST) -> list[ModelSpec]:
    return [
        ModelSpec("dummy_prior", "prior"),
        ModelSpec("logistic_regression", "logistic", False, {"C": 1.0}),
        ModelSpec("logistic_regression_balanced", "logistic", True, {"C": 1.0}),
        ModelSpec("random_forest_balanced", "forest", True, forest),
    ]


def class_weights(df: DataFrame, target: str) -> tuple[int, dict[int, float]]:
    """Row count and the balanced weight n / (2 * n_class) of each class."""
    counts = {r[target]: r["count"] for r in df.groupBy(target).count().collect()}
    if set(counts) != {0, 1}:
        raise ValueError("The target must contain both 0 and 1.")
    n = sum(counts.values())
    return n, {c: n / (2 * k) for c, k in counts.items()}


def fit_partitions(n: int) -> int:
    """Partitions of a fit on `n` rows.

    Each one sends the statistics of all nodes of a pass, whatever rows it holds, so what a forest shuffles is
    the number of partitions times the size of its trees: it must not grow like the rows.
    """
    return max(1, min(FIT_SPREAD, -(-n // FIT_ROWS)), -(-n // FIT_MOST_ROWS))


def fit_layout(rows: DataFrame, n: int, key: str | None) -> DataFrame:
    """`rows` placed by a hash of the key, in order, in a number of partitions that follows from `n` alone.

    Spark draws a forest's samples by partition and sums gradients by partition, so this makes a fit
    independent of how files were split and how many cores there are. Without a key, the feature
    values stand in for it; equal rows are interchangeable.
    """
    place = F.col(key) if key else F.xxhash64(vector_to_array("features"), "label")
    laid = rows.withColumn("_place", place)
    return laid.repartition(fit_partitions(n), F.xxhash64("_place")).sortWithinPartitions("_place").drop("_place")


def fit_classifier(
    spec: ModelSpec, train: DataFrame, target: str, seed: int = SEED, key: str | None = None,
    cache_node_ids: bool | None = None, max_memory_mb: int = 1024,
):
    """Fit one candidate on a frame with `features` and the target; returns a Spark ML model.

    `C` becomes regParam = 1 / (C * n). A forest without depth limit gets Spark's deepest tree.
    `cache_node_ids` saves walking the trees again in each pass and takes 4 bytes per row and tree of
    executor memory, up to three times over; by default it is done up to NODE_ID_BYTES. They are never copied to
    the shared folder. It does not change the result. `max_memory_mb` bounds the split statistics of one pass, so
    more means fewer passes. For the row layout see `fit_layout`.
    """
    n, weights = class_weights(train, target)
    if spec.kind == "prior":
        share = weights_to_rate(weights)
        return SQLTransformer(statement=f"SELECT *, {share!r}D AS score FROM __THIS__")
    weight = F.when(F.col(target) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0])) if spec.balanced else F.lit(1.0)
    if spec.kind == "bagged":
        if not key:
            raise ValueError("Bags follow from the rows' key, which is missing.")
        p = dict(spec.params)
        return fit_forest(train, key, target, p.get("n_estimators", 100), tree_params(
            {"class_weight": "balanced" if spec.balanced else None, **p}), seed)
    carried = [key] if key else []
    rows = fit_layout(
        train.select("features", F.col(target).cast("double").alias("label"), weight.alias("class_weight"), *carried),
        n, key,
    )
    p = dict(spec.params)
    if spec.kind == "logistic":
        estimator = LogisticRegression(
            regParam=1.0 / (p.get("C", 1.0) * n), elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-5,
            weightCol="class_weight",
        )
    elif spec.kind == "forest":
        strategy, trees = p.get("max_features", "sqrt"), p.get("n_estimators", 100)
        if cache_node_ids is None:
            cache_node_ids = 4 * n * trees <= NODE_ID_BYTES
        estimator = RandomForestClassifier(
            numTrees=trees,
            maxDepth=DEEPEST_TREE if p.get("max_depth") is None else p["max_depth"],
            minInstancesPerNode=p.get("min_samples_leaf", 1),
            featureSubsetStrategy=strategy if isinstance(strategy, str) else str(strategy),
            subsamplingRate=p.get("max_samples") or 1.0,
            weightCol="class_weight",
            seed=seed,
            maxMemoryInMB=max_memory_mb,
            cacheNodeIds=cache_node_ids,
            checkpointInterval=-1,
        )
    else:
        raise ValueError(f"unknown model kind {spec.kind!r}")
    return estimator.fit(rows)


def weights_to_rate(weights: Mapping[int, float]) -> float:
    """Positive rate implied by balanced weights: 1 / (2 * w1)."""
    return 1.0 / (2.0 * weights[1])


def score(model, df: DataFrame) -> DataFrame:
    """Add `score`, the probability of class 1, and drop the model's own columns."""
    out = model.transform(df)
    if "score" not in out.columns:
        out = out.withColumn("score", vector_to_array("probability")[1])
    return out.select(*df.columns, "score")


def scorer(model) -> Callable[[DataFrame], DataFrame]:
    """`score` under a model for many rows at a time, with the same scores.

    Spark's forest takes each row down all trees, whose nodes no cache holds; here a batch of rows goes down one tree
    after the other.
    """
    *before, last = model.stages if isinstance(model, PipelineModel) else [model]
    trees = StoredTrees.of(last) if isinstance(last, RandomForestClassificationModel) else None
    if trees is None:
        return lambda df: score(model, df)
    prepared = PipelineModel(stages=before)
    return lambda df: prepared.transform(df).withColumn(
        "score", trees.column(df.sparkSession, last.getFeaturesCol())).select(*df.columns, "score")


def fit_final(
    spec: ModelSpec, train: DataFrame, target: str, seed: int = SEED, key: str | None = None
) -> PipelineModel:
    """Preprocessing and classifier fitted on all training rows, as one saveable pipeline."""
    prepared = Pipeline(stages=preprocessing_stages()).fit(train.select(*MODEL_FEATURES))
    kept = [key, target] if key else [target]
    ready = materialize(prepared.transform(train.select(*kept, *MODEL_FEATURES)).select(*kept, "features"), "ready")
    return PipelineModel(stages=[*prepared.stages, fit_classifier(spec, ready, target, seed, key)])


@dataclass(frozen=True)
class Fold:
    number: int
    train: DataFrame
    test: DataFrame


def _in_parallel(run, tasks: Sequence, parallelism: int) -> list:
    """Results of `run` per task; up to `parallelism` tasks submit their Spark jobs side by side."""
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return list(pool.map(run, tasks))


def prepared_folds(
    df: DataFrame, key: str, target: str, k: int = 5, seed: int = SEED, parallelism: int = 1
) -> list[Fold]:
    """Preprocess every fold once, on its own training rows, for use by all candidates.

    `df` holds the key, the target and the model features. Both parts are stored tables of
    (key, target, features), so fits neither repeat the preprocessing nor depend on cached blocks.
    """
    tagged = materialize(stratified_folds(df.select(key, target, *MODEL_FEATURES), key, target, k, seed), "folds")
    training = {number: F.col("fold") != number for number in range(k)}
    fills = learn_fills(tagged, NUMERIC_FEATURES, CATEGORICAL_FEATURES, training)

    def prepare(number: int) -> Fold:
        train, test = tagged.where(training[number]), tagged.where(F.col("fold") == number)
        prepared = Pipeline(stages=preprocessing_stages(fills=fills[number])).fit(train)
        ready = [
            materialize(prepared.transform(part).select(key, target, "features"), "ready") for part in (train, test)
        ]
        return Fold(number, *ready)

    return _in_parallel(prepare, range(k), parallelism)


def fold_scores(
    specs: Sequence[ModelSpec], folds: Sequence[Fold], key: str, target: str, seed: int = SEED, parallelism: int = 1
) -> tuple[DataFrame, list[tuple[str, int, float, float]]]:
    """Fit every candidate on every fold and score the fold's held-out rows.

    Gives one stored table (model, fold, id, label, score), partitioned by model and fold, and
    (model, fold, fit, score) seconds. With `parallelism`, that many fits run at a time.
    """
    spark = folds[0].train.sparkSession
    base = scratch_path(spark, "fold_scores")

    def run(task):
        spec, fold = task
        start = time.perf_counter()
        model = fit_classifier(spec, fold.train, target, seed, key)
        fitted = time.perf_counter()
        rows = score(model, fold.test).select(
            F.col(key).alias("id"), F.col(target).cast("int").alias("label"), "score"
        )
        rows.write.parquet(f"{base}/model={spec.name}/fold={fold.number + 1}")
        return spec.name, fold.number + 1, fitted - start, time.perf_counter() - fitted

    timings = _in_parallel(run, [(spec, fold) for spec in specs for fold in folds], parallelism)
    id_type = folds[0].train.schema[key].dataType.simpleString()
    schema = f"id {id_type}, label int, score double, model string, fold int"
    return spark.read.schema(schema).parquet(base), timings


def fold_metrics(scored: DataFrame, timings: Sequence[tuple[str, int, float, float]]) -> DataFrame:
    """The six metrics and both times per (model, fold), all groups evaluated in one job."""
    by = ["model", "fold"]
    areas = probability_metrics(scored, by).select(*by, "roc_auc", "average_precision")
    cuts = threshold_metrics(scored, {"default": 0.5}, by).select(*by, "balanced_accuracy", "precision", "recall", "f1")
    times = scored.sparkSession.createDataFrame(
        list(timings), "model string, fold int, fit_time_seconds double, score_time_seconds double"
    )
    joined = areas.join(cuts, by).join(F.broadcast(times), by)
    return joined.select(*by, *METRICS, "fit_time_seconds", "score_time_seconds")


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and sample deviation per model over its folds, best average precision first."""
    aggregates = []
    for m in METRICS:
        aggregates += [F.avg(m).alias(f"mean_{m}"), F.stddev_samp(m).alias(f"std_{m}")]
    times = [F.avg(c).alias(f"mean_{c}") for c in ("fit_time_seconds", "score_time_seconds")]
    summary = folds.groupBy("model").agg(*aggregates, *times)
    return summary.orderBy(F.desc("mean_average_precision"), F.desc("mean_roc_auc"), "model")


def cross_validate(
    df: DataFrame, specs: Sequence[ModelSpec], key: str, target: str, k: int = 5, seed: int = SEED, parallelism: int = 1
) -> tuple[DataFrame, DataFrame]:
    """(fold results, summary) of all candidates on the same folds."""
    scored, timings = fold_scores(specs, prepared_folds(df, key, target, k, seed, parallelism), key, target, seed, parallelism)
    folds = materialize(fold_metrics(scored, timings), "fold_metrics")
    return folds, cv_summary(folds)


def check_cv(folds: DataFrame, summary: DataFrame, specs: Sequence[ModelSpec], k: int, beat_prior: bool = False) -> None:
    """Post-conditions of a comparison; beating the prior is asked for only where signal exists."""
    names = [s.name for s in specs]
    rules = [Rule("expected_rows", kind="rows", low=len(names) * k, high=len(names) * k)]
    rules += [Rule(f"{m}_in_0_1", F.col(m).between(0, 1), nulls_fail=True) for m in METRICS]
    rules.append(Rule("expected_models", F.col("model").isin(names)))
    is_prior = F.col("model") == "dummy_prior"
    rules.append(Rule("prior_auc_is_half", ~is_prior | (F.abs(F.col("roc_auc") - 0.5) <= 1e-9)))
    require_rules(folds, rules, "the fold results")
    if beat_prior:
        def better(metric: str) -> Column:
            prior = F.max(F.when(is_prior, F.col(metric)))
            return F.min(F.when(~is_prior, F.col(metric))) > prior

        require_rules(
            summary,
            [Rule(f"candidates_beat_prior_{m}", better(f"mean_{m}"), kind="total") for m in ("average_precision", "roc_auc")],
            "the comparison",
        )


def draw_candidates(space: Mapping[str, Sequence] = SEARCH_SPACE, n: int = 16, seed: int = SEED) -> list[dict]:
    """n different parameter settings of the grid, drawn with a seed."""
    size = math.prod(len(v) for v in space.values())
    draws = []
    for number in random.Random(seed).sample(range(size), n):
        setting = {}
        for name, values in space.items():
            number, place = divmod(number, len(values))
            setting[name] = values[place]
        draws.append(setting)
    return draws


def random_search(
    df: DataFrame,
    key: str,
    target: str,
    space: Mapping[str, Sequence] = SEARCH_SPACE,
    n: int = 16,
    k: int = 5,
    seed: int = SEED,
    parallelism: int = 1,
    journal: str | None = None,
) -> DataFrame:
    """Cross-validate drawn forests; parameters, ranks, means and population deviations.

    All candidates share the prepared folds, and those that differ in size or depth alone share trees. Rank 1
    has the best mean average precision. Scores of finished candidates and folds stay in `journal`, by default
    a place in the shared folder that follows from the search and the rows, and are not computed again there.
    """
    settings = draw_candidates(space, n, seed)
    specs = [ModelSpec(f"candidate_{i:03d}", "bagged", True, s) for i, s in enumerate(settings)]
    folds = prepared_folds(df, key, target, k, seed, parallelism)
    scored, timings = search_scores(folds, {s.name: s.params for s in specs}, key, target, seed, parallelism, journal)
    folds = materialize(fold_metrics(scored, timings), "fold_metrics")
    aggregates = []
    for m in METRICS:
        aggregates += [F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}")]
    times = [F.avg("fit_time_seconds").alias("mean_fit_time"), F.stddev_pop("fit_time_seconds").alias("std_fit_time")]
    summary = folds.groupBy("model").agg(*aggregates, *times)
    names = list(space)
    table = df.sparkSession.createDataFrame(
        [(s.name, *[None if s.params[p] is None else str(s.params[p]) for p in names]) for s in specs],
        "model string, " + ", ".join(f"param_{p} string" for p in names),
    )
    # One row per drawn candidate.
    rank = F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("mean_average_precision")))
    ranked = table.join(summary, "model").withColumn("rank_average_precision", rank)
    return ranked.orderBy("rank_average_precision", "model")


def best_candidate(results: DataFrame, comparison: DataFrame, baseline: str = "random_forest_balanced") -> DataFrame:
    """One row: the winner's metrics beside those of the untuned model, which must occur once."""
    require_rules(
        comparison,
        [Rule("one_baseline", F.count_if(F.col("model") == baseline) == 1, kind="total")],
        "the model comparison",
    )
    untuned = comparison.where(F.col("model") == baseline).select("mean_average_precision").scalar()
    best = results.orderBy("rank_average_precision", "model").limit(1)
    joined = best.withColumn("baseline_average_precision", untuned)
    return joined.select(
        F.lit("average_precision").alias("selection_metric"),
        "model",
        *[c for c in best.columns if c.startswith("param_")],
        F.col("mean_average_precision").alias("best_average_precision"),
        F.col("std_average_precision"),
        *[c for c in best.columns if c.startswith("mean_") and c not in ("mean_average_precision", "mean_fit_time")],
        "baseline_average_precision",
        (F.col("mean_average_precision") - F.col("baseline_average_precision")).alias("difference"),
    )


def out_of_fold_scores(
    spec: ModelSpec, df: DataFrame, key: str, target: str, k: int = 5, seed: int = SEED, parallelism: int = 1
) -> DataFrame:
    """(id, label, fold, score): each row scored by the model that did not see its fold."""
    scored, _ = fold_scores([spec], prepared_folds(df, key, target, k, seed, parallelism), key, target, seed, parallelism)
    rules = [
        Rule("score_in_0_1", F.col("score").between(0, 1) & ~F.isnan("score"), nulls_fail=True),
        Rule("one_score_per_row", F.count(F.lit(1)) == F.count_distinct("id"), kind="total"),
        Rule("every_row_scored", kind="rows", low=(rows := df.count()), high=rows),
    ]
    require_rules(scored, rules, "the out-of-fold scores")
    return scored.select("id", "label", "fold", "score")


def save_model(model: PipelineModel, path: str, threshold: float, target: str, spark) -> None:
    """Persist the pipeline, and next to it the threshold and the prediction contract as JSON."""
    model.write().overwrite().save(f"{path}/pipeline")
    record = spark.range(1).select(
        F.lit(float(threshold)).alias("threshold"),
        F.array(*[F.lit(c) for c in MODEL_FEATURES]).alias("model_features"),
        F.lit(target).alias("target_column"),
        F.lit(1).alias("positive_class"),
        F.lit("Scores order clients before the campaign contacts any of them.").alias("prediction_contract"),
        F.lit(False).alias("test_set_used"),
    )
    write_metadata(record, f"{path}/contract")


def load_model(spark, path: str) -> tuple[PipelineModel, float]:
    """The stored pipeline and its threshold; an incomplete contract is an error."""
    schema = (
        "threshold double, model_features array<string>, target_column string, positive_class int, "
        "prediction_contract string, test_set_used boolean"
    )
    record = read_metadata(
        spark, f"{path}/contract", schema, ["threshold", "model_features", "target_column"], "threshold"
    ).first()
    return PipelineModel.load(f"{path}/pipeline"), record["threshold"]


def check_reload(model, reloaded, df: DataFrame, key: str, rows: int = 50, tolerance: float = 1e-12) -> DataFrame:
    """Scores of the first rows by key under both models; a difference fails the job."""
    sample = df.orderBy(key).limit(rows)
    before = score(model, sample).select(key, F.col("score").alias("original_score"))
    after = score(reloaded, sample).select(key, F.col("score").alias("reloaded_score"))
    apart = F.abs(F.col("original_score") - F.col("reloaded_score")) > tolerance * (1 + F.abs("reloaded_score"))
    return fail_rows(before.join(after, key), apart, "The stored model scores differently from the fitted one.")


def shuffled_donors(df: DataFrame, key: str, columns: Sequence[str], repeats: int, seed: int = SEED) -> DataFrame:
    """Pair every row with a donor row, `repeats` times, each time by a random permutation.

    Adds `repeat` and `donor`, a struct of the donor's columns. A permutation matches positions
    of two seeded orders of the unique key; all orders come from one ordered scan, and the match is
    an equi-join on unique positions.
    """
    orders = F.explode(F.sequence(F.lit(0), F.lit(repeats)))
    keyed = df.withColumn("repeat", orders)
    order_key = F.lit(None).cast("long")
    for r in range(repeats + 1):
        order_key = F.when(F.col("repeat") == r, hash_key(F.col(key), seed + r)).otherwise(order_key)
    keyed = keyed.withColumn("_order", order_key).withColumn("_one", F.lit(1).cast("long"))
    placed = ordered_scan(keyed, ["_order", key], ["repeat"], sums=["_one"])
    base = placed.where(F.col("repeat") == 0).select(*df.columns, F.col("cum__one").alias("_place"))
    donors = placed.where(F.col("repeat") > 0).select(
        "repeat", F.struct(*columns).alias("donor"), F.col("cum__one").alias("_place")
    )
    return base.join(donors, "_place").drop("_place")


def permutation_importance(
    model,
    df: DataFrame,
    key: str,
    target: str,
    features: Sequence[str] = tuple(MODEL_FEATURES),
    repeats: int = 10,
    seed: int = SEED,
) -> DataFrame:
    """Mean and population deviation of the drop in average precision when a feature is shuffled.

    One permutation per repeat serves all features: each feature in turn takes the donor's value, and what the
    model does not read is not made.
    All (feature, repeat) pairs are scored in one pass and evaluated as groups of one job; rows are
    counted per score before anything is shuffled. `df` holds key, target and the features.
    """
    rows, scored_by = df.select(key, target, *features), scorer(model)
    base = average_precision(
        scored_by(rows).select(F.col(key).alias("id"), F.col(target).alias("label"), "score")
    ).first()["average_precision"]
    paired = shuffled_donors(rows, key, features, repeats, seed)
    # Few bytes but much work: the join's partitions would be put together into fewer than there are cores.
    spread = paired.repartition(SPREAD * df.sparkSession.sparkContext.defaultParallelism, key, "repeat")
    variants = spread.withColumn("_feature", F.explode(F.array(*[F.lit(f) for f in features])))
    exploded = variants.select(
        key, target, "repeat", "_feature",
        *[F.when(F.col("_feature") == c, F.col("donor")[c]).otherwise(F.col(c)).alias(c) for c in features],
    )
    scored = scored_by(exploded).select(
        F.col("_feature").alias("feature"), "repeat", F.col(key).alias("id"), F.col(target).alias("label"), "score"
    )
    drops = average_precision(scored, ["feature", "repeat"]).withColumn("drop", F.lit(base) - F.col("average_precision"))
    out = drops.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
    # One row per feature.
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("importance_mean"), "feature"))
    return (
        out.withColumn("absolute_importance_mean", F.abs("importance_mean"))
        .withColumn("importance_rank", rank)
        .orderBy("importance_rank")
    )
