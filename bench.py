"""Time the headline queries: prints one JSON line.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. The campaign table is
derived first and timed on its own (`campaign_table`); the other queries then scan the stored copy.
Results are fully computed and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from campaignlake.plans.catalogue import QUERIES  # noqa: E402
from campaignlake.plans import model_queries  # noqa: E402
from campaignlake.operators import models  # noqa: E402
from campaignlake.session import build_session  # noqa: E402
from campaignlake.sources.campaign import KEY, TARGET, campaign  # noqa: E402

HEADLINE = [
    "campaign_table",
    # SQL reports
    "dataset_overview", "subscription_by_job", "subscription_by_education", "subscription_by_contact_type",
    "subscription_by_month", "subscription_by_previous_outcome", "average_balance_by_subscription",
    "conversion_by_age_group", "conversion_by_campaign_contacts", "job_performance_ranking", "scalable_segment_ranking",
    # Quality
    "missing_summary", "unknown_summary", "outlier_summary", "clean_table", "quality_overview", "schema_profile",
    # Segments and statistics
    "multi_segment_rates", "best_scalable_segments", "numeric_profile", "duration_deciles", "box_stats",
    "chi_square_tests", "mann_whitney_tests", "adjusted_p_values", "proportion_differences", "spearman_matrix",
    # Splits and evaluation
    "engineered_features", "stratified_split", "stratified_folds", "threshold_curve", "probability_metrics",
    "threshold_metrics", "roc_points", "targeting_lift",
    # Models
    "final_test_metrics",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def fit_times(spark, sf_dir: str) -> tuple[dict[str, float], dict[str, int]]:
    """Seconds to fit each candidate and to score a held-out fold, at full settings, and the row counts.

    Each kind of model is fitted once on few rows first, so that no fit pays for loading classes.
    """
    train, _ = model_queries.parts(spark, sf_dir)
    fold = models.prepared_folds(train, KEY, TARGET, 5, parallelism=5)[0]
    few, out = fold.train.limit(500).persist(), {}
    for spec in models.candidate_models({"n_estimators": 5, "max_depth": 3}):
        models.score(models.fit_classifier(spec, few, TARGET, key=KEY), few).agg({"score": "sum"}).collect()
    for spec in models.candidate_models():
        start = time.perf_counter()
        model = models.fit_classifier(spec, fold.train, TARGET, key=KEY)
        fitted = time.perf_counter()
        models.score(model, fold.test).agg({"score": "sum"}).collect()
        out[f"fit_{spec.name}"] = round(fitted - start, 3)
        out[f"score_{spec.name}"] = round(time.perf_counter() - fitted, 3)
    return out, {"fit": fold.train.count(), "score": fold.test.count()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy().count().collect()
    times, rows = {}, {}
    for name in HEADLINE:
        times[name] = run(QUERIES[name], spark, sf_dir)
        if name == "campaign_table":
            campaign(spark, sf_dir)
        print(f"{name}: {times[name]}", file=sys.stderr)
    if os.environ.get("BENCH_FITS", "1") != "0":
        fits, rows = fit_times(spark, sf_dir)
        times.update(fits)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows": rows,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
