import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from campaignlake.plans.registry import oracle
from campaignlake.plans.sql_reports import REPORTS, check_statements, run_report_suite
from campaignlake.session import shared_dir
from campaignlake.sources.campaign import COLUMNS, build_campaign, short_campaign
from tests.oracle import TABLES, check, connect


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, sf_dir):
    """The smallest tables with 40 % of all orders moved to one customer."""
    base = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        frame = pd.read_parquet(f"{sf_dir}/{name}.parquet")
        if name == "orders":
            rng = random.Random(1)
            frame["o_custkey"] = [1 if rng.random() < 0.4 else c for c in frame["o_custkey"]]
        frame.to_parquet(f"{base}/{name}.parquet", index=False)
    return str(base)


def test_history_of_a_customer_with_many_orders(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sql = oracle(f"SELECT {', '.join(COLUMNS)} FROM campaign")
        assert check(spark, connect(skewed), "campaign", build_campaign, sql, skewed) is None
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_campaign_ranges(spark, sf_dir):
    rows = short_campaign(spark, sf_dir)
    assert rows.where("pdays = -1 AND previous > 0").count() == 0
    assert rows.where("previous = 0 AND poutcome <> 'unknown'").count() == 0


def test_statement_names_are_checked():
    with pytest.raises(ValueError, match="Duplicate"):
        check_statements([("a", "SELECT 1"), ("a", "SELECT 2")], ["a"])
    with pytest.raises(ValueError, match="empty"):
        check_statements([("a", "  ")], ["a"])
    with pytest.raises(ValueError, match="no name"):
        check_statements([("", "SELECT 1")], [])
    with pytest.raises(ValueError, match="Missing"):
        check_statements([("a", "SELECT 1")], ["a", "b"])
    with pytest.raises(ValueError, match="Unexpected"):
        check_statements([("a", "SELECT 1"), ("c", "SELECT 1")], ["a"])


def test_suite_writes_reports_and_rejects_bad_ones(spark, sf_dir, tmp_path):
    from campaignlake.sources.campaign import campaign

    rows = campaign(spark, sf_dir)
    results = run_report_suite(rows, min_size=15, out_dir=str(tmp_path))
    assert set(results) == set(REPORTS)
    saved = spark.read.option("header", True).csv(f"{tmp_path}/subscription_by_job")
    assert saved.count() == results["subscription_by_job"].count()
    with pytest.raises(ValueError, match="has_rows"):
        run_report_suite(rows, {"a": "SELECT 1 AS x FROM {campaign} WHERE false"}, ["a"])
    with pytest.raises(ValueError, match="covers_all_clients"):
        run_report_suite(rows, {"a": "SELECT count(*) AS client_count FROM {campaign} WHERE age > 50"}, ["a"], ["a"])
    with pytest.raises(ValueError, match="rate_in_0_100"):
        run_report_suite(rows, {"a": "SELECT 101.0D AS subscription_rate FROM {campaign}"}, ["a"])


def test_segment_ranking_reads_the_table_once(spark, sf_dir):
    from campaignlake.plans.sql_reports import run_report
    from campaignlake.sources.campaign import campaign

    plan = run_report(campaign(spark, sf_dir), "scalable_segment_ranking")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("changed", [False, True])
def test_reports_from_one_scan_equal_the_statements(spark, sf_dir, changed):
    from campaignlake.plans.sql_reports import report_cells, report_from_cells, run_report
    from campaignlake.session import materialize
    from campaignlake.sources.campaign import campaign

    rows = campaign(spark, sf_dir)
    if changed:  # missing segments form segments of their own
        rows = materialize(rows.withColumns({c: F.when(F.col("campaign_record_id") % 5 != 0, F.col(c)) for c in (
            "job", "contact", "education", "age", "balance")}), "changed")
    cells = report_cells(rows)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    cells = materialize(cells, "cells")
    for name in REPORTS:
        for size in (None, 15):
            direct, projected = run_report(rows, name, size), report_from_cells(cells, name, size)
            assert direct.dtypes == projected.dtypes, name
            assert sorted(map(repr, direct.collect())) == sorted(map(repr, projected.collect())), name


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    else:
        assert shared_dir(spark)
    assert spark.range(3).select(F.col("id")).count() == 3
