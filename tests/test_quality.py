import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from campaignlake.operators import quality as q
from campaignlake.sources import files

COLUMNS = ("age int, job string, marital string, education string, default string, balance string, housing string, "
           "loan string, contact string, day int, month string, duration int, campaign int, pdays int, previous int, "
           "poutcome string, y string")


def _raw(spark, changes=()):
    base = dict(age=30, job=" Admin. ", marital="single", education="tertiary", default="no", balance="-5", housing="yes",
                loan="no", contact="cellular", day=5, month="May", duration=100, campaign=1, pdays=-1, previous=0,
                poutcome="unknown", y="no")
    rows = [base, {**base, "job": "admin.\t"}, {**base, "y": "YES", "age": 40}]
    rows += [{**base, **c} for c in changes]
    return spark.createDataFrame([tuple(r.values()) for r in rows], COLUMNS)


def test_clean_normalises_and_drops_duplicates(spark):
    out = q.clean(_raw(spark))
    assert out.columns == [*q.RAW_COLUMNS[:-1], "subscribed"]
    rows = {(r["age"], r["job"], r["month"], r["balance"], r["subscribed"]) for r in out.collect()}
    assert rows == {(30, "admin.", "may", -5, 0), (40, "admin.", "may", -5, 1)}


def test_clean_reports_every_broken_range(spark):
    with pytest.raises(ValueError, match="age_positive.*day_in_month.*campaign_at_least_one"):
        q.clean(_raw(spark, [dict(age=0, day=32, campaign=0)]))


def test_clean_rejects_schema_and_domain(spark):
    with pytest.raises(ValueError, match="Missing columns: \\['y'\\]"):
        q.clean(_raw(spark).drop("y"))
    with pytest.raises(ValueError, match="maybe \\(unexpected\\)"):
        q.clean(_raw(spark, [dict(y="maybe")]))


def test_unparseable_number_raises_or_becomes_null(spark):
    df = _raw(spark, [dict(balance="n/a")])
    with pytest.raises(PySparkException):
        q.to_numeric(df, ["balance"]).collect()
    assert q.to_numeric(df, ["balance"], "coerce").where(F.col("balance").isNull()).count() == 1
    with pytest.raises(ValueError):
        q.to_numeric(df, ["balance"], "ignore")


def test_encode_target_fails_on_unmapped_value(spark):
    df = spark.createDataFrame([("yes",), (None,)], "y string")
    with pytest.raises(PySparkException, match="unmapped"):
        q.encode_target(df, "y").collect()


@pytest.mark.parametrize("most", [None, 0])
def test_repeated_rows_by_digest(spark, monkeypatch, most):
    """Nulls in other places, signed zeros, clashing digests, a hot row; with and without room to broadcast."""
    if most is not None:
        monkeypatch.setattr(q, "BROADCAST_BYTES", most)
    rows = [(None, 1, 0.0), (1, None, 0.0), (1, 1, -0.0), (1, 1, 0.0), (None, None, None)] * 2 + [(5, 6, 7.5)] * 400
    rows += [(i, -i, float("nan")) for i in range(50)] + [(3, -3, float("nan"))]
    df = spark.createDataFrame(rows, "a int, b int, c double").repartition(4)
    found = q.drop_repeated_rows(df)
    assert found.columns == df.columns
    plain = [repr(r).replace("-0.0", "0.0") for r in df.dropDuplicates().collect()]
    assert sorted(repr(r).replace("-0.0", "0.0") for r in found.collect()) == sorted(plain) and len(plain) == 55
    assert q.drop_repeated_rows(df.where("false")).count() == 0
    with monkeypatch.context() as m:  # digests that say nothing: rows are still compared by value
        m.setattr(q, "_row_digest", lambda _: [F.lit(1).alias("_h"), F.lit(2).alias("_g")])
        assert sorted(repr(r).replace("-0.0", "0.0") for r in q.drop_repeated_rows(df).collect()) == sorted(plain)


def test_outliers_of_a_constant_column(spark):
    df = spark.createDataFrame([(5,)] * 10 + [(6,)], "v int")
    row = q.outlier_summary(df, ["v"]).first()
    assert (row["q1"], row["iqr"], row["lower_bound"], row["upper_bound"]) == (5.0, 0.0, 5.0, 5.0)
    assert row["potential_outlier_count"] == 1
    assert row["potential_outlier_percentage"] == 9.09


def test_missing_summary_rounds_half_to_even(spark):
    df = spark.createDataFrame([(None,)] + [(1,)] * 799, "v int")
    assert q.missing_summary(df).first()["missing_percentage"] == 0.12


def test_counts_and_reconcile(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (2, None)], "id int, y int")
    assert q.count_profile(df, "y", "id").first().asDict() == dict(
        row_count=3, positives=1, negatives=1, null_targets=1, duplicate_keys=1)
    with pytest.raises(ValueError, match="positives: 1 instead of 2"):
        q.check_counts(df, "y", {"positives": 2})
    left = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0), ("c", 3, None)], "k string, n int, r double")
    right = spark.createDataFrame([("b", 2, 2.5), ("a", 1, 1.0 + 1e-12), ("d", 9, 1.0)], "k string, n long, r double")
    found = {(r["k"], r["column"]) for r in q.reconcile(left, right, ["k"], 1e-9).collect()}
    assert found == {("b", "r"), ("c", "<row>"), ("d", "<row>")}


def test_rule_kinds(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-2.0,)], "v double")
    found = {r["rule"]: r["violations"] for r in q.rule_violations(df, [
        q.Rule("positive", F.col("v") > 0), q.Rule("known", F.col("v") > -9, nulls_fail=True),
        q.Rule("sum", F.sum("v") == -1.0, kind="total"), q.Rule("size", kind="rows", low=1, high=2),
    ]).collect()}
    assert found == {"positive": 1, "known": 1, "sum": 0, "size": 1}


def test_files_round_trip_and_errors(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n int")
    files.write_report(df, f"{tmp_path}/one")
    loaded = files.load_report_set(spark, {"one": f"{tmp_path}/one"}, {"one": df.schema})["one"]
    assert sorted(map(tuple, loaded.collect())) == [("a", 1), ("b", 2)]
    with pytest.raises(FileNotFoundError, match="two"):
        files.load_report_set(spark, {"one": f"{tmp_path}/one", "two": f"{tmp_path}/two"}, {"one": df.schema, "two": df.schema})
    first = files.fingerprint(spark, f"{tmp_path}/one").first()
    assert first["files"] >= 1 and len(first["sha256"]) == 64
    assert files.fingerprint(spark, f"{tmp_path}/one").first() == first


def test_metadata_is_checked(spark, tmp_path):
    schema = "threshold double, test_set_used boolean, note string"
    for name, row, problem in [
        ("good", (0.4, False, "x"), None), ("high", (1.4, False, "x"), "threshold_in_0_1"),
        ("used", (0.4, True, "x"), "test_set_unused"), ("bare", (0.4, False, None), "has_note"),
    ]:
        files.write_metadata(spark.createDataFrame([row], schema), f"{tmp_path}/{name}")
        read = lambda: files.read_metadata(spark, f"{tmp_path}/{name}", schema, ["note"], "threshold")  # noqa: E731,B023
        if problem:
            with pytest.raises(ValueError, match=problem):
                read()
        else:
            assert read().first()["threshold"] == 0.4
    with pytest.raises(FileNotFoundError):
        files.read_metadata(spark, f"{tmp_path}/none", schema, [])


def test_load_table_numbers_rows_and_checks_columns(spark):
    df = spark.createDataFrame([("no", 3), ("yes", 1), ("no", 2)], "default string, day int")
    out = files.load_table(df, "loaded_rows", {"default": "default_status"}, "record_id", ["day"],
                           ["record_id", "default_status", "day"])
    assert [tuple(r) for r in out.orderBy("record_id").collect()] == [(1, "yes", 1), (2, "no", 2), (3, "no", 3)]
    assert spark.table("loaded_rows").count() == 3
    with pytest.raises(ValueError, match="expected SQL schema"):
        files.load_table(df, None, {}, "record_id", ["day"], ["record_id", "job"])


def test_read_clean_checks_the_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (2, 1)], "age int, subscribed int")
    df.write.parquet(f"{tmp_path}/clean")
    assert files.read_clean(spark, f"{tmp_path}/clean", ["age", "subscribed"], expected={"row_count": 2}).count() == 2
    with pytest.raises(ValueError, match="row_count: 2 instead of 3"):
        files.read_clean(spark, f"{tmp_path}/clean", ["age", "subscribed"], expected={"row_count": 3})
    spark.createDataFrame([(1, 0), (None, 1)], df.schema).write.parquet(f"{tmp_path}/nulls")
    with pytest.raises(ValueError, match="age_not_null"):
        files.read_clean(spark, f"{tmp_path}/nulls", ["age", "subscribed"])


def test_checks_hold_whatever_is_read(spark):
    from campaignlake.operators import segments as s
    from campaignlake.operators import stats as st
    from campaignlake.operators import evaluation as e

    bad = spark.createDataFrame([(1, "yes"), (2, "maybe")], "id int, y string")
    p = spark.createDataFrame([("a", -0.2), ("b", 0.5)], "name string, p double")
    one = spark.createDataFrame([(1, "a", 1), (2, "a", 0)], "id int, f string, subscribed int")
    curve = spark.createDataFrame([(0.5, 0.1, 0.1, 0.1)], "threshold double, f1 double, recall double, precision double")
    frames = [
        (q.encode_target(bad, "y"), "id"),
        (st.benjamini_hochberg(p, "p"), "name"),
        (st.chi_square_tests(one, ["f"], "subscribed", p_values=False), "feature"),
        (st.mann_whitney_tests(one.where("subscribed = 1"), [st.GroupTest("t", "id")], "subscribed", False), "analysis_name"),
        (st.wilson_interval(one.where("id > 9"), "subscribed"), "method"),
        (st.proportion_differences(
            one, [st.Comparison("c", "x", F.col("id") == 1, "y", F.col("id") == 1)], "subscribed"), "comparison"),
        (s.best_scalable_segment(one, ["f"], "subscribed", 2.0), "feature"),
        (e.select_threshold(curve, 0.9), "threshold"),
    ]
    for frame, other in frames:
        with pytest.raises(Exception):
            frame.count()
        with pytest.raises(Exception):
            frame.select(other).collect()
