"""Registered queries: data quality and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlake.operators import quality as q
from campaignlake.operators.segments import segment_rates
from campaignlake.plans.registry import oracle, register
from campaignlake.plans.sql_reports import run_report
from campaignlake.session import materialize, scratch_path
from campaignlake.sources.campaign import COLUMNS, KEY, STORED_NAMES, TARGET, campaign, raw_campaign, short_campaign

_SHORT = ["age", "job", "marital", "education", "default", "balance", "housing", "loan", "contact", "day",
          "month", "duration", "campaign", "pdays", "previous", "poutcome", "subscribed"]
_QUOTED = {c: f'"{c}"' for c in _SHORT}
_STRIP = r"lower(regexp_replace(regexp_replace({c}, '^[\s\x{a0}]+', ''), '[\s\x{a0}]+$', ''))"


def _norm(column: str) -> str:
    return _STRIP.replace("{c}", column)


# Text columns of `raw` that need normalising, and the integer form of its balance.
_PREPARED = f"""prepared AS (
  SELECT age, {_norm('job')} AS job, marital, education, "default", TRY_CAST(balance AS INTEGER) AS balance, housing, loan,
         contact, day, month, duration, campaign, pdays, previous, poutcome, y FROM raw
), cleaned AS (
  SELECT DISTINCT age, job, marital, education, "default", balance, housing, loan, contact, day, month, duration,
         campaign, pdays, previous, poutcome, CASE y WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS subscribed FROM prepared
)"""


def _rows(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _with_cells(changes, *tables):
    """Column changes with the number of filled cells each column has in the tables holding it."""
    cells = None
    for rows, columns in tables:
        part = q.schema_profile(rows.select(*columns)).select("column", "non_null_count")
        cells = part if cells is None else cells.unionByName(part)
    return changes.join(cells, "column", "left")


@register(
    "schema_differences",
    oracle(
        """SELECT 'y' AS "column", 'missing' AS problem, NULL::BIGINT AS non_null_count
        UNION ALL SELECT 'subscribed', 'unexpected', count(subscribed) FROM short
        UNION ALL SELECT 'campaign_record_id', 'unexpected', count(campaign_record_id) FROM short"""
    ),
)
def _schema_differences(spark, sf_dir):
    """The stored table against the raw schema, with the filled cells of what is not expected."""
    rows = short_campaign(spark, sf_dir)
    extra = [c for c in rows.columns if c not in q.RAW_COLUMNS]
    return _with_cells(q.schema_differences(spark, rows.columns, q.RAW_COLUMNS), (rows, extra))


_DOMAINS = {"job": ["automobile", "building", "furniture"], "y": ["yes", "no"], "poutcome": ["success", "failure", "other", "unknown", "none"]}


@register(
    "domain_report",
    oracle(
        """SELECT "column", value, coalesce(n, 0) AS n,
                  CASE WHEN n IS NULL THEN 'missing' WHEN allowed IS NULL THEN 'unexpected' ELSE 'ok' END AS status
        FROM (""" + _rows([f"SELECT '{c}' AS \"column\", {_norm(c)} AS value, count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY 2" for c in _DOMAINS]) + """)
        FULL JOIN (""" + _rows([f"SELECT '{c}' AS \"column\", '{v}' AS value, true AS allowed" for c, vs in _DOMAINS.items() for v in vs]) + """) USING ("column", value)"""
    ),
)
def _domain_report(spark, sf_dir):
    return q.domain_report(raw_campaign(spark, sf_dir), _DOMAINS)


_RULE_SQL = {
    "age_positive": "age > 0", "day_in_month": "day BETWEEN 1 AND 31", "duration_not_negative": "duration >= 0",
    "campaign_at_least_one": "campaign >= 1", "pdays_at_least_minus_one": "pdays >= -1", "previous_not_negative": "previous >= 0",
}


@register(
    "range_checks",
    oracle(_rows([f"SELECT '{n}' AS rule, count(*) FILTER (NOT ({c})) AS violations FROM short" for n, c in _RULE_SQL.items()])),
)
def _range_checks(spark, sf_dir):
    return q.rule_violations(short_campaign(spark, sf_dir), q.range_rules())


_TIGHT = {"age_below_60": "age < 60", "balance_not_negative": "balance >= 0", "known_outcome": "poutcome <> 'unknown'"}


@register(
    "rule_violations",
    oracle(_rows([f"SELECT '{n}' AS rule, count(*) FILTER (NOT ({c})) AS violations FROM short" for n, c in _TIGHT.items()])),
)
def _rule_violations(spark, sf_dir):
    """Rules the data does break, so that the counts are not all zero."""
    return q.rule_violations(short_campaign(spark, sf_dir), [q.Rule(n, F.expr(c)) for n, c in _TIGHT.items()])


@register(
    "count_profile",
    oracle(
        """SELECT count(*) AS row_count, count(*) FILTER (subscribed = 1) AS positives,
                  count(*) FILTER (subscribed = 0) AS negatives, count(*) FILTER (subscribed IS NULL) AS null_targets,
                  count(*) - count(DISTINCT campaign_record_id) AS duplicate_keys FROM campaign"""
    ),
)
def _count_profile(spark, sf_dir):
    return q.count_profile(campaign(spark, sf_dir), TARGET, KEY)


@register(
    "missing_summary",
    oracle(_rows([
        f"""SELECT '{c}' AS "column", count(*) FILTER ("{c}" IS NULL) AS missing_count,
            round_even(100.0::DOUBLE * count(*) FILTER ("{c}" IS NULL) / count(*), 2) AS missing_percentage FROM raw"""
        for c in q.RAW_COLUMNS
    ])),
)
def _missing_summary(spark, sf_dir):
    return q.missing_summary(raw_campaign(spark, sf_dir))


@register(
    "unknown_summary",
    oracle(_rows([
        f"""SELECT '{c}' AS "column", count(*) FILTER ({_norm(f'"{c}"')} = 'unknown') AS unknown_count,
            round_even(100.0::DOUBLE * count(*) FILTER ({_norm(f'"{c}"')} = 'unknown') / count(*), 2) AS unknown_percentage
            FROM raw"""
        for c in q.TEXT_COLUMNS
    ])),
)
def _unknown_summary(spark, sf_dir):
    return q.unknown_summary(raw_campaign(spark, sf_dir), q.TEXT_COLUMNS)


@register(
    "outlier_summary",
    oracle(
        """SELECT "column", round_even(q1, 2) AS q1, round_even(q3, 2) AS q3, round_even(iqr, 2) AS iqr,
               round_even(lower_bound, 2) AS lower_bound, round_even(upper_bound, 2) AS upper_bound,
               len(list_filter(vs, lambda v: v < lower_bound OR v > upper_bound)) AS potential_outlier_count,
               round_even(100.0::DOUBLE * len(list_filter(vs, lambda v: v < lower_bound OR v > upper_bound)) / len(vs), 2)
                 AS potential_outlier_percentage
        FROM (SELECT *, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lower_bound, q3 + 1.5::DOUBLE * (q3 - q1) AS upper_bound
              FROM (SELECT "column", list(v) AS vs, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM ("""
        + _rows([f"SELECT '{c}' AS \"column\", TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) AS v FROM raw" for c in q.NUMBER_COLUMNS])
        + """) WHERE v IS NOT NULL GROUP BY 1))"""
    ),
)
def _outlier_summary(spark, sf_dir):
    return q.outlier_summary(raw_campaign(spark, sf_dir), q.NUMBER_COLUMNS)


_TEXTS = ", ".join(f'"{c}"' for c in q.TEXT_COLUMNS)


@register("normalize_text", oracle(f"SELECT {_TEXTS}, count(*) AS n FROM prepared GROUP BY ALL", _PREPARED))
def _normalize_text(spark, sf_dir):
    """All text columns normalised, with the rows of each combination."""
    texts = q.normalize_text(raw_campaign(spark, sf_dir), q.TEXT_COLUMNS)
    return texts.groupBy(*q.TEXT_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


@register(
    "to_numeric",
    oracle(
        """SELECT count(*) AS row_count, count(balance) AS parsed, count(*) - count(balance) AS unparseable,
                  CAST(sum(balance) AS DOUBLE) AS total FROM prepared""",
        _PREPARED,
    ),
)
def _to_numeric(spark, sf_dir):
    parsed = q.to_numeric(raw_campaign(spark, sf_dir), ["balance"], "coerce")
    return parsed.agg(
        F.count(F.lit(1)).alias("row_count"), F.count("balance").alias("parsed"),
        F.count_if(F.col("balance").isNull()).alias("unparseable"), F.sum("balance").alias("total"),
    )


@register("duplicate_count", oracle("SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS duplicate_rows FROM raw"))
def _duplicate_count(spark, sf_dir):
    return q.duplicate_count(raw_campaign(spark, sf_dir))


@register("drop_exact_duplicates", oracle("SELECT DISTINCT * FROM raw"))
def _drop_exact_duplicates(spark, sf_dir):
    return q.drop_exact_duplicates(raw_campaign(spark, sf_dir))


@register("drop_repeated_rows", oracle("SELECT DISTINCT * FROM raw"))
def _drop_repeated_rows(spark, sf_dir):
    """The same rows, where only digests of all rows are shuffled."""
    return q.drop_repeated_rows(raw_campaign(spark, sf_dir))


@register("encode_target", oracle("SELECT CASE y WHEN 'yes' THEN 1 ELSE 0 END AS subscribed, count(*) AS n FROM raw GROUP BY 1"))
def _encode_target(spark, sf_dir):
    encoded = q.encode_target(raw_campaign(spark, sf_dir), "y")
    return encoded.groupBy(F.col("subscribed").cast("int").alias("subscribed")).agg(F.count(F.lit(1)).alias("n"))


@register("clean_table", oracle("SELECT * FROM cleaned", _PREPARED))
def _clean_table(spark, sf_dir):
    cleaned = q.clean(raw_campaign(spark, sf_dir), balance_errors="coerce")
    return cleaned.withColumn("subscribed", F.col("subscribed").cast("int"))


_CELLS = {
    "raw": " + ".join(f'count(*) FILTER ("{c}" IS NULL)' for c in q.RAW_COLUMNS),
    "cleaned": " + ".join(f"count(*) FILTER ({_QUOTED[c]} IS NULL)" for c in _SHORT),
    "unknown": " + ".join(f"count(*) FILTER ({_norm(chr(34) + c + chr(34))} = 'unknown')" for c in q.TEXT_COLUMNS),
}
_OVERVIEW = {
    "raw_rows": "(SELECT count(*) FROM raw)",
    "raw_columns": "17",
    "cleaned_rows": "(SELECT count(*) FROM cleaned)",
    "cleaned_columns": "17",
    "exact_duplicates_found": "(SELECT count(*) FROM raw) - (SELECT count(*) FROM cleaned)",
    "exact_duplicates_removed": "(SELECT count(*) FROM raw) - (SELECT count(*) FROM cleaned)",
    "raw_missing_cells": f"(SELECT {_CELLS['raw']} FROM raw)",
    "cleaned_missing_cells": f"(SELECT {_CELLS['cleaned']} FROM cleaned)",
    "explicit_unknown_values": f"(SELECT {_CELLS['unknown']} FROM raw)",
    "non_subscribers": "(SELECT count(*) FROM cleaned WHERE subscribed = 0)",
    "subscribers": "(SELECT count(*) FROM cleaned WHERE subscribed = 1)",
}


@register(
    "quality_overview",
    oracle(_rows([f"SELECT '{m}' AS metric, CAST({v} AS BIGINT) AS value" for m, v in _OVERVIEW.items()]), _PREPARED),
)
def _quality_overview(spark, sf_dir):
    raw = raw_campaign(spark, sf_dir)
    return q.quality_overview(raw, materialize(q.clean(raw, balance_errors="coerce"), "cleaned"))


_TYPES = {"campaign_record_id": "bigint", **{c: "int" for c in (
    "age", "balance", "contact_day", "call_duration_seconds", "campaign_contacts", "days_since_previous_contact",
    "previous_contacts", "subscribed")}}


@register(
    "schema_profile",
    oracle(_rows([
        f"""SELECT '{c}' AS "column", '{_TYPES.get(c, "string")}' AS dtype, count({c}) AS non_null_count,
            count(DISTINCT {c}) + CAST(bool_or({c} IS NULL) AS BIGINT) AS distinct_count FROM campaign"""
        for c in COLUMNS
    ])),
)
def _schema_profile(spark, sf_dir):
    return q.schema_profile(campaign(spark, sf_dir))


@register(
    "sketched_schema_profile",
    oracle(_rows([
        f"""SELECT '{c}' AS "column", count({c}) AS non_null_count,
            count(DISTINCT {c}) + CAST(bool_or({c} IS NULL) AS BIGINT) AS distinct_count, true AS within_error FROM campaign"""
        for c in COLUMNS
    ])),
)
def _sketched_schema_profile(spark, sf_dir):
    """Sketches stored by month and contact type, merged, beside the exact counts and the stated error."""
    rows, path = campaign(spark, sf_dir), scratch_path(spark, "sketches")
    late = F.col("contact_month") > "j"
    for part in (rows.where(late), rows.where(~late)):
        q.store_sketches(part, path, F.concat_ws("/", "contact_month", "contact"))
    exact = q.schema_profile(rows).select("column", "distinct_count")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= q.SKETCH_ERROR * F.col("distinct_count")
    return q.sketched_profile(spark, path).join(exact, "column").select(
        "column", "non_null_count", "distinct_count", near.alias("within_error"))


@register(
    "column_diff",
    oracle(
        """SELECT 'y' AS "column", 'removed' AS change, count(y) AS non_null_count FROM raw
        UNION ALL SELECT 'campaign_record_id', 'added', count(campaign_record_id) FROM short
        UNION ALL SELECT 'subscribed', 'added', count(subscribed) FROM short"""
    ),
)
def _column_diff(spark, sf_dir):
    """Columns removed and added by cleaning, with their filled cells."""
    raw, rows = raw_campaign(spark, sf_dir), short_campaign(spark, sf_dir)
    return _with_cells(q.column_diff(raw, rows), (raw, ["y"]), (rows, [KEY, TARGET]))


@register("reconcile_reports", oracle("SELECT '' AS job, '' AS \"column\", '' AS left_value, '' AS right_value WHERE false"))
def _reconcile_reports(spark, sf_dir):
    """The SQL report and the DataFrame operator must agree: no row is expected."""
    rows = campaign(spark, sf_dir)
    sql = run_report(rows, "subscription_by_job").drop("average_balance")
    api = segment_rates(rows, "job", TARGET, half_even=False).drop("share_of_all_clients")
    return q.reconcile(sql, api, ["job"], 1e-9)


@register(
    "reconcile_differences",
    oracle(
        """SELECT job, 'subscriber_count' AS "column", CAST(a AS VARCHAR) AS left_value, CAST(b AS VARCHAR) AS right_value
        FROM (SELECT job, sum(subscribed) AS a, sum(CASE WHEN age < 80 THEN subscribed ELSE 0 END) AS b
              FROM campaign GROUP BY job) WHERE a <> b"""
    ),
)
def _reconcile_differences(spark, sf_dir):
    """Two results that do differ."""
    rows = campaign(spark, sf_dir)
    full = rows.groupBy("job").agg(F.sum(TARGET).alias("subscriber_count"))
    young = rows.groupBy("job").agg(F.sum(F.when(F.col("age") < 80, F.col(TARGET)).otherwise(0)).alias("subscriber_count"))
    return q.reconcile(full, young, ["job"])


@register(
    "report_checks",
    oracle(
        """SELECT 'covers_all_clients' AS rule, CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'rate_in_0_100', 0
        UNION ALL SELECT 'has_rows', 0
        UNION ALL SELECT 'size_above_1300', count(*) FROM (SELECT count(*) AS n FROM campaign GROUP BY contact_month HAVING count(*) <= 1300)"""
    ),
)
def _report_checks(spark, sf_dir):
    rows = campaign(spark, sf_dir)
    report = run_report(rows, "subscription_by_month")
    return q.rule_violations(report, [
        q.Rule("covers_all_clients", F.sum("client_count") == rows.count(), kind="total"),
        q.Rule("rate_in_0_100", F.col("subscription_rate").between(0, 100)),
        q.Rule("has_rows", kind="rows", low=1, high=12),
        q.Rule("size_above_1300", F.col("client_count") > 1300),
    ])
