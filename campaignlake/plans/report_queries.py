"""Registered queries: the SQL report suite, loading and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlake.plans.registry import oracle, register
from campaignlake.plans.sql_reports import REPORTS, run_report, run_report_suite, suite_totals
from campaignlake.session import scratch_path
from campaignlake.sources.campaign import COLUMNS, COLUMNS, KEY, SHORT_NAMES, STORED_NAMES, TARGET, build_campaign, campaign
from campaignlake.sources.campaign import short_campaign, table
from campaignlake.sources import files

_COUNTS = """count(*) AS client_count, CAST(sum(subscribed) AS BIGINT) AS subscriber_count,
             round(100.0::DOUBLE * sum(subscribed) / count(*), 2) AS subscription_rate"""
_AGE = """CASE WHEN age BETWEEN 18 AND 29 THEN '18-29' WHEN age BETWEEN 30 AND 39 THEN '30-39'
          WHEN age BETWEEN 40 AND 49 THEN '40-49' WHEN age BETWEEN 50 AND 59 THEN '50-59'
          WHEN age BETWEEN 60 AND 69 THEN '60-69' ELSE '70+' END"""
_CONTACTS = """CASE WHEN campaign_contacts = 1 THEN '1 contact' WHEN campaign_contacts <= 3 THEN '2-3 contacts'
               WHEN campaign_contacts <= 5 THEN '4-5 contacts' WHEN campaign_contacts <= 10 THEN '6-10 contacts'
               ELSE '11+ contacts' END"""


def _union(columns: dict[str, str], counts: str = _COUNTS) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, CAST({column} AS VARCHAR) AS segment, {counts} FROM campaign GROUP BY {column}"
        for name, column in columns.items()
    )


_RANKED = {"job": "job", "contact": "contact", "month": "contact_month", "previous_outcome": "previous_outcome"}

_REPORT_SQL = {
    "dataset_overview": """
        SELECT count(*) AS total_clients, CAST(sum(subscribed) AS BIGINT) AS subscribers,
               count(*) FILTER (subscribed = 0) AS non_subscribers,
               round(100.0::DOUBLE * sum(subscribed) / count(*), 2) AS overall_subscription_rate FROM campaign""",
    "subscription_by_job": f"SELECT job, {_COUNTS}, round(avg(balance), 2) AS average_balance FROM campaign GROUP BY job",
    "subscription_by_education": f"""
        SELECT education, {_COUNTS}, round(avg(age), 2) AS average_age, round(avg(balance), 2) AS average_balance
        FROM campaign GROUP BY education""",
    "subscription_by_contact_type": f"""
        SELECT contact, {_COUNTS}, round(avg(call_duration_seconds), 2) AS average_call_duration_seconds
        FROM campaign GROUP BY contact""",
    "subscription_by_month": f"""
        SELECT contact_month, CAST(month_number AS INTEGER) AS month_number, {_COUNTS}
        FROM campaign JOIN (VALUES ('jan',1),('feb',2),('mar',3),('apr',4),('may',5),('jun',6),('jul',7),
             ('aug',8),('sep',9),('oct',10),('nov',11),('dec',12)) AS m(name, month_number)
          ON contact_month = name
        GROUP BY contact_month, month_number""",
    "subscription_by_previous_outcome": f"""
        SELECT previous_outcome, {_COUNTS}, round(avg(previous_contacts), 2) AS average_previous_contacts
        FROM campaign GROUP BY previous_outcome""",
    "average_balance_by_subscription": """
        SELECT subscribed, CASE WHEN subscribed = 1 THEN 'Subscription' ELSE 'No subscription' END AS subscription_label,
               count(*) AS client_count, round(avg(balance), 2) AS average_balance,
               min(balance) AS minimum_balance, max(balance) AS maximum_balance
        FROM campaign GROUP BY subscribed""",
    "conversion_by_age_group": f"SELECT {_AGE} AS age_group, {_COUNTS} FROM campaign GROUP BY 1",
    "conversion_by_campaign_contacts": f"""
        SELECT {_CONTACTS} AS campaign_contact_group, {_COUNTS} FROM campaign GROUP BY 1""",
    "job_performance_ranking": f"""
        SELECT job, client_count, subscriber_count, subscription_rate,
               CAST(dense_rank() OVER (ORDER BY subscription_rate DESC) AS INTEGER) AS subscription_rate_rank,
               round(100.0::DOUBLE * subscriber_count / sum(subscriber_count) OVER (), 2) AS share_of_all_subscribers
        FROM (SELECT job, {_COUNTS} FROM campaign GROUP BY job)""",
    "scalable_segment_ranking": f"""
        SELECT *, CAST(row_number() OVER (PARTITION BY feature
                       ORDER BY subscription_rate DESC, subscriber_count DESC, segment) AS INTEGER) AS segment_rank
        FROM ({_union(_RANKED)}) WHERE client_count >= (SELECT floor(count(*) * 0.01) FROM campaign)""",
}


def _register_report(name: str) -> None:
    register(name, oracle(_REPORT_SQL[name]))(lambda spark, sf_dir: run_report(campaign(spark, sf_dir), name))


for _name in REPORTS:
    _register_report(_name)


@register(
    "report_suite",
    oracle(
        """SELECT 'subscription_by_job' AS report, (SELECT count(DISTINCT job) FROM campaign) AS report_rows, count(*) AS client_total FROM campaign
        UNION ALL SELECT 'subscription_by_education', (SELECT count(DISTINCT education) FROM campaign), count(*) FROM campaign
        UNION ALL SELECT 'subscription_by_contact_type', (SELECT count(DISTINCT contact) FROM campaign), count(*) FROM campaign
        UNION ALL SELECT 'subscription_by_month', (SELECT count(DISTINCT contact_month) FROM campaign), count(*) FROM campaign
        UNION ALL SELECT 'subscription_by_previous_outcome', (SELECT count(DISTINCT previous_outcome) FROM campaign), count(*) FROM campaign
        UNION ALL SELECT 'average_balance_by_subscription', (SELECT count(DISTINCT subscribed) FROM campaign), count(*) FROM campaign
        UNION ALL SELECT 'conversion_by_age_group', (SELECT count(DISTINCT """ + _AGE + """) FROM campaign), count(*) FROM campaign
        UNION ALL SELECT 'conversion_by_campaign_contacts', (SELECT count(DISTINCT """ + _CONTACTS + """) FROM campaign), count(*) FROM campaign
        UNION ALL SELECT 'job_performance_ranking', (SELECT count(DISTINCT job) FROM campaign), count(*) FROM campaign
        UNION ALL SELECT 'scalable_segment_ranking', count(*), CAST(sum(client_count) AS BIGINT)
                  FROM (""" + _union(_RANKED) + """) WHERE client_count >= (SELECT floor(count(*) * 0.01) FROM campaign)"""
    ),
)
def _report_suite(spark, sf_dir):
    return suite_totals(run_report_suite(campaign(spark, sf_dir)))


@register("campaign_table", oracle(f"SELECT {', '.join(COLUMNS)} FROM campaign"))
def _campaign_table(spark, sf_dir):
    """The derivation itself, with its joins and order history, not the stored copy."""
    return build_campaign(spark, sf_dir)


_NAMES = ", ".join(f'"{s}" AS {l}' for l, s in SHORT_NAMES.items())


@register(
    "load_table_with_key",
    oracle(
        f"""SELECT row_number() OVER (ORDER BY "month", "day", campaign_record_id) AS record_number, age, job, marital, education,
            {_NAMES}, balance, contact, subscribed FROM short"""
    ),
)
def _load_table_with_key(spark, sf_dir):
    columns = ["record_number", *[c for c in COLUMNS if c != KEY]]
    return files.load_table(
        short_campaign(spark, sf_dir), None, STORED_NAMES, "record_number", ["month", "day", KEY], columns
    )


@register("read_delimited", oracle(f"SELECT {', '.join(COLUMNS)} FROM campaign"))
def _read_delimited(spark, sf_dir):
    """The whole table through a semicolon-separated file and back, with a given schema."""
    rows = campaign(spark, sf_dir)
    path = scratch_path(spark, "delimited")
    rows.write.mode("overwrite").option("sep", ";").option("header", True).csv(path)
    return files.read_delimited(spark, path, rows.schema)


@register("read_clean", oracle(f"SELECT {', '.join(COLUMNS)} FROM campaign"))
def _read_clean(spark, sf_dir):
    """Load a stored table and check columns, nulls, target domain and counts on the way."""
    rows = campaign(spark, sf_dir)
    path = scratch_path(spark, "clean")
    files.write_report(rows, path, "parquet")
    return files.read_clean(spark, path, COLUMNS, TARGET, {"row_count": table(spark, sf_dir, "orders").count()})


@register("report_set", oracle(_REPORT_SQL["subscription_by_job"]))
def _report_set(spark, sf_dir):
    """A report written as one CSV file and loaded again by name."""
    report = run_report(campaign(spark, sf_dir), "subscription_by_job")
    path = scratch_path(spark, "reports")
    files.write_report(report, path, single_file=True)
    return files.load_report_set(spark, {"jobs": path}, {"jobs": report.schema})["jobs"]


@register(
    "metadata_record",
    oracle(
        """SELECT 'campaign' AS table_name, count(*) AS row_count, false AS test_set_used,
                  round(avg(subscribed), 6) AS threshold FROM campaign"""
    ),
)
def _metadata_record(spark, sf_dir):
    """One nested record written as JSON, read back and checked."""
    record = campaign(spark, sf_dir).agg(
        F.struct(F.lit("campaign").alias("table_name"), F.count(F.lit(1)).alias("row_count")).alias("source"),
        F.round(F.avg(TARGET), 6).alias("threshold"),
        F.lit(False).alias("test_set_used"),
    )
    path = scratch_path(spark, "metadata")
    files.write_metadata(record, path)
    back = files.read_metadata(spark, path, record.schema, ["source", "threshold"], "threshold")
    return back.select("source.table_name", "source.row_count", "test_set_used", "threshold")


@register("table_fingerprint")
def _table_fingerprint(spark, sf_dir):
    return files.fingerprint(spark, f"{sf_dir}/orders.parquet")


_COLUMN_TEXTS = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in COLUMNS)


@register(
    "content_fingerprint",
    oracle(
        f"""SELECT sha256(string_agg(d, chr(10) ORDER BY d)) AS sha256, CAST(sum(n) AS BIGINT) AS rows
        FROM (SELECT sha256(string_agg(d, chr(10) ORDER BY d)) AS d, sum(n) AS n
              FROM (SELECT lead, sha256(string_agg(d, chr(10) ORDER BY d)) AS d, count(*) AS n
                    FROM (SELECT d, substr(d, 1, 6) AS lead
                          FROM (SELECT sha256(concat_ws(chr(31), {_COLUMN_TEXTS})) AS d FROM campaign))
                    GROUP BY lead) GROUP BY substr(lead, 1, 3))"""
    ),
)
def _content_fingerprint(spark, sf_dir):
    """Fingerprint of all rows and columns of the campaign table."""
    return files.content_fingerprint(campaign(spark, sf_dir))
