"""Registration of queries and of the SQL each one is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The tables of sources/campaign.py in the oracle's dialect.
_BASE = """
campaign AS (
  SELECT o_orderkey AS campaign_record_id,
         CAST(18 + c_custkey % 70 AS INTEGER) AS age,
         lower(c_mktsegment) AS job, lower(r_name) AS marital, lower(n_name) AS education,
         CASE WHEN c_acctbal < -500 THEN 'yes' ELSE 'no' END AS default_status,
         CAST(floor(c_acctbal) AS INTEGER) AS balance,
         CASE WHEN o_totalprice > 250000 THEN 'yes' ELSE 'no' END AS housing_loan,
         CASE WHEN returned THEN 'yes' ELSE 'no' END AS personal_loan,
         CASE WHEN lower(substr(o_orderpriority, 3)) = 'not specified' THEN 'unknown'
              ELSE lower(substr(o_orderpriority, 3)) END AS contact,
         CAST(day(o_orderdate) AS INTEGER) AS contact_day,
         ['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'][month(o_orderdate)]
           AS contact_month,
         CAST(floor(o_totalprice / 100) AS INTEGER) AS call_duration_seconds,
         CAST(coalesce(lines, 1) AS INTEGER) AS campaign_contacts,
         CAST(coalesce(date_diff('day', CAST(prev_date AS DATE), CAST(o_orderdate AS DATE)), -1) AS INTEGER)
           AS days_since_previous_contact,
         CAST(seen AS INTEGER) AS previous_contacts,
         CASE prev_status WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' WHEN 'P' THEN 'other'
              ELSE 'unknown' END AS previous_outcome,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS subscribed
  FROM (SELECT *,
               lag(o_orderdate) OVER w AS prev_date, lag(o_orderstatus) OVER w AS prev_status,
               row_number() OVER w - 1 AS seen
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) o
  LEFT JOIN (SELECT l_orderkey, count(*) AS lines, bool_or(l_returnflag = 'R') AS returned
             FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
short AS (
  SELECT campaign_record_id, age, job, marital, education, default_status AS "default", balance,
         housing_loan AS housing, personal_loan AS loan, contact, contact_day AS day,
         contact_month AS month, call_duration_seconds AS duration, campaign_contacts AS campaign,
         days_since_previous_contact AS pdays, previous_contacts AS previous,
         previous_outcome AS poutcome, subscribed
  FROM campaign
),
raw AS (
  SELECT age,
         CASE WHEN campaign_record_id % 7 = 0 THEN ' ' || chr(9) || upper(job) || ' ' ELSE job END AS job,
         marital,
         CASE WHEN campaign_record_id % 11 <> 0 THEN education END AS education,
         "default",
         CASE WHEN campaign_record_id % 97 = 0 THEN 'n/a' ELSE CAST(balance AS VARCHAR) END AS balance,
         housing, loan, contact, day, month, duration, campaign, pdays, previous, poutcome,
         CASE WHEN subscribed = 1 THEN 'yes' ELSE 'no' END AS y
  FROM short, unnest(CASE WHEN campaign_record_id % 50 = 0 THEN [1, 2] ELSE [1] END)
),
scored AS (
  SELECT campaign_record_id AS id, subscribed AS label,
         ((campaign_record_id * 7919) % 1000) / CAST(1000 AS DOUBLE) AS score
  FROM campaign
)"""


def oracle(body: str, *ctes: str) -> str:
    """Full oracle statement: the base tables, further CTEs, then `body`."""
    return "WITH " + ",\n".join([_BASE.strip(), *ctes]) + "\n" + body.strip()


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with the statement its result must equal."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add
