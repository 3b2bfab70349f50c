"""The campaign table: one row per order of the star schema, with the stored campaign schema.

`build_campaign` derives it; `campaign` keeps one Parquet copy per application and source folder in
the shared folder, so that reports scan a stored table with column pruning, as they would in a
warehouse, instead of repeating the joins.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from campaignlake.functions.bands import MONTHS, yes_no
from campaignlake.operators.scan import ordered_scan
from campaignlake.session import materialize

# Stored column order; the cleaned names of the renamed ones; the target.
COLUMNS = [
    "campaign_record_id", "age", "job", "marital", "education", "default_status", "balance",
    "housing_loan", "personal_loan", "contact", "contact_day", "contact_month",
    "call_duration_seconds", "campaign_contacts", "days_since_previous_contact",
    "previous_contacts", "previous_outcome", "subscribed",
]
SHORT_NAMES = {
    "default_status": "default", "housing_loan": "housing", "personal_loan": "loan",
    "contact_day": "day", "contact_month": "month", "call_duration_seconds": "duration",
    "campaign_contacts": "campaign", "days_since_previous_contact": "pdays",
    "previous_contacts": "previous", "previous_outcome": "poutcome",
}
STORED_NAMES = {short: stored for stored, short in SHORT_NAMES.items()}
TARGET = "subscribed"
KEY = "campaign_record_id"

_stored: dict[tuple[str, str], DataFrame] = {}
_lock = threading.Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def build_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derive the campaign table.

    A customer may hold a large share of all orders, so the order history runs as an ordered scan
    over (customer, date, order), which splits such a customer over partitions, not as a window
    per customer. Lines are counted before they are shuffled. No join is forced to broadcast.
    """
    orders = table(spark, sf_dir, "orders").withColumn("_one", F.lit(1).cast("long"))
    history = ordered_scan(
        orders, ["o_orderdate", "o_orderkey"], ["o_custkey"], sums=["_one"], lags=["o_orderdate", "o_orderstatus"]
    )
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    customers = (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("lines"), F.max(F.col("l_returnflag") == "R").alias("returned"))
    )
    rows = history.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    priority = F.lower(F.regexp_replace("o_orderpriority", "^[0-9]-", ""))
    outcome = F.col("prev_o_orderstatus")
    month_names = F.array(*[F.lit(m) for m in MONTHS])
    derived = {
        "campaign_record_id": F.col("o_orderkey"),
        "age": (F.lit(18) + F.col("c_custkey") % 70).cast("int"),
        "job": F.lower("c_mktsegment"),
        "marital": F.lower("r_name"),
        "education": F.lower("n_name"),
        "default_status": yes_no(F.col("c_acctbal") < -500),
        "balance": F.floor("c_acctbal").cast("int"),
        "housing_loan": yes_no(F.col("o_totalprice") > 250000),
        "personal_loan": yes_no(F.col("returned")),
        "contact": F.when(priority == "not specified", F.lit("unknown")).otherwise(priority),
        "contact_day": F.dayofmonth("o_orderdate"),
        "contact_month": F.element_at(month_names, F.month("o_orderdate")),
        "call_duration_seconds": F.floor(F.col("o_totalprice") / 100).cast("int"),
        "campaign_contacts": F.coalesce(F.col("lines"), F.lit(1)).cast("int"),
        "days_since_previous_contact": F.coalesce(
            F.datediff("o_orderdate", "prev_o_orderdate"), F.lit(-1)
        ).cast("int"),
        "previous_contacts": (F.col("cum__one") - 1).cast("int"),
        "previous_outcome": F.when(outcome == "F", F.lit("success"))
        .when(outcome == "O", F.lit("failure"))
        .when(outcome == "P", F.lit("other"))
        .otherwise(F.lit("unknown")),
        "subscribed": (F.col("o_orderstatus") == "F").cast("int"),
    }
    return rows.select(*[derived[name].alias(name) for name in COLUMNS])


def campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored campaign table of `sf_dir`, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _stored:
            _stored[key] = materialize(build_campaign(spark, sf_dir), "campaign")
        return _stored[key]


def short_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaign table under the short column names of the cleaned file (key kept first)."""
    return campaign(spark, sf_dir).withColumnsRenamed(SHORT_NAMES)


def raw_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned text form of the campaign table, for the quality operators.

    Derived by fixed rules on the key: padded upper-case jobs, missing education values, balances
    that are no number, a yes/no target, and every 50th record twice. The key itself is left out.
    """
    key = F.col(KEY)
    rows = short_campaign(spark, sf_dir)
    twice = F.explode(F.when(key % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    noisy = rows.withColumn("_copy", twice)
    return noisy.select(
        "age",
        F.when(key % 7 == 0, F.concat(F.lit(" \t"), F.upper("job"), F.lit(" "))).otherwise(F.col("job")).alias("job"),
        "marital",
        F.when(key % 11 != 0, F.col("education")).alias("education"),
        "default",
        F.when(key % 97 == 0, F.lit("n/a")).otherwise(F.col("balance").cast("string")).alias("balance"),
        "housing", "loan", "contact", "day", "month", "duration", "campaign", "pdays", "previous", "poutcome",
        F.when(F.col(TARGET) == 1, F.lit("yes")).otherwise(F.lit("no")).alias("y"),
    )


def scored_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label, score): a fixed score with many ties on the key of the campaign table."""
    return campaign(spark, sf_dir).select(
        F.col(KEY).alias("id"),
        F.col(TARGET).alias("label"),
        (((F.col(KEY) * 7919) % 1000) / F.lit(1000.0)).alias("score"),
    )
