"""Registered queries: derived columns, segments, profiles and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlake.functions import bands as b
from campaignlake.operators import columns as c
from campaignlake.operators import segments as s
from campaignlake.operators.scan import mid_rank, ranked_histogram
from campaignlake.plans.registry import oracle, register
from campaignlake.plans.report_queries import _AGE, _CONTACTS, _RANKED, _union
from campaignlake.sources.campaign import KEY, TARGET, campaign, short_campaign, table

NUMBERS = ["age", "balance", "contact_day", "call_duration_seconds", "campaign_contacts",
           "days_since_previous_contact", "previous_contacts"]
TEXTS = ["job", "marital", "education", "default_status", "housing_loan", "personal_loan", "contact",
         "contact_month", "previous_outcome"]

_RATES = """count(*) AS client_count, CAST(sum(subscribed) AS BIGINT) AS subscriber_count,
            round_even(100.0::DOUBLE * sum(subscribed) / count(*), 2) AS subscription_rate"""
_SHARE = "round_even(100.0::DOUBLE * count(*) / (SELECT count(*) FROM campaign), 2) AS share_of_all_clients"
_CUT_AGE = """CASE WHEN age < 17 THEN NULL WHEN age <= 29 THEN '18-29' WHEN age <= 39 THEN '30-39' WHEN age <= 49 THEN '40-49'
              WHEN age <= 59 THEN '50-59' WHEN age <= 69 THEN '60-69' ELSE '70+' END"""
_BALANCE = """CASE WHEN balance < 0 THEN 'Negative balance' WHEN balance = 0 THEN 'Zero balance'
              WHEN balance BETWEEN 1 AND 1000 THEN '1-1,000' WHEN balance BETWEEN 1001 AND 5000 THEN '1,001-5,000'
              WHEN balance > 5000 THEN 'Above 5,000' ELSE 'Unclassified' END"""


def _long(columns, target: str = "") -> str:
    extra = f", {target}" if target else ""
    return " UNION ALL ".join(f"SELECT '{x}' AS feature, CAST({x} AS DOUBLE) AS v{extra} FROM campaign" for x in columns)


# Derived columns -----------------------------------------------------------------------------

@register("age_bands", oracle(f"SELECT campaign_record_id, {_CUT_AGE} AS age_group, {_AGE} AS age_group_sql FROM campaign"))
def _age_bands(spark, sf_dir):
    age = F.col("age")
    return campaign(spark, sf_dir).select(
        KEY, b.band(age, b.AGE_EDGES, b.AGE_LABELS).alias("age_group"), b.age_band(age).alias("age_group_sql")
    )


@register("contact_bands", oracle(f"SELECT campaign_record_id, {_CONTACTS} AS closed, {_CONTACTS} AS by_case FROM campaign"))
def _contact_bands(spark, sf_dir):
    contacts = F.col("campaign_contacts")
    return campaign(spark, sf_dir).select(
        KEY, b.band(contacts, b.CONTACT_EDGES, b.CONTACT_LABELS).alias("closed"), b.contact_band(contacts).alias("by_case")
    )


@register("balance_bands", oracle(f"SELECT campaign_record_id, {_BALANCE} AS balance_group FROM campaign"))
def _balance_bands(spark, sf_dir):
    return campaign(spark, sf_dir).select(KEY, b.balance_band(F.col("balance")).alias("balance_group"))


@register(
    "target_labels",
    oracle("SELECT campaign_record_id, CASE subscribed WHEN 0 THEN 'No subscription' ELSE 'Subscription' END AS label FROM campaign"),
)
def _target_labels(spark, sf_dir):
    return campaign(spark, sf_dir).select(KEY, b.label_map(F.col(TARGET), b.TARGET_LABELS).alias("label"))


@register(
    "sentinel_split",
    oracle(
        """SELECT campaign_record_id, CASE WHEN pdays >= 0 THEN 'yes' ELSE 'no' END AS previously_contacted,
                  CASE WHEN pdays >= 0 THEN CAST(pdays AS DOUBLE) END AS pdays_since_previous_contact,
                  CASE WHEN balance < 0 THEN 'yes' ELSE 'no' END AS negative_balance FROM short"""
    ),
)
def _sentinel_split(spark, sf_dir):
    return short_campaign(spark, sf_dir).select(
        KEY,
        b.sentinel_flag(F.col("pdays")).alias("previously_contacted"),
        b.sentinel_value(F.col("pdays")).alias("pdays_since_previous_contact"),
        b.negative_flag(F.col("balance")).alias("negative_balance"),
    )


@register(
    "row_subset",
    oracle("SELECT campaign_record_id, pdays FROM short WHERE pdays >= 0"),
)
def _row_subset(spark, sf_dir):
    rows = short_campaign(spark, sf_dir)
    return c.row_filter(rows, "previously_contacted_clients", c.subsets("pdays")).select(KEY, "pdays")


@register(
    "wide_to_long",
    oracle(" UNION ALL ".join(
        f"SELECT job, '{label}' AS metric, {sql} AS score FROM campaign GROUP BY job"
        for label, sql in (("Mean age", "avg(age)"), ("Mean balance", "avg(balance)"))
    )),
)
def _wide_to_long(spark, sf_dir):
    wide = campaign(spark, sf_dir).groupBy("job").agg(F.avg("age").alias("mean_age"), F.avg("balance").alias("mean_balance"))
    return c.to_long(wide, ["job"], ["mean_age", "mean_balance"], labels={"mean_age": "Mean age", "mean_balance": "Mean balance"})


@register("numeric_columns", oracle("SELECT " + ", ".join(NUMBERS) + " FROM campaign"))
def _numeric_columns(spark, sf_dir):
    return c.select_columns(campaign(spark, sf_dir), exclude=[KEY, TARGET], numeric_only=True)


# Rates ---------------------------------------------------------------------------------------

@register(
    "overview",
    oracle(
        """SELECT count(*) AS total, CAST(sum(subscribed) AS BIGINT) AS positives,
                  CAST(count(*) - sum(subscribed) AS BIGINT) AS negatives,
                  round(100.0::DOUBLE * sum(subscribed) / count(*), 2) AS rate FROM campaign"""
    ),
)
def _overview(spark, sf_dir):
    return s.overview(campaign(spark, sf_dir), TARGET)


def _rates(name, segment, expression, order=None, averages=None, extra=""):
    sql = f"SELECT {expression} AS {segment}, {_RATES}, {_SHARE}{extra} FROM campaign GROUP BY 1"

    def query(spark, sf_dir):
        rows = campaign(spark, sf_dir)
        columns = {
            "age_group": b.band(F.col("age"), b.AGE_EDGES, b.AGE_LABELS),
            "balance_group": b.balance_band(F.col("balance")),
            "campaign_group": b.band(F.col("campaign_contacts"), b.CONTACT_EDGES, b.CONTACT_LABELS),
        }
        rates = s.segment_rates(rows, columns.get(segment, F.col(segment)), TARGET, segment, averages)
        return s.ordered_rates(rates, segment, order)

    register(name, oracle(sql))(query)


_rates("segment_rates_job", "job", "job", averages={"average_balance": "balance"},
       extra=", round(avg(balance), 2) AS average_balance")
_rates("segment_rates_month", "contact_month", "contact_month", order=b.MONTHS)
_rates("rates_by_age_band", "age_group", _CUT_AGE, order=b.AGE_LABELS)
_rates("rates_by_balance_band", "balance_group", _BALANCE, order=b.BALANCE_LABELS)
_rates("rates_by_contact_band", "campaign_group", _CONTACTS, order=b.CONTACT_LABELS)
_rates("rates_by_housing_loan", "housing_loan", "housing_loan")
_rates("rates_by_personal_loan", "personal_loan", "personal_loan")


@register(
    "category_order",
    oracle("""SELECT contact_month, count(*) AS n, list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'],
              contact_month) AS place FROM campaign GROUP BY 1"""),
)
def _category_order(spark, sf_dir):
    grouped = campaign(spark, sf_dir).groupBy("contact_month").agg(F.count(F.lit(1)).alias("n"))
    placed = grouped.withColumn("place", b.category_position(F.col("contact_month"), b.MONTHS))
    return c.order_by_category(placed, "contact_month", b.MONTHS)


_LABEL = "CASE subscribed WHEN 0 THEN 'No subscription' ELSE 'Subscription' END AS label"


@register(
    "value_by_target",
    oracle(
        f"""SELECT subscribed, count(*) AS client_count, round(avg(balance), 6) AS mean_value, min(balance) AS minimum_value,
            max(balance) AS maximum_value, {_LABEL} FROM campaign GROUP BY subscribed"""
    ),
)
def _value_by_target(spark, sf_dir):
    out = s.value_by_target(campaign(spark, sf_dir), "balance", TARGET, b.TARGET_LABELS)
    return out.withColumn("mean_value", F.round("mean_value", 6))


@register(
    "duration_by_target",
    oracle(
        f"""SELECT subscribed, count(*) AS client_count, round(avg(call_duration_seconds), 6) AS mean_value,
            CAST(min(call_duration_seconds) AS DOUBLE) AS minimum_value, CAST(max(call_duration_seconds) AS DOUBLE) AS maximum_value,
            median(call_duration_seconds) AS median_value, {_LABEL} FROM campaign GROUP BY subscribed"""
    ),
)
def _duration_by_target(spark, sf_dir):
    out = s.value_by_target_with_median(campaign(spark, sf_dir), "call_duration_seconds", TARGET, b.TARGET_LABELS)
    return out.withColumn("mean_value", F.round("mean_value", 6))


_HALF_UP = """count(*) AS client_count, CAST(sum(subscribed) AS BIGINT) AS subscriber_count,
              round(100.0::DOUBLE * sum(subscribed) / count(*), 2) AS subscription_rate"""


@register("multi_segment_rates", oracle(_union({t: t for t in TEXTS}, _HALF_UP)))
def _multi_segment_rates(spark, sf_dir):
    return s.multi_segment_rates(campaign(spark, sf_dir), TEXTS, TARGET)


@register(
    "document_quality_rates",
    oracle(
        """SELECT 'lang' AS feature, lang AS segment, count(*) AS client_count, CAST(sum(quality) AS BIGINT) AS subscriber_count,
                  round(100.0::DOUBLE * sum(quality) / count(*), 2) AS subscription_rate
           FROM labels JOIN documents USING (doc_id) GROUP BY lang
           UNION ALL SELECT 'source', source, count(*), CAST(sum(quality) AS BIGINT), round(100.0::DOUBLE * sum(quality) / count(*), 2)
           FROM labels JOIN documents USING (doc_id) GROUP BY source"""
    ),
)
def _document_quality_rates(spark, sf_dir):
    """The same operator on another table and target: document quality by language and source."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id")
    return s.multi_segment_rates(rows, ["lang", "source"], "quality")


@register(
    "target_distribution",
    oracle(
        f"""SELECT subscribed, count(*) AS count, round_even(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentage,
            {_LABEL} FROM campaign GROUP BY subscribed"""
    ),
)
def _target_distribution(spark, sf_dir):
    return s.target_distribution(campaign(spark, sf_dir), TARGET, b.TARGET_LABELS)


# Profiles ------------------------------------------------------------------------------------

@register(
    "numeric_profile",
    oracle(
        f"""SELECT feature, count(v) AS count, round(avg(v), 6) AS mean, median(v) AS median, round(stddev_samp(v), 6) AS std, min(v) AS min,
            quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, max(v) AS max, round(skewness(v), 6) AS skewness
        FROM ({_long(NUMBERS)}) GROUP BY feature"""
    ),
)
def _numeric_profile(spark, sf_dir):
    out = s.numeric_profile(campaign(spark, sf_dir), NUMBERS)
    return out.withColumns({x: F.round(x, 6) for x in ("mean", "std", "skewness")})


@register(
    "skewness_report",
    oracle(
        f"""SELECT feature, round(k, 6) AS skewness, round(abs(k), 6) AS absolute_skewness,
            CASE WHEN abs(k) < 0.5 THEN 'Approximately symmetric' WHEN abs(k) < 1 THEN 'Moderately skewed' ELSE 'Highly skewed' END
              AS interpretation
        FROM (SELECT feature, skewness(v) AS k FROM ({_long(NUMBERS)}) GROUP BY feature)"""
    ),
)
def _skewness_report(spark, sf_dir):
    out = s.skewness_report(campaign(spark, sf_dir), NUMBERS)
    return out.withColumns({x: F.round(x, 6) for x in ("skewness", "absolute_skewness")})


@register(
    "numeric_by_target",
    oracle(
        " UNION ALL ".join(
            f"""SELECT feature, '{name}' AS statistic, round({f} FILTER (subscribed = 0), 6) AS non_subscribers,
                round({f} FILTER (subscribed = 1), 6) AS subscribers,
                round({f} FILTER (subscribed = 1) - {f} FILTER (subscribed = 0), 6) AS difference
            FROM ({_long(NUMBERS, 'subscribed')}) GROUP BY feature"""
            for name, f in (("mean", "avg(v)"), ("median", "median(v)"))
        )
    ),
)
def _numeric_by_target(spark, sf_dir):
    out = s.numeric_by_target(campaign(spark, sf_dir), NUMBERS, TARGET)
    return out.withColumns({x: F.round(x, 6) for x in ("non_subscribers", "subscribers", "difference")})


_TEXT_LONG = " UNION ALL ".join(f"SELECT '{t}' AS feature, {t} AS value FROM campaign" for t in TEXTS)


@register(
    "category_profile",
    oracle(
        f"""SELECT feature, count(*) AS unique_categories, arg_min(value, rk) AS most_common_category, max(n) AS most_common_count,
            round_even(100.0::DOUBLE * max(n) / sum(n), 2) AS most_common_percentage
        FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rk
              FROM (SELECT feature, value, count(*) AS n FROM ({_TEXT_LONG}) GROUP BY 1, 2)) GROUP BY feature"""
    ),
)
def _category_profile(spark, sf_dir):
    return s.category_profile(campaign(spark, sf_dir), TEXTS)


@register(
    "duration_deciles",
    oracle(
        f"""SELECT band, edges[band] AS lower_edge, edges[band + 1] AS upper_edge,
            CASE WHEN band = 1 THEN '[' ELSE '(' END || CAST(round(edges[band], 3) AS VARCHAR) || ', ' ||
              CAST(round(edges[band + 1], 3) AS VARCHAR) || ']' AS value_range,
            client_count, subscriber_count, subscription_rate
        FROM (SELECT edges, band, {_RATES} FROM (
          SELECT subscribed, edges, CAST(1 + len(list_filter(edges[2:], lambda e: e < v)) AS INTEGER) AS band
          FROM (SELECT subscribed, CAST(call_duration_seconds AS DOUBLE) AS v FROM campaign),
               (SELECT list_sort(list_distinct(quantile_cont(CAST(call_duration_seconds AS DOUBLE),
                  [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS edges FROM campaign)) GROUP BY ALL)"""
    ),
)
def _duration_deciles(spark, sf_dir):
    return s.quantile_bands(campaign(spark, sf_dir), "call_duration_seconds", TARGET, 10)


@register(
    "previous_contact_deciles",
    oracle(
        f"""SELECT band, edges[band] AS lower_edge, edges[band + 1] AS upper_edge, client_count, subscriber_count, subscription_rate
        FROM (SELECT edges, band, {_RATES} FROM (
          SELECT subscribed, edges, CAST(greatest(1, 1 + len(list_filter(edges[2:], lambda e: e < v))) AS INTEGER) AS band
          FROM (SELECT subscribed, CAST(campaign_contacts AS DOUBLE) AS v FROM campaign),
               (SELECT list_sort(list_distinct(quantile_cont(CAST(campaign_contacts AS DOUBLE),
                  [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS edges FROM campaign)) GROUP BY ALL)"""
    ),
)
def _previous_contact_deciles(spark, sf_dir):
    """Few distinct values: most decile edges coincide and are merged."""
    return s.quantile_bands(campaign(spark, sf_dir), "campaign_contacts", TARGET, 10).drop("value_range")


@register(
    "contingency_table",
    oracle(
        """SELECT contact AS category, count(*) FILTER (subscribed = 0) AS class_0, count(*) FILTER (subscribed = 1) AS class_1
        FROM campaign GROUP BY contact"""
    ),
)
def _contingency_table(spark, sf_dir):
    return s.contingency(campaign(spark, sf_dir), "contact", TARGET)


@register("group_sizes", oracle("SELECT job, contact, count(*) AS size FROM campaign GROUP BY ALL"))
def _group_sizes(spark, sf_dir):
    return s.size_by(campaign(spark, sf_dir), ["job", "contact"])


@register(
    "value_histogram",
    oracle(
        f"""SELECT e.feature, e.bin, round(low + e.bin * ((high - low) / 30), 6) AS lower_edge,
            round(low + (e.bin + 1) * ((high - low) / 30), 6) AS upper_edge, coalesce(c.n, 0) AS count
        FROM (SELECT feature, min(v) AS low, max(v) AS high, unnest(CAST(range(0, 30) AS INTEGER[])) AS bin
              FROM ({_long(NUMBERS)}) GROUP BY feature) e
        LEFT JOIN (
          SELECT feature, CAST(least(29, floor((v - low) / ((high - low) / 30))) AS INTEGER) AS bin, count(*) AS n
          FROM (SELECT feature, v, min(v) OVER (PARTITION BY feature) AS low, max(v) OVER (PARTITION BY feature) AS high
                FROM ({_long(NUMBERS)})) GROUP BY 1, 2) c ON c.feature = e.feature AND c.bin = e.bin"""
    ),
)
def _value_histogram(spark, sf_dir):
    out = s.histogram(campaign(spark, sf_dir), NUMBERS, 30)
    return out.withColumns({x: F.round(x, 6) for x in ("lower_edge", "upper_edge")})


_BOXES = ["age", "balance", "call_duration_seconds", "campaign_contacts"]


@register(
    "box_stats",
    oracle(
        f"""SELECT subscribed, feature, q1, median, q3,
            min(v) FILTER (v BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS lower_whisker,
            max(v) FILTER (v BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS upper_whisker
        FROM ({_long(_BOXES, 'subscribed')}) JOIN (
          SELECT feature, subscribed, quantile_cont(v, 0.25) AS q1, median(v) AS median, quantile_cont(v, 0.75) AS q3
          FROM ({_long(_BOXES, 'subscribed')}) GROUP BY 1, 2) USING (feature, subscribed) GROUP BY ALL"""
    ),
)
def _box_stats(spark, sf_dir):
    return s.box_stats(campaign(spark, sf_dir), _BOXES, TARGET)


# Rankings ------------------------------------------------------------------------------------

@register(
    "rank_segments",
    oracle(
        f"""SELECT education, client_count, subscriber_count, subscription_rate,
            CAST(dense_rank() OVER (ORDER BY subscription_rate DESC) AS INTEGER) AS subscription_rate_rank,
            round(100.0::DOUBLE * subscriber_count / sum(subscriber_count) OVER (), 2) AS share_of_all_subscribers
        FROM (SELECT education, {_RATES} FROM campaign GROUP BY education)"""
    ),
)
def _rank_segments(spark, sf_dir):
    return s.rank_segments(s.segment_rates(campaign(spark, sf_dir), "education", TARGET), "education")


@register(
    "rank_within_feature",
    oracle(
        f"""SELECT *, CAST(row_number() OVER (PARTITION BY feature ORDER BY subscription_rate DESC, subscriber_count DESC, segment)
                  AS INTEGER) AS segment_rank
        FROM ({_union(_RANKED, _HALF_UP)}) WHERE client_count >= (SELECT floor(count(*) * 0.01) FROM campaign)"""
    ),
)
def _rank_within_feature(spark, sf_dir):
    features = {name: F.col(column) for name, column in _RANKED.items()}
    rows = campaign(spark, sf_dir)
    smallest = F.floor(rows.agg(F.count(F.lit(1))).scalar() * F.lit(0.01))
    return s.rank_within_feature(s.multi_segment_rates(rows, features, TARGET), smallest)


_SCALABLE = {**_RANKED, "age_group": _CUT_AGE, "balance_group": _BALANCE, "campaign_group": _CONTACTS}


@register(
    "best_scalable_segments",
    oracle(
        f"""SELECT feature, segment, client_count, subscriber_count, subscription_rate
        FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY subscription_rate DESC, subscriber_count DESC, segment) AS rk
              FROM ({" UNION ALL ".join(f"SELECT '{n}' AS feature, {e} AS segment, {_RATES} FROM campaign GROUP BY 2" for n, e in _SCALABLE.items())})
              WHERE client_count >= floor((SELECT count(*) FROM campaign) * 0.01)) WHERE rk = 1"""
    ),
)
def _best_scalable_segments(spark, sf_dir):
    features = {
        **{name: F.col(column) for name, column in _RANKED.items()},
        "age_group": b.band(F.col("age"), b.AGE_EDGES, b.AGE_LABELS),
        "balance_group": b.balance_band(F.col("balance")),
        "campaign_group": b.band(F.col("campaign_contacts"), b.CONTACT_EDGES, b.CONTACT_LABELS),
    }
    return s.best_scalable_segment(campaign(spark, sf_dir), features, TARGET)


@register(
    "top_segments",
    oracle(
        f"""SELECT * FROM ({_union({t: t for t in TEXTS}, _HALF_UP)})
        ORDER BY subscription_rate DESC, feature, segment LIMIT 5"""
    ),
)
def _top_segments(spark, sf_dir):
    rates = s.multi_segment_rates(campaign(spark, sf_dir), TEXTS, TARGET)
    return s.top_k(rates, [F.desc("subscription_rate"), F.col("feature"), F.col("segment")], 5)


@register(
    "best_segment_row",
    oracle(
        f"""SELECT * FROM ({_union({t: t for t in TEXTS}, _HALF_UP)})
        ORDER BY subscription_rate DESC, subscriber_count DESC, feature DESC, segment DESC LIMIT 1"""
    ),
)
def _best_segment_row(spark, sf_dir):
    rates = s.multi_segment_rates(campaign(spark, sf_dir), TEXTS, TARGET)
    return s.argmax_row(rates, ["subscription_rate", "subscriber_count", "feature", "segment"])


@register(
    "running_minimum",
    oracle(
        f"""SELECT feature, segment, client_count, min(subscription_rate) OVER (PARTITION BY feature
               ORDER BY client_count DESC, segment DESC ROWS UNBOUNDED PRECEDING) AS lowest_from_here
        FROM ({_union(_RANKED, _HALF_UP)})"""
    ),
)
def _running_minimum(spark, sf_dir):
    features = {name: F.col(column) for name, column in _RANKED.items()}
    rates = s.multi_segment_rates(campaign(spark, sf_dir), features, TARGET)
    out = s.cumulative_min_reverse(rates, "subscription_rate", ["client_count", "segment"], ["feature"], "lowest_from_here")
    return out.select("feature", "segment", "client_count", "lowest_from_here")


@register(
    "mid_ranks",
    oracle(
        f"""SELECT feature, v AS value, count(*) AS n, any_value(r) + (count(*) - 1) / 2.0::DOUBLE AS mid_rank
        FROM (SELECT feature, v, rank() OVER (PARTITION BY feature ORDER BY v) AS r FROM ({_long(NUMBERS)})) GROUP BY feature, v"""
    ),
)
def _mid_ranks(spark, sf_dir):
    return mid_rank(ranked_histogram(campaign(spark, sf_dir), NUMBERS)).select("feature", "value", "n", "mid_rank")


@register(
    "dense_positions",
    oracle("SELECT campaign_record_id, row_number() OVER (ORDER BY balance, campaign_record_id) AS position FROM campaign"),
)
def _dense_positions(spark, sf_dir):
    return s.dense_positions(campaign(spark, sf_dir).select(KEY, "balance"), ["balance", KEY]).select(KEY, "position")
