"""Data-quality checks, summaries and cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from campaignlake.functions.bands import label_map
from campaignlake.functions.numbers import fail_rows, percent, to_number
from campaignlake.functions.text import normalize
from campaignlake.operators.scan import bracketed_quantiles
from campaignlake.session import BROADCAST_BYTES, ROW_BYTES, materialize

# The raw campaign file.
RAW_COLUMNS = [
    "age", "job", "marital", "education", "default", "balance", "housing", "loan", "contact",
    "day", "month", "duration", "campaign", "pdays", "previous", "poutcome", "y",
]
TEXT_COLUMNS = ["job", "marital", "education", "default", "housing", "loan", "contact", "month", "poutcome"]
NUMBER_COLUMNS = ["age", "balance", "day", "duration", "campaign", "pdays", "previous"]
TARGET_CODES = {"no": 0, "yes": 1}


@dataclass(frozen=True)
class Rule:
    """One check of a table.

    kind `row`: `condition` holds on every row; nulls pass unless `nulls_fail`.
    kind `total`: `condition` is an aggregate expression that must be true.
    kind `rows`: the row count lies within low..high.
    """

    name: str
    condition: Column | None = None
    kind: str = "row"
    nulls_fail: bool = False
    low: int = 0
    high: int | None = None

    def violations(self) -> Column:
        """Aggregate giving the number of violations."""
        if self.kind == "row":
            return F.count_if(~F.coalesce(self.condition, F.lit(not self.nulls_fail)))
        if self.kind == "total":
            return F.when(F.coalesce(self.condition, F.lit(False)), F.lit(0)).otherwise(F.lit(1)).cast("long")
        if self.kind == "rows":
            count = F.count(F.lit(1))
            fine = count >= self.low
            if self.high is not None:
                fine = fine & (count <= self.high)
            return F.when(fine, F.lit(0)).otherwise(F.lit(1)).cast("long")
        raise ValueError(f"unknown rule kind {self.kind!r}")


def range_rules(names: Mapping[str, str] | None = None) -> list[Rule]:
    """Range rules of the campaign columns; `names` maps short names to actual ones."""
    col = lambda short: F.col((names or {}).get(short, short))
    return [
        Rule("age_positive", col("age") > 0),
        Rule("day_in_month", col("day").between(1, 31), nulls_fail=True),
        Rule("duration_not_negative", col("duration") >= 0),
        Rule("campaign_at_least_one", col("campaign") >= 1),
        Rule("pdays_at_least_minus_one", col("pdays") >= -1),
        Rule("previous_not_negative", col("previous") >= 0),
    ]


def rule_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations) for all rules, in one aggregation."""
    found = df.agg(*[rule.violations().alias(f"r{i}") for i, rule in enumerate(rules)])
    pairs = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(rules)]
    )
    return found.select(F.inline(pairs))


def require_rules(df: DataFrame, rules: Sequence[Rule], subject: str = "table") -> None:
    """Raise a `ValueError` naming every rule that fails."""
    failed = [
        f"{row['rule']} ({row['violations']})" for row in rule_violations(df, rules).collect() if row["violations"]
    ]
    if failed:
        raise ValueError(f"Checks failed on {subject}: " + ", ".join(failed))


# Post-conditions on report tables use the same engine.
check_report = require_rules


def schema_differences(spark, columns: Sequence[str], expected: Sequence[str]) -> DataFrame:
    """(column, problem) rows: missing, unexpected, or out of order."""
    problems = [(c, "missing") for c in sorted(set(expected) - set(columns))]
    problems += [(c, "unexpected") for c in sorted(set(columns) - set(expected))]
    if not problems and list(columns) != list(expected):
        problems = [(c, "out of order") for c, e in zip(columns, expected) if c != e]
    return spark.createDataFrame(problems, "column string, problem string")


def check_schema(df: DataFrame, expected: Sequence[str]) -> None:
    """Exact ordered column match."""
    if df.columns == list(expected):
        return
    missing = sorted(set(expected) - set(df.columns))
    unexpected = sorted(set(df.columns) - set(expected))
    raise ValueError(f"Unexpected schema. Missing columns: {missing}. Unexpected columns: {unexpected}.")


def value_counts(df: DataFrame, columns: Sequence[str], normal: bool = False) -> DataFrame:
    """(column, value, n) for many columns in one pass; null is a value of its own."""
    texts = [(normalize(F.col(c)) if normal else F.col(c).cast("string")).alias(f"_v{i}") for i, c in enumerate(columns)]
    long = df.select(*texts).unpivot([], [f"_v{i}" for i in range(len(columns))], "_name", "value")
    names = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (f"_v{i}", c)])
    counted = long.groupBy("_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(names[F.col("_name")].alias("column"), "value", "n")


def domain_report(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """(column, value, n, status): each value found or expected, after trimming and lower-casing.

    Status is `ok`, `unexpected` or `missing`; nulls are ignored.
    """
    spark = df.sparkSession
    allowed = spark.createDataFrame(
        [(c, v) for c, values in domains.items() for v in values], "column string, value string"
    ).withColumn("allowed", F.lit(True))
    counted = value_counts(df, list(domains), normal=True).where(F.col("value").isNotNull())
    joined = counted.join(allowed, ["column", "value"], "full")
    status = (
        F.when(F.col("n").isNull(), F.lit("missing"))
        .when(F.col("allowed").isNull(), F.lit("unexpected"))
        .otherwise(F.lit("ok"))
    )
    return joined.select("column", "value", F.coalesce("n", F.lit(0)).alias("n"), status.alias("status"))


def check_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> None:
    """The normalised values of a column must equal a given set."""
    problems = domain_report(df, {column: allowed}).where(F.col("status") != "ok")
    # How many there are in all, and the first of each kind by name as examples.
    found = problems.groupBy("status").agg(
        F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"), F.min("value").alias("example")
    ).orderBy("status").collect()
    if found:
        listed = "; ".join(
            f"{r['example']} ({r['status']}), {r['values']} such values in {r['rows']} rows" for r in found)
        raise ValueError(f"Unexpected values in {column}: {listed}. Expected: {sorted(allowed)}.")


def count_profile(df: DataFrame, target: str, key: str | None = None) -> DataFrame:
    """One row: row count, positives, negatives, null targets and (with a key) surplus key rows."""
    aggregates = [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(target) == 1).alias("positives"),
        F.count_if(F.col(target) == 0).alias("negatives"),
        F.count_if(F.col(target).isNull()).alias("null_targets"),
    ]
    if key is not None:
        aggregates.append((F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_keys"))
    return df.agg(*aggregates)


def check_counts(df: DataFrame, target: str, expected: Mapping[str, int], key: str | None = None) -> None:
    """Compare `count_profile` with expected numbers; raise on any difference."""
    found = count_profile(df, target, key).first().asDict()
    wrong = [f"{name}: {found[name]} instead of {value}" for name, value in expected.items() if found[name] != value]
    if wrong:
        raise ValueError("Unexpected counts. " + "; ".join(wrong))


def _per_column(row: DataFrame, columns: Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """Turn one wide row into a row per column; `fields` maps output names to alias prefixes."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{prefix}{i}").alias(out) for out, prefix in fields.items()])
        for i, c in enumerate(columns)
    ]
    return row.select("_rows", F.inline(F.array(*structs)))


def missing_summary(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_percentage) for every column, one aggregation."""
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    return _per_column(row, df.columns, {"missing_count": "m"}).select(
        "column", "missing_count", percent(F.col("missing_count"), F.col("_rows"), 2, True).alias("missing_percentage")
    )


def unknown_summary(df: DataFrame, columns: Sequence[str], token: str = "unknown") -> DataFrame:
    """(column, unknown_count, unknown_percentage) of an explicit token, most frequent first."""
    counts = [F.count_if(normalize(F.col(c)) == token).alias(f"u{i}") for i, c in enumerate(columns)]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    return (
        _per_column(row, columns, {"unknown_count": "u"})
        .select(
            "column",
            "unknown_count",
            percent(F.col("unknown_count"), F.col("_rows"), 2, True).alias("unknown_percentage"),
        )
        .orderBy(F.desc("unknown_count"), "column")
    )


def outlier_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, 1.5 * IQR fences and values outside them, per column; bad text drops out.

    Quartiles are exact and come from sketches that bracket them; the values outside all fences are counted
    in one more pass. Nothing is shuffled by value but what lies in the brackets.
    """
    parsed = {c: to_number(F.col(c), "coerce") for c in columns}
    # One row per column.
    quartiles = materialize(bracketed_quantiles(df, parsed, {"q1": 0.25, "q3": 0.75}), "quartiles")
    outside = []
    for r in quartiles.collect():
        reach = 1.5 * (r["q3"] - r["q1"])
        value = parsed[r["feature"]].cast("double")
        outside.append(F.struct(F.lit(r["feature"]).alias("feature"), F.count_if(
            (value < r["q1"] - reach) | (value > r["q3"] + reach)).alias("potential_outlier_count")))
    shape = "array<struct<feature:string,potential_outlier_count:bigint>>"
    counted = df.agg(F.array(*outside).cast(shape).alias("x")).select(F.inline("x"))
    iqr = F.col("q3") - F.col("q1")
    fences = {"q1": F.col("q1"), "q3": F.col("q3"), "iqr": iqr, "lower_bound": F.col("q1") - F.lit(1.5) * iqr,
              "upper_bound": F.col("q3") + F.lit(1.5) * iqr}
    return counted.join(quartiles, "feature").select(
        F.col("feature").alias("column"),
        *[F.bround(x, 2).alias(name) for name, x in fences.items()],
        "potential_outlier_count",
        percent(F.col("potential_outlier_count"), F.col("total_n"), 2, True).alias("potential_outlier_percentage"),
    )


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names stripped and lower-cased."""
    return df.toDF(*[name.strip().lower() for name in df.columns])


def normalize_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns stripped and lower-cased."""
    return df.withColumns({c: normalize(F.col(c)) for c in columns})


def to_numeric(df: DataFrame, columns: Sequence[str], errors: str = "raise", dtype: str = "double") -> DataFrame:
    """Columns parsed to numbers; see `to_number`."""
    return df.withColumns({c: to_number(F.col(c), errors, dtype) for c in columns})


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One row per combination of all columns; copies meet in the map-side aggregation first."""
    return df.dropDuplicates()


def repeated_digests(df: DataFrame) -> DataFrame:
    """(_h, _g, _n): 128-bit row digests that occur more than once, and how often.

    Equal rows have equal digests. Digests of different rows may be equal too, if rarely, so what a digest
    selects has to be compared by value.
    """
    digests = df.select(*_row_digest(df))
    return digests.groupBy("_h", "_g").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def _row_digest(df: DataFrame) -> list[Column]:
    cells = [F.col(f"`{c}`") for c in df.columns]
    # A null leaves a running hash as it is, so the second half also covers which cells are null.
    gaps = F.concat(F.lit(""), *[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cells])
    return [F.xxhash64(*cells).alias("_h"), F.xxhash64(gaps, *cells).alias("_g")]


def drop_repeated_rows(df: DataFrame) -> DataFrame:
    """`drop_exact_duplicates` in two phases, for wide tables with few copies.

    First only digests are shuffled. Rows whose digest occurs once stay where they are; the others meet
    whole and are compared by value. If the repeated digests are too many to broadcast, all rows meet
    whole, as most of them would have to anyway. `df` is read three times and must give the same rows
    each time; columns named _h, _g and _n must not be in it.
    """
    repeated = materialize(repeated_digests(df).select("_h", "_g"), "digests")
    if repeated.count() * ROW_BYTES > BROADCAST_BYTES:
        return df.dropDuplicates()
    hashed = df.select("*", *_row_digest(df))
    once = hashed.join(F.broadcast(repeated), ["_h", "_g"], "left_anti").select(df.columns)
    copies = hashed.join(F.broadcast(repeated), ["_h", "_g"], "left_semi").select(df.columns)
    return once.unionByName(copies.dropDuplicates())


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one exactly."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def encode_target(df: DataFrame, column: str, codes: Mapping[str, int] = TARGET_CODES, out: str = "subscribed") -> DataFrame:
    """Replace the target text by its code; a value without a code fails the job."""
    code = label_map(F.col(column), {k: str(v) for k, v in codes.items()}).cast("tinyint")
    message = F.concat(F.lit("Target encoding found an unmapped value: "), F.coalesce(column, F.lit("null")))
    return fail_rows(df, code.isNull(), message).withColumn(out, code).drop(column)


def prepare(df: DataFrame, balance_errors: str = "raise") -> DataFrame:
    """Normalised text and integer columns, before range checks and duplicate removal."""
    renamed = normalize_names(df)
    text = normalize_text(renamed, [*TEXT_COLUMNS, "y"])
    plain = [c for c in NUMBER_COLUMNS if c != "balance"]
    return to_numeric(to_numeric(text, plain, "raise", "int"), ["balance"], balance_errors, "int")


def clean(df: DataFrame, balance_errors: str = "raise", domain: bool = True) -> DataFrame:
    """Schema and domain check, normalisation, numbers, range checks, duplicates, target code."""
    check_schema(df, RAW_COLUMNS)
    if domain:
        check_domain(df, "y", list(TARGET_CODES))
    prepared = prepare(df, balance_errors)
    require_rules(prepared, range_rules(), "the cleaned table")
    return encode_target(drop_exact_duplicates(prepared), "y")


def quality_overview(raw: DataFrame, cleaned: DataFrame, target: str = "subscribed") -> DataFrame:
    """Eleven (metric, value) rows; one aggregation over each table.

    `cleaned` must be `raw` without its exact duplicates, so their number is the row difference.
    """

    def nulls(df: DataFrame) -> Column:
        total = F.lit(0).cast("long")
        for c in df.columns:
            total = total + F.count_if(F.col(c).isNull())
        return total

    unknown = F.lit(0).cast("long")
    for c in TEXT_COLUMNS:
        unknown = unknown + F.count_if(normalize(F.col(c)) == "unknown")
    after = cleaned.agg(
        F.struct(
            F.count(F.lit(1)).alias("clean_rows"),
            nulls(cleaned).alias("clean_missing"),
            F.count_if(F.col(target) == 0).alias("negatives"),
            F.count_if(F.col(target) == 1).alias("positives"),
        )
    ).scalar()
    both = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"), nulls(raw).alias("raw_missing"), unknown.alias("unknown")
    ).select("*", after.alias("_after")).select("*", "_after.*")
    removed = F.col("raw_rows") - F.col("clean_rows")
    metrics = {
        "raw_rows": F.col("raw_rows"),
        "raw_columns": F.lit(len(raw.columns)).cast("long"),
        "cleaned_rows": F.col("clean_rows"),
        "cleaned_columns": F.lit(len(cleaned.columns)).cast("long"),
        "exact_duplicates_found": removed,
        "exact_duplicates_removed": removed,
        "raw_missing_cells": F.col("raw_missing"),
        "cleaned_missing_cells": F.col("clean_missing"),
        "explicit_unknown_values": F.col("unknown"),
        "non_subscribers": F.col("negatives"),
        "subscribers": F.col("positives"),
    }
    pairs = [F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in metrics.items()]
    return both.select(F.inline(F.array(*pairs)))


def schema_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null_count, distinct_count); a null counts as one distinct value."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return (
        value_counts(df, df.columns)
        .groupBy("column")
        .agg(
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(F.lit(0))).alias("non_null_count"),
            F.count(F.lit(1)).alias("distinct_count"),
        )
        .select("column", types[F.col("column")].alias("dtype"), "non_null_count", "distinct_count")
    )


# Distinct counts of a sketch with 2**SKETCH_BITS registers are within this share, three standard errors.
SKETCH_BITS = 14
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def store_sketches(df: DataFrame, path: str, part: Column | None = None) -> None:
    """Append (part, column, rows, non_null_count, sketch) of every column to the table at `path`.

    One pass and one HyperLogLog sketch per part and column: what is stored does not grow with the rows.
    New parts of a table are sketched alone, when they come.
    """
    named = df.select((part if part is not None else F.lit("")).cast("string").alias("_part"), *[
        F.col(f"`{c}`").cast("string").alias(f"_c{i}") for i, c in enumerate(df.columns)])
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(df.columns)):
        aggregates += [F.count(f"_c{i}").alias(f"n{i}"), F.hll_sketch_agg(f"_c{i}", F.lit(SKETCH_BITS)).alias(f"s{i}")]
    wide = named.groupBy("_part").agg(*aggregates)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("non_null_count"), F.col(f"s{i}").alias("sketch"))
                      for i, c in enumerate(df.columns)])
    wide.select(F.col("_part").alias("part"), "rows", F.inline(cells)).write.mode("append").parquet(path)


def sketched_profile(spark, path: str) -> DataFrame:
    """(column, non_null_count, distinct_estimate) of all parts together, from stored sketches alone.

    A null counts as one distinct value, as in `schema_profile`. Estimates are within SKETCH_ERROR of the
    exact count, but for one table in several hundred.
    """
    merged = spark.read.parquet(path).groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("non_null_count").alias("non_null_count"), F.hll_union_agg("sketch").alias("sketch"))
    has_null = (F.col("rows") > F.col("non_null_count")).cast("long")
    return merged.select("column", "non_null_count", (F.hll_sketch_estimate("sketch") + has_null).alias("distinct_estimate"))


def column_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column, change): columns removed from and added to a table."""
    rows = [(c, "removed") for c in before.columns if c not in after.columns]
    rows += [(c, "added") for c in after.columns if c not in before.columns]
    return before.sparkSession.createDataFrame(rows, "column string, change string")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Rows (keys…, column, left_value, right_value) where two results disagree; empty when equal.

    Row order and numeric types do not matter. A key on one side only is reported as `<row>`.
    """
    values = [c for c in left.columns if c not in keys]
    if set(values) != {c for c in right.columns if c not in keys}:
        raise ValueError("reconcile needs the same columns on both sides")
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(left.dtypes)
    a, b = left.alias("a").withColumn("_in", F.lit(True)), right.alias("b").withColumn("_in", F.lit(True))
    a = a.select(*[F.col(c).alias(f"a_{c}") for c in [*keys, *values, "_in"]])
    b = b.select(*[F.col(c).alias(f"b_{c}") for c in [*keys, *values, "_in"]])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}"))
    joined = a.join(b, condition, "full")
    one_sided = F.col("a__in").isNull() | F.col("b__in").isNull()

    def differs(c: str) -> Column:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        if types[c] in numeric or types[c].startswith("decimal"):
            close = F.abs(x.cast("double") - y.cast("double")) <= F.lit(float(tolerance))
            return ~F.coalesce(close, x.isNull() & y.isNull())
        return ~x.eqNullSafe(y)

    cells = [
        F.when(
            ~one_sided & differs(c),
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"a_{c}").cast("string").alias("left_value"),
                F.col(f"b_{c}").cast("string").alias("right_value"),
            ),
        )
        for c in values
    ]
    missing = F.when(
        one_sided,
        F.struct(
            F.lit("<row>").alias("column"),
            F.col("a__in").cast("string").alias("left_value"),
            F.col("b__in").cast("string").alias("right_value"),
        ),
    )
    return joined.select(
        *[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys],
        F.inline(F.array_compact(F.array(missing, *cells))),
    )
