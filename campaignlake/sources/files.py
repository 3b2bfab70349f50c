"""Delimited files, reports, metadata records, stored tables and fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from campaignlake.operators.quality import Rule, check_counts, check_domain, check_schema, require_rules
from campaignlake.operators.scan import ordered_scan


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ";", mode: str = "FAILFAST"
) -> DataFrame:
    """Delimited file with a header, read with a given schema (no inference pass)."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", True).option("mode", mode)
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"File not found: {path}") from error
        raise


def read_clean(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    target: str = "subscribed",
    expected: Mapping[str, int] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Load a cleaned table (Parquet, or CSV when a schema is given) and check it.

    Checks the ordered columns, that nothing is null, that the target holds 0 and 1, and any
    expected counts (see `count_profile`).
    """
    df = spark.read.parquet(path) if schema is None else read_delimited(spark, path, schema, ",")
    check_schema(df, columns)
    require_rules(df, [Rule(f"{c}_not_null", F.col(c).isNotNull()) for c in columns], path)
    check_domain(df, target, ["0", "1"])
    if expected:
        check_counts(df, target, expected)
    return df


def write_report(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Overwrite one named report; its files keep the frame's partitions.

    `single_file` is for reports of bounded size: their rows move to one task at the very end, so
    that the work before them stays spread.
    """
    out = df.repartition(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_metadata(record: DataFrame, path: str) -> None:
    """Write a one-row record (nested structs allowed) as JSON."""
    record.repartition(1).write.mode("overwrite").json(path)


def read_metadata(
    spark: SparkSession, path: str, schema: StructType | str, required: Sequence[str], threshold: str | None = None
) -> DataFrame:
    """Read a one-row JSON record and reject an incomplete one.

    Fails when the record is empty, a required field is missing, the threshold lies outside 0..1,
    or `test_set_used` (if in the schema) is anything but false.
    """
    try:
        record = spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"Metadata not found: {path}") from error
        raise
    rules = [Rule("one_record", kind="rows", low=1, high=1)]
    rules += [Rule(f"has_{name}", F.col(name).isNotNull()) for name in required]
    if threshold is not None:
        rules.append(Rule("threshold_in_0_1", F.col(threshold).between(0, 1), nulls_fail=True))
    if "test_set_used" in record.columns:
        rules.append(Rule("test_set_unused", ~F.col("test_set_used"), nulls_fail=True))
    require_rules(record, rules, path)
    return record


def load_table(
    df: DataFrame,
    name: str | None,
    rename: Mapping[str, str],
    key: str,
    order_by: Sequence[str],
    columns: Sequence[str] | None = None,
    save: bool = False,
) -> DataFrame:
    """Rename columns, number the rows 1..n in `order_by` order and register the result.

    `order_by` must be unique. The key comes from an ordered scan, so no task sees all rows.
    With `save`, rows are appended to the table `name` and their keys go on after its largest;
    otherwise `name` becomes a temporary view.
    """
    numbered = ordered_scan(df.withColumn("_one", F.lit(1).cast("long")), order_by, sums=["_one"])
    out = numbered.withColumnRenamed("cum__one", key).drop("_one").withColumnsRenamed(dict(rename))
    spark = df.sparkSession
    if name is not None and save and spark.catalog.tableExists(name):
        last = spark.table(name).agg(F.max(key)).first()[0] or 0
        out = out.withColumn(key, F.col(key) + F.lit(last))
    if columns is not None:
        missing = sorted(set(columns) - set(out.columns))
        if missing:
            raise ValueError(f"Columns of the expected SQL schema are not in the source: {missing}")
        out = out.select(*columns)
    if name is not None and save:
        out.write.mode("append").saveAsTable(name)
    elif name is not None:
        out.createOrReplaceTempView(name)
    return out


def fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """One row: SHA-256 over the per-file hashes below `path`, the file count and bytes.

    Files are hashed on the executors. Their digests are combined in two levels, first within the
    4,096 groups of equal leading digits, so no task gathers the digests of all files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.sha2("content", 256).alias("digest"), F.col("length"))
    )

    def combined(column: str):
        return F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(column))).cast("binary"), 256)

    return (
        files.groupBy(F.substring("digest", 1, 3).alias("_lead"))
        .agg(combined("digest").alias("digest"), F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .agg(combined("digest").alias("sha256"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
    )


def content_fingerprint(df: DataFrame) -> DataFrame:
    """One row: SHA-256 over the rows of a table, whatever their order and files, and the row count.

    A row's digest covers its columns as text, nulls as empty, in column order. Digests are combined in
    three levels, within equal leading six and then three digits, so a task holds a small share of them.
    """
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    hashed = df.select(F.sha2(text.cast("binary"), 256).alias("digest"), F.lit(1).cast("long").alias("rows"))
    level = hashed.withColumn("lead", F.substring("digest", 1, 6))
    whole = F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list("digest"))).cast("binary"), 256).alias("digest")
    rows = F.sum("rows").alias("rows")
    inner = level.groupBy("lead").agg(whole, rows)
    outer = inner.groupBy(F.substring("lead", 1, 3).alias("lead")).agg(whole, rows)
    return outer.agg(whole.alias("sha256"), F.coalesce(rows, F.lit(0).cast("long")).alias("rows"))


def load_report_set(
    spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, StructType | str]
) -> dict[str, DataFrame]:
    """Load named reports written earlier; fail listing every one that is missing."""
    loaded, missing = {}, []
    for name, path in paths.items():
        try:
            loaded[name] = read_delimited(spark, path, schemas[name], ",")
        except FileNotFoundError:
            missing.append(name)
    if missing:
        raise FileNotFoundError(f"Reports are missing: {sorted(missing)}")
    return loaded
