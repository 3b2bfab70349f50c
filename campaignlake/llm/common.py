"""What the operators of this package share: table reading, word splitting, Arrow helpers."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize, scratch_path

__all__ = ["materialize", "scratch_path", "table", "text_or_empty", "words", "parallel", "row_key", "worker_state", "grouped"]

# Workers get the functions of this package by value, so it need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The characters that separate words, the space and U+0009 to U+000D.
SEPARATORS = " \t\n\x0b\x0c\r"

NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs of other characters than SEPARATORS."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def parallel(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_column: str, text_column: str) -> list[Column]:
    """Key of a document row: its id and a hash of its text.

    Rows that repeat both are interchangeable, so they may share results; rows that share only the
    id, or hold no id, stay apart by their texts. A missing id is the smallest long, so that keys join
    by plain equality.
    """
    known = F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID))
    return [known.alias("key_id"), F.xxhash64(F.col(text_column)).alias("key_text")]


def worker_state(name: str, make):
    """An object that a Python worker keeps from task to task, such as a cache; made on first use.

    Functions come to workers by value, anew for each task, so their own globals would not last.
    """
    holder = sys.modules.setdefault("campaignlake_worker_state", types.ModuleType("campaignlake_worker_state"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def grouped(function, texts: list, size: int = 2_000_000):
    """Results of `function`, which takes a list, over runs of texts of about `size` characters."""
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held >= size:
            yield from function(run)
            run, held = [], 0
    if run:
        yield from function(run)
