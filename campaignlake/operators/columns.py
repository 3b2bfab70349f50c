"""Table-level projections: ordering by category, row subsets, wide to long, column subsets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from campaignlake.functions.bands import category_position

_NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def order_by_category(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Sort a report by a given category order instead of alphabetically."""
    return df.orderBy(category_position(F.col(column), order))


def subsets(sentinel: str) -> dict[str, Column]:
    """Named row subsets of the campaign table."""
    return {"all_clients": F.lit(True), "previously_contacted_clients": F.col(sentinel) >= 0}


def row_filter(df: DataFrame, name: str, named: Mapping[str, Column]) -> DataFrame:
    """Rows of a named subset; an unknown or empty subset is an error."""
    if name not in named:
        raise ValueError(f"Unknown subset: {name}")
    kept = df.where(named[name])
    if kept.isEmpty():
        raise ValueError(f"No rows were found in subset {name}.")
    return kept


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str],
    variable: str = "metric",
    value: str = "score",
    labels: Mapping[str, str] | None = None,
) -> DataFrame:
    """Wide to long; `labels` renames the metric codes and keeps unlisted ones."""
    long = df.unpivot(list(ids), list(columns), variable, value)
    if labels:
        names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        long = long.withColumn(variable, F.coalesce(names[F.col(variable)], F.col(variable)))
    return long


def select_columns(
    df: DataFrame,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    numeric_only: bool = False,
) -> DataFrame:
    """Columns by name and type, in table order unless `include` gives another one."""
    types = dict(df.dtypes)
    names = list(include) if include is not None else df.columns
    return df.select(
        *[
            c
            for c in names
            if c not in set(exclude)
            and (not numeric_only or types[c] in _NUMERIC or types[c].startswith("decimal"))
        ]
    )
