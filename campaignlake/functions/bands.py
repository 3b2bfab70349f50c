"""Bands, labels and flags derived from one column."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# The band edges and labels of the campaign reports.
AGE_LABELS = ["18-29", "30-39", "40-49", "50-59", "60-69", "70+"]
AGE_EDGES = [17, 29, 39, 49, 59, 69, math.inf]
CONTACT_LABELS = ["1 contact", "2-3 contacts", "4-5 contacts", "6-10 contacts", "11+ contacts"]
CONTACT_EDGES = [0, 1, 3, 5, 10, math.inf]
BALANCE_LABELS = ["Negative balance", "Zero balance", "1-1,000", "1,001-5,000", "Above 5,000"]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
TARGET_LABELS = {0: "No subscription", 1: "Subscription"}


def band(column: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands `(e0, e1], (e1, e2], …`; the lowest edge belongs to the first band.

    Values outside the edges and nulls give null.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("band needs one more edge than labels")
    if any(low >= high for low, high in zip(edges, edges[1:])):
        raise ValueError("band edges must increase")
    expression = F.when(column < F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        inside = column.isNotNull() if math.isinf(upper) else column <= F.lit(upper)
        expression = expression.when(inside, F.lit(label))
    return expression


def select_case(cases: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first predicate that holds."""
    if not cases:
        raise ValueError("select_case needs at least one case")
    (condition, label), *others = cases
    expression = F.when(condition, F.lit(label))
    for condition, label in others:
        expression = expression.when(condition, F.lit(label))
    return expression.otherwise(F.lit(default))


def age_band(column: Column) -> Column:
    """Age bands of the SQL report: whatever no closed range covers counts as `70+`."""
    lows = [18, 30, 40, 50, 60]
    ranges = [(column.between(low, high), label)
              for low, high, label in zip(lows, AGE_EDGES[1:], AGE_LABELS)]
    return select_case(ranges, AGE_LABELS[-1])


def contact_band(column: Column) -> Column:
    """Contact-count bands of the SQL report: the rest counts as `11+ contacts`."""
    lows = [1, 2, 4, 6]
    ranges = [(column.between(low, high), label)
              for low, high, label in zip(lows, CONTACT_EDGES[1:], CONTACT_LABELS)]
    return select_case(ranges, CONTACT_LABELS[-1])


def balance_band(column: Column, default: str = "Unclassified") -> Column:
    """Five balance groups; non-integers between the groups fall to `default`."""
    tests = [column < 0, column == 0, column.between(1, 1000), column.between(1001, 5000), column > 5000]
    return select_case(list(zip(tests, BALANCE_LABELS)), default)


def unclassified(column: Column, default: str) -> Column:
    """Aggregate: how many rows a `select_case` column left to its default."""
    return F.count_if(column == F.lit(default))


def label_map(column: Column, labels: Mapping, default: str | None = None) -> Column:
    """Replace codes by labels; codes without a label give `default`."""
    return select_case([(column == F.lit(code), label) for code, label in labels.items()], default)


def yes_no(condition: Column) -> Column:
    """`yes` where the condition holds, otherwise `no`."""
    return F.when(condition, F.lit("yes")).otherwise(F.lit("no"))


def sentinel_flag(column: Column) -> Column:
    """`yes` for a real (non-negative) value, `no` for the sentinel."""
    return yes_no(column >= 0)


def sentinel_value(column: Column) -> Column:
    """The value as a double with the sentinel turned into null."""
    return F.when(column >= 0, column.cast("double"))


def negative_flag(column: Column) -> Column:
    """`yes` for values below zero."""
    return yes_no(column < 0)


def category_position(column: Column, order: Sequence[str]) -> Column:
    """Position of a value in a given order; unknown values sort last."""
    position = F.array_position(F.array(*[F.lit(value) for value in order]), column)
    return F.when(position > 0, position).otherwise(F.lit(len(order) + 1)).cast("int")
