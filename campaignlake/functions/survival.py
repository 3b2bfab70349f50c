"""Tail probabilities for report-size columns (one row per test)."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Workers get these functions by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def normal_two_sided(z: float) -> float:
    """Two-sided tail of the standard normal, at most 1."""
    return min(1.0, math.erfc(z / math.sqrt(2.0)))


def chi_square_tail(x: float, dof: int) -> float:
    """P(X > x) for a chi-square variable, by the finite series of whole degrees of freedom."""
    if dof < 1:
        raise ValueError("degrees of freedom must be positive")
    if x <= 0:
        return 1.0
    half = x / 2.0
    # Terms run in logs so that large statistics underflow to zero instead of overflowing.
    if dof % 2 == 0:
        total = 0.0
        start, count = 0.0, dof // 2
    else:
        total = math.erfc(math.sqrt(half))
        start, count = 0.5, (dof - 1) // 2
    for step in range(count):
        power = start + step
        total += math.exp(power * math.log(half) - half - math.lgamma(power + 1.0))
    return min(1.0, total)


@F.pandas_udf(DoubleType())
def normal_p_value(z: pd.Series) -> pd.Series:
    return z.map(normal_two_sided, na_action="ignore").astype("float64")


@F.pandas_udf(DoubleType())
def chi_square_p_value(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else chi_square_tail(float(v), int(k)) for v, k in zip(x, dof)],
                     dtype="float64")
