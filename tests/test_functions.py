import math

import pytest
from pyspark.sql import functions as F

from campaignlake.functions import bands as b
from campaignlake.functions.survival import chi_square_tail, normal_two_sided
from campaignlake.functions.text import normalize


def _values(spark, values, dtype, *columns):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_normalize_strips_every_kind_of_white_space(spark):
    found = _values(spark, [" Yes ", "\tNo\n", " UNKNOWN ", "\x1fa b\x1c", None], "string", normalize(F.col("x")))
    assert [r[0] for r in found] == ["yes", "no", "unknown", "a b", None]


def test_age_bands_closed_right_and_by_case(spark):
    x = F.col("x")
    found = _values(spark, [16.0, 17.0, 18.0, 29.0, 29.5, 30.0, 69.0, 70.0, None], "double",
                    b.band(x, b.AGE_EDGES, b.AGE_LABELS), b.age_band(x))
    assert [r[0] for r in found] == [None, "18-29", "18-29", "18-29", "30-39", "30-39", "60-69", "70+", None]
    # The CASE form has no range for 17 or 29.5.
    assert [r[1] for r in found] == ["70+", "70+", "18-29", "18-29", "70+", "30-39", "60-69", "70+", "70+"]


def test_balance_bands_leave_gaps_between_integers(spark):
    values = [-1.0, 0.0, 0.5, 1.0, 1000.0, 1000.5, 1001.0, 5000.0, 5001.0]
    found = [r[0] for r in _values(spark, values, "double", b.balance_band(F.col("x")))]
    assert found == ["Negative balance", "Zero balance", "Unclassified", "1-1,000", "1-1,000", "Unclassified",
                     "1,001-5,000", "1,001-5,000", "Above 5,000"]


def test_sentinel_and_flags(spark):
    x = F.col("x")
    found = _values(spark, [-1, 0, 10], "int", b.sentinel_flag(x), b.sentinel_value(x), b.negative_flag(x))
    assert found == [("no", None, "yes"), ("yes", 0.0, "no"), ("yes", 10.0, "no")]


def test_band_rejects_bad_edges():
    with pytest.raises(ValueError):
        b.band(None, [1, 2], ["a", "b"])
    with pytest.raises(ValueError):
        b.band(None, [2, 1], ["a"])


@pytest.mark.parametrize(
    "x, dof, p",
    [
        (1264.870780300323, 1, 4.868264925585779e-277),
        (1035.714225356292, 2, 1.251738325340638e-225),
        (3.841458820694124, 1, 0.05),
        (7.814727903251179, 3, 0.05),
        (18.307038053275146, 10, 0.05),
        (0.0, 4, 1.0),
    ],
)
def test_chi_square_tail(x, dof, p):
    assert chi_square_tail(x, dof) == pytest.approx(p, rel=1e-9)


def test_chi_square_tail_underflows_to_zero():
    assert chi_square_tail(3061.838938445269, 11) == 0.0


def test_normal_tail():
    assert normal_two_sided(1.959963984540054) == pytest.approx(0.05, rel=1e-12)
    assert normal_two_sided(-0.1) == 1.0
    assert math.isclose(normal_two_sided(0.0), 1.0)
