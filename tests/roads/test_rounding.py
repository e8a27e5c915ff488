"""Shares are rounded as SQL rounds them."""

import math

from pyspark.sql import functions as F

from kerbline.operators.authority import _rounded


def test_scaled_halves_round_up(spark):
    """0.45 may be 0.44999999999999996 and yet 4.5 when scaled, which SQL rounds to 0.5."""
    values = [14.499999999999998, 1.005, 0.44999999999999996, -0.44999999999999996, 2.5, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(_rounded(F.col("x"), 1)).collect()] == [math.copysign(math.floor(abs(v * 10) + 0.5), v) / 10 if v is not None else None for v in values]
    assert [r[0] for r in df.select(_rounded(F.col("x"), 1)).collect()][2] == 0.5
