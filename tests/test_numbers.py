from __future__ import annotations

import random

import pytest

from gradeframe.functions.numbers import fixed_text, round_exact


@pytest.mark.parametrize("digits", [2, 3, 4, 6])
def test_rounding_agrees_with_python(spark, digits):
    rng = random.Random(7)
    ties = [k / 2**e for e in range(1, 14) for k in range(0, 2**e, max(1, 2**e // 64))]
    near = [
        (k + 0.5) / 10**digits + d for k in range(300) for d in (0.0, 1e-17, -1e-17, 1e-12, -1e-12)
    ]
    fixed = [0.0, 1.0, 2.675, 0.00005, 0.12345, 1e-12, 0.99999999, 50.0, 33.333333]
    large = [rng.uniform(0, 2**52 / 10**digits) for _ in range(500)]
    values = [abs(v) for v in fixed + ties + near + large + [rng.random() for _ in range(2000)]]
    values += [-v for v in values if v]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", round_exact("x", digits).alias("n"), fixed_text("x", digits).alias("t"))
    for r in rows.collect():
        assert r.n == round(r.x, digits), repr(r.x)
        assert r.t == f"{r.x:.{digits}f}", repr(r.x)


@pytest.mark.parametrize("value", [1e300, -1e18, float("inf"), float("nan")])
def test_values_that_cannot_be_scaled_fail(spark, value):
    df = spark.createDataFrame([(value,), (None,)], "x double")
    for rounded in (round_exact("x", 4), fixed_text("x", 4)):
        with pytest.raises(Exception, match="of zero"):
            df.select(rounded).collect()
        assert df.filter("x IS NULL").select(rounded).first()[0] is None
