"""Numerics in scientific notation as plain digits, none lost."""

from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tablex.functions.normalize import plain_numeric


def test_exponents_lose_no_digit(spark):
    texts = ["1e-19", "1e21", "-1.50E+3", "+2.5e-1", "12345678901234567890.123456789012345678901e2", ".5e1", "5.e-3", "-0e5", "0.00e-30", "1e0", "120e-1", "-7e-25", "007e1"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string").selectExpr("v", f"{plain_numeric('v', T.StringType())} AS out").collect()
    for r in rows:
        want = format(Decimal(r.v), "f")
        want = want.rstrip("0").rstrip(".") if "." in want else want
        assert r.out == ("0" if Decimal(r.v) == 0 else want), r.v


def test_an_absurd_exponent_fails(spark):
    with pytest.raises(Exception, match="not a number"):
        spark.createDataFrame([("1e999999999",)], "v string").selectExpr(plain_numeric("v", T.StringType())).collect()
