import pytest
from pyspark.sql import types as T

from tablex import actual_kinds, declared, expected_kinds, with_numeric_type


@pytest.mark.parametrize(
    "name, kind, precision, scale",
    [
        ("boolean", "bool", None, None),
        ("smallint", "int32", None, None),
        ("int4", "int32", None, None),
        ("bigint", "int64", None, None),
        ("real", "float32", None, None),
        ("double precision", "float64", None, None),
        ("numeric", "numeric", None, None),
        ("numeric(10,2)", "numeric", 10, 2),
        ("NUMERIC(10, 2)", "numeric", 10, 2),
        ("numeric(38)", "numeric", 38, 0),
        ("numeric(2,-3)", "numeric", 2, -3),
        ("date", "date", None, None),
        ("time(3) without time zone", "time", None, None),
        ("timestamp without time zone", "timestamp", None, None),
        ("timestamp(3) with time zone", "timestamptz", None, None),
        ("character(4)", "char", None, None),
        ("bpchar", "char", None, None),
        ("character varying(8)", "text", None, None),
        ("time with time zone", "text", None, None),
        ("integer[]", "text", None, None),
        ("numeric(10,2)[]", "text", None, None),
        ("jsonb", "text", None, None),
        ('"char"', "text", None, None),
    ],
)
def test_declared(name, kind, precision, scale):
    found = declared(name)
    assert (found.kind, found.precision, found.scale) == (kind, precision, scale)


@pytest.mark.parametrize(
    "name, exact",
    [
        ("numeric", False),
        ("numeric(16,6)", True),
        ("numeric(17,6)", False),
        ("numeric(60,2)", False),
        ("numeric(2,-3)", False),
        ("numeric(2,3)", False),
        ("numeric(3,3)", True),
    ],
)
def test_exact_in_decimal_mode(name, exact):
    assert declared(name).exact is exact
    assert isinstance(declared(name).spark_type(decimal=True), T.DecimalType) is exact
    assert declared(name).spark_type() == T.DoubleType()


def test_type_modifiers(spark):
    rows = [
        (-1, None, None),
        ((10 << 16 | 2) + 4, 10, 2),
        ((38 << 16) + 4, 38, 0),
        ((2 << 16 | (-3 & 0x7FF)) + 4, 2, -3),
        ((1000 << 16 | (-1000 & 0x7FF)) + 4, 1000, -1000),
    ]
    df = with_numeric_type(spark.createDataFrame([(r[0],) for r in rows], "atttypmod int"))
    assert [tuple(r) for r in df.collect()] == rows


def test_expected_kinds(spark):
    cases = {
        "boolean": "bool",
        "smallint": "int",
        "bigint": "int",
        "real": "float32",
        "double precision": "float",
        "numeric": "float",
        "numeric(10,2)": "decimal",
        "numeric(17,4)": "float",
        "numeric(2,-3)": "float",
        "date": "date",
        "time without time zone": "time",
        "timestamp without time zone": "timestamp",
        "timestamp with time zone": "timestamptz",
        "character(4)": "string",
        "integer[]": "string",
        "uuid": "string",
    }
    types = spark.createDataFrame([(name,) for name in cases], "type string")
    assert {r.type: r.kind for r in expected_kinds(types, decimal=True).collect()} == cases
    plain = {r.type: r.kind for r in expected_kinds(types).collect()}
    assert plain == cases | {"numeric(10,2)": "float"}


def test_actual_kinds(spark):
    df = spark.sql(
        "SELECT true b, 1 i, 1L l, 1.5F f, 1.5D d, 1.50 n, date'2020-01-01' dt, "
        "timestamp'2020-01-01' tz, timestamp_ntz'2020-01-01' ts, CAST('09:00:00' AS TIME(6)) tm, "
        "'x' s, array(1) a"
    )
    kinds = [r.kind for r in actual_kinds(df).orderBy("ordinal").collect()]
    assert kinds == [
        "bool", "int", "int", "float32", "float", "decimal", "date", "timestamptz", "timestamp",
        "time", "string", "other",
    ]
