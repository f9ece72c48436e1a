import math
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tablex import encode_temporal, normalize

DAYS = 2**31 - 1
MICROS = 2**63 - 1


def column(spark, type_name, values, decimal=False, encode=False):
    """Texts through `normalize`, as (Spark type, values)."""
    texts = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    df = normalize(texts, {"c": type_name}, decimal)
    dtype = df.schema["c"].dataType
    assert df.schema["c"].metadata["source_type"] == type_name
    if encode:
        df = encode_temporal(df)
    return dtype, [r.c for r in sorted(df.collect(), key=lambda r: r.i)]


@pytest.mark.parametrize(
    "type_name, dtype, texts, want",
    [
        ("boolean", T.BooleanType(), ["t", "f", None], [True, False, None]),
        ("smallint", T.IntegerType(), ["0", "-32768", "32767", None], [0, -32768, 32767, None]),
        ("integer", T.IntegerType(), ["2147483647", "-2147483648"], [2147483647, -2147483648]),
        ("bigint", T.LongType(), ["9223372036854775807", "0"], [2**63 - 1, 0]),
        ("text", T.StringType(), ["", "  a ", None, "é\t\n"], ["", "  a ", None, "é\t\n"]),
        ("varchar(4)", T.StringType(), ["AB  ", " "], ["AB  ", " "]),
        ("character(4)", T.StringType(), ["AB  ", "    ", "  a ", None, "a\t "], ["AB", "", "  a", None, "a\t"]),
        ("jsonb", T.StringType(), ['{"a": 1}', None], ['{"a": 1}', None]),
        ("integer[]", T.StringType(), ["{1,2,NULL}", "{}"], ["{1,2,NULL}", "{}"]),
        ("interval", T.StringType(), ["1 day 02:00:00"], ["1 day 02:00:00"]),
        ("uuid", T.StringType(), ["a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"], ["a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"]),
    ],
)
def test_plain_types(spark, type_name, dtype, texts, want):
    assert column(spark, type_name, texts) == (dtype, want)


@pytest.mark.parametrize("type_name", ["real", "double precision", "numeric", "numeric(10,2)"])
def test_floats(spark, type_name):
    texts = ["0", "-0", "1.5", "Infinity", "-Infinity", "NaN", None]
    dtype, got = column(spark, type_name, texts)
    assert dtype == (T.FloatType() if type_name == "real" else T.DoubleType())
    assert [repr(v) for v in got] == ["0.0", "-0.0", "1.5", "inf", "-inf", "nan", "None"]


def test_numeric_as_double_rounds_correctly(spark):
    _, got = column(spark, "numeric(16,6)", ["-9999999999.999999", "1234567890.1"])
    assert got == [-9999999999.999998, 1234567890.1]


def test_numeric_as_decimal(spark):
    dtype, got = column(spark, "numeric(10,2)", ["12.34", "-0.5", "NaN", None, "300", "0"], True)
    assert dtype == T.DecimalType(10, 2)
    assert got == [Decimal("12.34"), Decimal("-0.50"), None, None, Decimal("300"), Decimal("0")]
    dtype, got = column(spark, "numeric(16,6)", ["-9999999999.999999"], True)
    assert (dtype, got) == (T.DecimalType(16, 6), [Decimal("-9999999999.999999")])
    dtype, got = column(spark, "numeric(17,6)", ["0.5", "NaN"], True)
    assert dtype == T.DoubleType() and got[0] == 0.5 and math.isnan(got[1])
    assert column(spark, "numeric", ["-Infinity"], True) == (T.DoubleType(), [-math.inf])


def test_decimal_digits_beyond_the_scale_are_cut(spark):
    texts = ["12.345", "-12.349", "0.009", "-0.009", "1.5e2", "0.99999999999999999999999999"]
    want = [Decimal(t) for t in ("12.34", "-12.34", "0.00", "0.00", "150.00", "0.99")]
    assert column(spark, "numeric(10,2)", texts, True)[1] == want
    native = spark.sql("SELECT -12.349BD AS a, 12.345D AS b, double('NaN') AS c, 7 AS d")
    types = dict.fromkeys("abcd", "numeric(10,2)")
    assert tuple(normalize(native, types, True).first()) == (
        Decimal("-12.34"), Decimal("12.34"), None, Decimal("7.00"),
    )


def test_dates(spark):
    texts = ["1969-12-30", "2024-02-29", "10000-01-01", "-infinity", None, "infinity"]
    dtype, got = column(spark, "date", texts, encode=True)
    assert dtype == T.DateType()
    assert got == [-2, 19782, 2932897, -DAYS, None, DAYS]


def test_times(spark):
    dtype, got = column(spark, "time", ["06:00:00.5", "21:12:48.000032", None], encode=True)
    assert dtype == T.TimeType(6)
    assert got == [21600500000, 76368000032, None]


def test_timestamps(spark):
    texts = ["1969-12-31 23:59:58.75", "2024-02-29 12:00:00", "-infinity", None, "infinity"]
    dtype, got = column(spark, "timestamp", texts, encode=True)
    assert dtype == T.TimestampNTZType()
    assert got == [-1250000, 1709208000000000, -MICROS, None, MICROS]


def test_timestamps_with_zone(spark):
    texts = ["2024-02-29 21:00:00+09", "2024-02-29 06:15:00-05:45", "1969-12-31 23:00:00-01", "-infinity", None, "infinity"]
    dtype, got = column(spark, "timestamptz", texts, encode=True)
    assert dtype == T.TimestampType()
    noon = 1709208000000000
    assert got == [noon, noon, 0, -MICROS, None, MICROS]


@pytest.mark.parametrize(
    "type_name, text",
    [
        ("integer", "x"),
        ("integer", "1.5"),
        ("smallint", "99999999999"),
        ("bigint", ""),
        ("double precision", "1,5"),
        ("double precision", "1.5d"),
        ("numeric", "2f"),
        ("numeric(4,2)", "12345.67"),
        ("date", "2020-01-02 10:00:00"),
        ("date", "2020-13-01"),
        ("date", "2020"),
        ("date", "2020-01-2 "),
        ("date", "2020-01-02 x"),
        ("numeric(10,2)", "12.34abc"),
        ("numeric(10,2)", "1.23.45"),
        ("numeric(10,2)", "1.50d"),
        ("numeric(10,2)", "1.50 "),
        ("numeric(10,2)", ""),
        ("timestamp", "2020-01-01 10:00:00+05"),
        ("timestamp", "2020-01-01 10:00:00-05:30"),
        ("timestamp", "2020-01-01T10:00:00Z"),
        ("timestamp", "yesterday"),
        ("time", "24:00:00"),
        ("boolean", "maybe"),
    ],
)
def test_malformed_text_fails(spark, type_name, text):
    with pytest.raises(Exception):
        column(spark, type_name, ["" if text is None else text], decimal=True)


@pytest.mark.parametrize(
    "sql, type_name",
    [("date'2020-01-01'", "integer"), ("1.5D", "bigint"), ("1", "date"), ("1.5D", "real"), ("true", "numeric")],
)
def test_type_mismatch_fails_before_running(spark, sql, type_name):
    with pytest.raises(TypeError):
        normalize(spark.sql(f"SELECT {sql} AS c"), {"c": type_name})


def test_zero_values_are_not_null(spark):
    names = ["i4", "i8", "f8", "f4", "s", "b", "d", "ts"]
    types = ["integer", "bigint", "double precision", "real", "text", "boolean", "date", "timestamp"]
    rows = [("0", "0", "0", "0", "", "f", "1970-01-01", "1970-01-01 00:00:00"), (None,) * 8]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    out = normalize(df, list(zip(names, types)))
    assert out.columns == names
    zero, null = encode_temporal(out).collect()
    assert tuple(zero) == (0, 0, 0.0, 0.0, "", False, 0, 0)
    assert tuple(null) == (None,) * 8


def test_repeated_and_odd_names(spark):
    df = spark.createDataFrame([("1", "2", "x", "3", "4")], "a string, b string, c string, d string, e string")
    df = df.toDF("id", "id", "With Space", "a.b", "é`")
    types = [("id", "int4"), ("id", "int8"), ("With Space", "text"), ("a.b", "int4"), ("é`", "numeric")]
    out = normalize(df, types)
    assert out.columns == ["id", "id_1", "With Space", "a.b", "é`"]
    assert tuple(out.first()) == (1, 2, "x", 3, 4.0)
    assert [f.metadata["source_type"] for f in out.schema] == [t for _, t in types]


def test_native_columns_keep_their_values(spark):
    df = spark.sql(
        "SELECT CAST(1 AS SMALLINT) AS i2, array(1, NULL) AS arr, array('a b', 'NULL', 'c') AS txt, "
        "named_struct('k', 1) AS j, timestamp'2020-01-02 03:04:05' AS tz, 'AB  ' AS ch"
    )
    out = normalize(df, {"ch": "character(4)"})
    assert out.schema["i2"].dataType == T.IntegerType()
    row = encode_temporal(out).first()
    assert tuple(row) == (1, "{1,NULL}", '{"a b","NULL",c}', '{"k":1}', 1577934245000000, "AB")


def test_unknown_or_missing_types(spark):
    df = spark.sql("SELECT 1 AS a")
    with pytest.raises(ValueError):
        normalize(df, {"b": "integer"})
    with pytest.raises(ValueError):
        normalize(df, [("a", "integer"), ("b", "integer")])


def test_plan_is_one_projection_without_python(spark, small):
    df = spark.read.parquet(f"{small}/lineitem.parquet")
    out = normalize(df, {"l_extendedprice": "numeric(12,2)"}, decimal=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
