"""Infinite dates and timestamps, and temporal values as integers.

Here and in the modules beside this one an expression is SQL text: a relation of a thousand
columns is then one `selectExpr`, not ten thousand calls into the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from tablex.functions.names import quoted

# The extremes that stand for +/- infinity, in days and in microseconds.
INFINITE_DAYS = 2**31 - 1
INFINITE_MICROS = 2**63 - 1


def infinite_date(sign: int) -> str:
    return f"date_from_unix_date({sign * INFINITE_DAYS})"


def infinite_timestamp(sign: int, to: str) -> str:
    return f"CAST(timestamp_micros({sign * INFINITE_MICROS}L) AS {to})"


def finite_or_word(number: str, extreme: int, text: str) -> str:
    """`text`, unless the number behind it is one of the extremes."""
    return (
        f"CASE {number} WHEN {extreme}L THEN 'infinity' WHEN {-extreme}L THEN '-infinity'"
        f" ELSE {text} END"
    )


def as_integer(c: str, dtype: T.DataType) -> str:
    """Days for dates, microseconds for timestamps and times; other types unchanged."""
    if isinstance(dtype, T.DateType):
        return f"unix_date({c})"
    if isinstance(dtype, T.TimestampType):
        return f"unix_micros({c})"
    if isinstance(dtype, T.TimestampNTZType):
        return f"unix_micros(CAST({c} AS TIMESTAMP))"
    if isinstance(dtype, T.TimeType):
        return f"time_diff('MICROSECOND', CAST('00:00:00' AS TIME(6)), {c})"
    return c


def encode_temporal(df: DataFrame) -> DataFrame:
    """Temporal columns as integers, so that every value survives any client."""
    names = [quoted(field.name) for field in df.schema]
    columns = [as_integer(name, field.dataType) for name, field in zip(names, df.schema)]
    return df.selectExpr(*[f"{column} AS {name}" for column, name in zip(columns, names)])
