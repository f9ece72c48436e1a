"""Cell text of the CSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from tablex.functions.declared import declared, is_text, source_type
from tablex.functions.names import quoted, unique_columns
from tablex.functions.sourcetext import scientific, source_text, without_trailing_zeros
from tablex.functions.temporal import INFINITE_MICROS, as_integer, finite_or_word

MICROS_OF_DAY = 86_400_000_000


def float_text(c: str, numeric: bool) -> str:
    """Plain digits from 1e-4 up to 1e21, an exponent beyond; for a numeric as far as 38 digits reach.

    The JVM switches to an exponent at 1e-3 and 1e7 already; the bands around go through a
    decimal of the same digits.
    """
    text = f"CAST({c} AS STRING)"
    plus, minus = ("Infinity", "-Infinity") if numeric else ("+Inf", "-Inf")
    large = without_trailing_zeros(f"CAST(CAST({text} AS DECIMAL(38,16)) AS STRING)")
    small = without_trailing_zeros(f"CAST(CAST({text} AS DECIMAL(38,30)) AS STRING)")
    beyond = ""
    if numeric:
        tiny = without_trailing_zeros(f"CAST(CAST({text} AS DECIMAL(38,37)) AS STRING)")
        huge = f"CAST(CAST({text} AS DECIMAL(38,0)) AS STRING)"
        beyond = (
            f" WHEN abs({c}) < 1e-4D AND abs({c}) > 1e-20D THEN {tiny}"
            f" WHEN abs({c}) >= 1e21D AND abs({c}) < 1e37D THEN {huge}"
        )
    return (
        f"CASE WHEN {c} = 0 OR abs({c}) >= 1e-3D AND abs({c}) < 1e7D"
        f" THEN {without_trailing_zeros(text)}"
        f" WHEN isnan({c}) THEN 'NaN'"
        f" WHEN {c} = double('Infinity') THEN '{plus}'"
        f" WHEN {c} = double('-Infinity') THEN '{minus}'"
        f" WHEN abs({c}) >= 1e7D AND abs({c}) < 1e21D THEN {large}"
        f" WHEN abs({c}) >= 1e-4D AND abs({c}) < 1e-3D THEN {small}"
        f"{beyond} ELSE {scientific(text)} END"
    )


def moment_text(c: str, dtype: T.DataType, fraction: bool) -> str:
    """ISO text in UTC; midnight prints as the date alone."""
    micros = as_integer(c, dtype)
    clock = "HH:mm:ss.SSSSSS" if fraction else "HH:mm:ss"
    seconds = f"concat(date_format({c}, 'yyyy-MM-dd'), 'T', date_format({c}, '{clock}'))"
    if fraction:
        seconds = without_trailing_zeros(seconds)
    text = (
        f"CASE WHEN pmod({micros}, {MICROS_OF_DAY}L) = 0 THEN date_format({c}, 'yyyy-MM-dd')"
        f" ELSE concat({seconds}, 'Z') END"
    )
    return finite_or_word(micros, INFINITE_MICROS, text)


def cell(c: str, field: T.StructField, fraction: bool) -> str:
    dtype = field.dataType
    if isinstance(dtype, T.BooleanType):
        text = f"CAST({c} AS STRING)"
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = float_text(c, declared(source_type(field)).kind == "numeric")
    elif isinstance(dtype, T.DecimalType):
        text = without_trailing_zeros(f"CAST({c} AS STRING)")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = moment_text(c, dtype, fraction)
    else:
        text = c if is_text(dtype) else source_text(c, dtype)
    return f"coalesce({text}, '')"


def csv_text(df: DataFrame, fraction: bool = False) -> DataFrame:
    """Every column as the text a CSV cell holds; NULL and '' both become ''.

    fraction    keep microseconds, which the default format drops
    """
    df = unique_columns(df)
    cells = []
    for field in df.schema:
        name = quoted(field.name)
        cells.append(f"{cell(name, field, fraction)} AS {name}")
    return df.selectExpr(*cells)
