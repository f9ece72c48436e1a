"""A native Spark column as the text the source database would print for it."""

from __future__ import annotations

from pyspark.sql import types as T

from tablex.functions.declared import is_text
from tablex.functions.temporal import INFINITE_DAYS, INFINITE_MICROS, as_integer, finite_or_word

# Fixed value: array items made of these characters only need no quotes.
BARE_ITEM = r"""r'^[^\s{}",\\]+$'"""


def without_trailing_zeros(text: str) -> str:
    """`12.50` as `12.5`, `12.00` as `12`; a text without a point is left alone."""
    return f"CASE WHEN contains({text}, '.') THEN rtrim('.', rtrim('0', {text})) ELSE {text} END"


def scientific(text: str) -> str:
    """The JVM's `1.5E-7` as `1.5e-07`."""
    mantissa = without_trailing_zeros(f"substring_index({text}, 'E', 1)")
    power = f"CAST(substring_index({text}, 'E', -1) AS INT)"
    sign = f"CASE WHEN {power} < 0 THEN 'e-' ELSE 'e+' END"
    digits = f"CAST(abs({power}) AS STRING)"
    return f"concat({mantissa}, {sign}, lpad({digits}, greatest(2, length({digits})), '0'))"


def float_source(c: str) -> str:
    """A float with plain digits from 1e-4 up to 1e15, an exponent beyond."""
    text = f"CAST({c} AS STRING)"
    large = without_trailing_zeros(f"CAST(CAST({text} AS DECIMAL(38,16)) AS STRING)")
    small = without_trailing_zeros(f"CAST(CAST({text} AS DECIMAL(38,30)) AS STRING)")
    return (
        f"CASE WHEN {c} = 0 OR abs({c}) >= 1e-3D AND abs({c}) < 1e7D THEN {without_trailing_zeros(text)}"
        f" WHEN isnan({c}) OR abs({c}) = double('Infinity') THEN {text}"
        f" WHEN abs({c}) >= 1e7D AND abs({c}) < 1e15D THEN {large}"
        f" WHEN abs({c}) >= 1e-4D AND abs({c}) < 1e-3D THEN {small}"
        f" ELSE {scientific(text)} END"
    )


def array_item(c: str, dtype: T.DataType, depth: int) -> str:
    text = source_text(c, dtype, depth)
    if is_text(dtype):
        escaped = rf"""replace(replace({c}, r'\', r'\\'), '"', r'\"')"""
        bare = f"{c} RLIKE {BARE_ITEM} AND upper({c}) <> 'NULL'"
        text = f"""CASE WHEN {bare} THEN {c} ELSE concat('"', {escaped}, '"') END"""
    return f"coalesce({text}, 'NULL')"


def source_text(c: str, dtype: T.DataType, depth: int = 0) -> str:
    """Text form of a column; NULL stays NULL."""
    if is_text(dtype):
        return c
    if isinstance(dtype, T.BooleanType):
        return f"CASE WHEN {c} THEN 't' WHEN NOT {c} THEN 'f' END"
    if isinstance(dtype, T.DateType):
        return finite_or_word(as_integer(c, dtype), INFINITE_DAYS, f"CAST({c} AS STRING)")
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        text = f"CAST({c} AS STRING)"
        if isinstance(dtype, T.TimestampType):
            text = f"concat({text}, '+00')"
        return finite_or_word(as_integer(c, dtype), INFINITE_MICROS, text)
    if isinstance(dtype, T.ArrayType):
        item = array_item(f"item{depth}", dtype.elementType, depth + 1)
        joined = f"array_join(transform({c}, item{depth} -> {item}), ',')"
        return f"concat('{{', {joined}, '}}')"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float_source(c)
    if isinstance(dtype, T.BinaryType):
        return rf"concat(r'\x', lower(hex({c})))"
    if isinstance(dtype, (T.MapType, T.StructType)):
        return f"to_json({c})"
    return f"CAST({c} AS STRING)"
