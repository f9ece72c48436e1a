"""When two cells are the same, and row digests that respect it.

NULL equals NULL only; floats are compared bit by bit, except that every NaN is the same and
-0.0 differs from 0.0; decimals by value, whatever their scale; everything else by value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from tablex.functions.names import quoted
from tablex.functions.sourcetext import without_trailing_zeros
from tablex.functions.temporal import as_integer

MOMENT = (T.TimestampType, T.TimestampNTZType)

# Fixed value: instants, in microseconds, at least this far from the epoch stand for infinity.
EXTREME = 2**62 - 1

# Types whose text never holds a separator.
PLAIN = (T.NumericType, T.BooleanType, T.DatetimeType, T.TimeType)


def comparable(c: str, dtype: T.DataType) -> str:
    """A value that equals another exactly when the two cells are the same."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"CAST({c} AS STRING)"
    if isinstance(dtype, T.DecimalType):
        return without_trailing_zeros(f"CAST({c} AS STRING)")
    if isinstance(dtype, T.IntegralType):
        return f"CAST({c} AS BIGINT)"
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return f"to_json({in_key_order(c, dtype)})"
    return as_integer(c, dtype)


def holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return holds_map(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(holds_map(f.dataType) for f in dtype)


def in_key_order(c: str, dtype: T.DataType, depth: int = 0) -> str:
    """A nested value with every map in it, at any depth, as its entries in order of their keys: maps have no order."""
    if not holds_map(dtype):
        return c
    x = f"x{depth}"
    if isinstance(dtype, T.ArrayType):
        return f"transform({c}, {x} -> {in_key_order(x, dtype.elementType, depth + 1)})"
    if isinstance(dtype, T.StructType):
        fields = [f"'{f.name.replace(chr(39), chr(92) + chr(39))}', {in_key_order(f'{c}.{quoted(f.name)}', f.dataType, depth)}" for f in dtype]
        return f"CASE WHEN {c} IS NOT NULL THEN named_struct({', '.join(fields)}) END"
    key, value = in_key_order(f"{x}.key", dtype.keyType, depth + 1), in_key_order(f"{x}.value", dtype.valueType, depth + 1)
    return f"array_sort(transform(map_entries({c}), {x} -> struct({key} AS key, {value} AS value)))"


def comparable_text(c: str, dtype: T.DataType) -> str:
    return f"CAST({comparable(c, dtype)} AS STRING)"


def near(want: str, got: str, tolerance_us: int) -> str:
    """Whether two instants, in microseconds, are close; an extreme stays an extreme of the same sign.

    A reader that keeps instants as doubles can't give an extreme back to the microsecond, so all beyond
    2^62 count as one. The extremes are ruled out first; the difference of the rest fits a bigint.
    """
    inner = " AND ".join(f"{x} > -{EXTREME}L AND {x} < {EXTREME}L" for x in (want, got))
    return (
        f"CASE WHEN {inner} THEN abs({want} - {got}) <= {tolerance_us}"
        f" ELSE {want} >= {EXTREME}L AND {got} >= {EXTREME}L OR {want} <= -{EXTREME}L AND {got} <= -{EXTREME}L END"
    )


def same(want: str, got: str, dtype: T.DataType, tolerance_us: int = 0) -> str:
    """SQL condition, never NULL: are these two cells, both of `dtype`, the same?"""
    a, b = comparable(want, dtype), comparable(got, dtype)
    if tolerance_us and isinstance(dtype, MOMENT):
        return f"coalesce({near(a, b, tolerance_us)}, {want} IS NULL AND {got} IS NULL)"
    return f"({a} <=> {b})"


def row_hash(fields: Iterable[T.StructField], seed: int) -> str:
    """64 bits of a row. A NULL flag per cell keeps NULL and '' apart."""
    cells = []
    for field in fields:
        name = quoted(field.name)
        cells.append(f"{comparable(name, field.dataType)}, {name} IS NULL")
    return f"xxhash64({seed}, {', '.join(cells)})"


def row_text(fields: Iterable[T.StructField]) -> str:
    """The row as one text, columns by name, so that rows that differ never print alike.

    A free text carries its length; numbers and moments cannot hold the separator. NULL prints
    as nothing, which no value does.
    """
    parts = []
    for field in sorted(fields, key=lambda f: f.name):
        text = comparable_text(quoted(field.name), field.dataType)
        if not isinstance(field.dataType, PLAIN):
            text = f"concat(length({text}), ':', {text})"
        parts.append(f"coalesce({text}, '')")
    return f"concat_ws('|', {', '.join(parts)})"
