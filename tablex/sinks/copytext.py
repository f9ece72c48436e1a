"""Text dumps of a table, the inverse of `sources.copytext`."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from tablex.functions.declared import source_type
from tablex.functions.names import quoted, unique_columns
from tablex.functions.sourcetext import source_text
from tablex.sinks.files import commit, counted
from tablex.sources.copytext import ESCAPES


def escaped(text: str) -> str:
    text = rf"replace({text}, r'\', r'\\')"
    for letter, char in ESCAPES.items():
        text = rf"replace({text}, chr({ord(char)}), r'\{letter}')"
    return text


def dump_field(field: T.StructField) -> str:
    """Numbers, truth values and moments hold nothing to escape."""
    text = source_text(quoted(field.name), field.dataType)
    plain = isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType, T.TimeType))
    return rf"coalesce({text if plain else escaped(text)}, r'\N')"


def dump_types(df: DataFrame) -> list[tuple[str, str]]:
    """(name, declared type) of every column, as `read_copy` wants them."""
    df = unique_columns(df)
    return [(field.name, source_type(field)) for field in df.schema]


def copy_lines(df: DataFrame) -> DataFrame:
    """One text line per row."""
    fields = [dump_field(field) for field in unique_columns(df).schema]
    return unique_columns(df).selectExpr(f"concat_ws(chr(9), {', '.join(fields)}) AS value")


def write_copy(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write a dump; returns the rows written."""
    lines, rows = counted(copy_lines(df))
    commit(lines.write.format("text").option("lineSep", "\n"), lines, path, mode)
    return rows.get["rows"]
