"""Text dumps: tab-separated lines with back-slash escapes, and their declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablex.functions.declared import declared, with_types
from tablex.functions.names import quoted, unique_names
from tablex.session import configure

# The single-letter escapes of the dump format.
ESCAPES = {
    "b": "\b",
    "f": "\f",
    "n": "\n",
    "r": "\r",
    "t": "\t",
    "v": "\v",
}


def octal_head(part: str) -> str:
    """A part that starts with one to three octal digits, with that character put in."""
    digits = f"regexp_extract({part}, '^([0-7]{{1,3}})', 1)"
    char = f"decode(unhex(lpad(conv({digits}, 8, 16), 4, '0')), 'UTF-16BE')"
    return f"concat({char}, substr({part}, length({digits}) + 1))"


def unescape_piece(piece: str) -> str:
    """Decode a text in which every back-slash starts an escape other than the doubled one."""
    for letter, char in ESCAPES.items():
        piece = rf"replace({piece}, r'\{letter}', chr({ord(char)}))"
    piece = rf"regexp_replace({piece}, r'\\([^0-7])', '$1')"
    parts = rf"split({piece}, r'\\(?=[0-7])')"
    tail = f"transform(slice({parts}, 2, size({parts})), part -> {octal_head('part')})"
    return (
        f"CASE WHEN size({parts}) = 1 THEN {piece}"
        f" ELSE concat({parts}[0], array_join({tail}, '')) END"
    )


def unescape(field: str) -> str:
    r"""Decode one field; `\N` is NULL.

    Splitting on the doubled back-slash first leaves pieces whose escapes cannot overlap.
    """
    pieces = rf"split({field}, r'\\\\')"
    return (
        rf"CASE WHEN {field} = r'\N' THEN NULL WHEN NOT contains({field}, r'\') THEN {field}"
        rf" ELSE array_join(transform({pieces}, piece -> {unescape_piece('piece')}), r'\') END"
    )


def copy_field(field: str, type_name: str) -> str:
    """Only text can need escapes; in a number or a date they would fail its cast."""
    if declared(type_name).kind in ("text", "char"):
        return unescape(field)
    return rf"nullif({field}, r'\N')"


def copy_columns(lines: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Lines in a `value` column as one text column per declared column."""
    wrong = f"raise_error(concat('want {len(columns)} fields: ', value))"
    checked = f"CASE WHEN size(fields) = {len(columns)} THEN fields ELSE {wrong} END AS fields"
    names = unique_names([name for name, _ in columns])
    type_names = [type_name for _, type_name in columns]
    split = lines.selectExpr("value", "split(value, chr(9), -1) AS fields").selectExpr(checked)
    fields = [
        f"{copy_field(f'fields[{i}]', type_name)} AS {quoted(name)}"
        for i, (name, type_name) in enumerate(zip(names, type_names))
    ]
    return with_types(split.selectExpr(*fields), type_names)


def read_copy(spark: SparkSession, path: str, columns: list[tuple[str, str]]) -> DataFrame:
    """A dump as text columns carrying their declared types, ready for `normalize`."""
    return copy_columns(configure(spark).read.text(path, lineSep="\n"), columns)


def read_copy_stream(
    spark: SparkSession, folder: str, columns: list[tuple[str, str]], files_per_batch: int = 1000
) -> DataFrame:
    """The same dump as a stream of its files, so that memory and progress go by batch."""
    lines = configure(spark).readStream.option("maxFilesPerTrigger", files_per_batch)
    return copy_columns(lines.text(folder, lineSep="\n"), columns)


def read_types(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, declared type) pairs of a `name<TAB>type` file: as many as a table has columns."""
    lines = configure(spark).read.text(path, lineSep="\n", wholetext=False)
    pairs = lines.where(F.col("value") != "").select(F.split("value", "\t", 2).alias("pair"))
    return [(row.pair[0], row.pair[1]) for row in pairs.collect()]
