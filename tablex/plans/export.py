"""The two ways an extract is used: written to files, or tried out first."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tablex.functions.normalize import normalize
from tablex.operators.extract import extract
from tablex.operators.profile import extract_count, sample
from tablex.sinks.files import sink_format, write
from tablex.sources.tables import scan


def export(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    decimal: bool = False,
    fmt: str = "",
    mode: str = "errorifexists",
    **options,
) -> int:
    """Extract, normalise and write in one job; returns the rows written. A CSV gets numerics as plain digits.

    types       declared types of the table's columns, those the extract leaves out included; a name
                that neither the table nor the extract has is an error
    mode        errorifexists, or overwrite: an earlier export stays until the new one is complete
    options     of `extract`: schema, table, columns, predicate, rows, keys, or sql
    """
    rows = extract(spark, **options)
    known = set(rows.columns)
    if not options.get("sql"):
        known |= set(scan(spark, options["schema"], options["table"]).columns)
    if unknown := sorted(set(types or {}) - known):
        raise ValueError(f"types for columns that do not exist: {', '.join(unknown)}")
    kept = {name: kind for name, kind in (types or {}).items() if name in rows.columns}
    plain = sink_format(path, fmt) == "csv"
    return write(normalize(rows, kept, decimal, plain), path, fmt, mode)


def dry_run(spark: SparkSession, **options) -> tuple[DataFrame, DataFrame]:
    """The exact row count of an extract, and its first five rows as text."""
    rows = extract(spark, **options)
    return extract_count(rows), sample(rows)
