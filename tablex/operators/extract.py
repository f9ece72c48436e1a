"""Extracts: columns, predicate, order and limit of a table, or a raw SQL text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablex.functions.equality import row_hash
from tablex.functions.names import quoted
from tablex.operators.cut import FEW, ORDERED, first_rows, top_rows
from tablex.sources.tables import query, scan

#: Cells that one task computes where rows are spread.
CELLS = 2_500_000


def project(df: DataFrame, columns: str = "*") -> DataFrame:
    """The columns of a comma-separated list of names; '' or '*' is all of them."""
    if columns in ("", "*"):
        return df
    return df.select(*[quoted(name.strip()) for name in columns.split(",")])


def where(df: DataFrame, predicate: str = "") -> DataFrame:
    """Rows for which a SQL predicate, written without the keyword, holds."""
    return df.where(predicate) if predicate else df


def named_keys(keys: Iterable[str | tuple[str, str]]) -> list[tuple[str, bool]]:
    """(name, descending) of each key."""
    pairs = [(key, "asc") if isinstance(key, str) else key for key in keys]
    return [(name, direction.lower() == "desc") for name, direction in pairs]


def sort_keys(keys: Iterable[str | tuple[str, str]]) -> list[Column]:
    columns = [(F.col(quoted(name)), descending) for name, descending in named_keys(keys)]
    return [c.desc_nulls_first() if descending else c.asc_nulls_last() for c, descending in columns]


def ordered(
    df: DataFrame, keys: Iterable[str | tuple[str, str]], steady_scan: bool = False
) -> DataFrame:
    """Rows by the keys, names or (name, 'desc'); NULL sorts above every value.

    Spark sorts by ranges of the keys, and all rows of one key fall into one range. A last key
    that tells such rows apart lets a frequent key spread over many ranges: a hash of the row,
    or, where partitions hold the same rows each time they are read, the row's place in the scan.
    """
    columns = sort_keys(keys)
    if not columns:
        return df
    place = F.monotonically_increasing_id()
    return df.orderBy(*columns, place if steady_scan else F.expr(row_hash(df.schema, 1)))


def spread(df: DataFrame, width: int) -> DataFrame:
    """The rows dealt over so many tasks that none makes more than about 2,500,000 cells of `width` columns.

    A scan has tasks by bytes: a small file, or a single row group, is one task, whatever is computed from a row. For few and
    narrow rows that become wide ones; they are counted and shuffled once, before they are widened.
    """
    tasks = -(-df.count() * width // CELLS)
    return df.repartition(tasks) if tasks > 1 else df


def limit(df: DataFrame, n: int = 0, scanned: bool = False) -> DataFrame:
    """Any n rows, or all of them for n <= 0.

    Up to 10,000 rows pass through one task, and no job runs until they are used. More are cut by counts: the
    result is a filter over the files, read by as many tasks as they fill.

    scanned     the rows come from Parquet files through filters and projections alone, the same
                each time; those of any other relation are stored first
    """
    return first_rows(df, n, scanned) if n > 0 else df


def extract(
    spark: SparkSession,
    schema: str = "",
    table: str = "",
    columns: str = "*",
    predicate: str = "",
    rows: int = 0,
    keys: Iterable[str | tuple[str, str]] = (),
    sql: str = "",
) -> DataFrame:
    """One extract. A raw SQL text overrides every other option.

    The predicate and the keys may use columns the extract does not keep. An order with a limit is a
    top-n. Up to 10,000 rows are one lazy plan: Spark keeps n rows per partition and merges them. A
    larger limit is cut by counts when the extract is built (see `cut`), so that neither the rows kept
    nor their order need one task.
    """
    if sql:
        return query(spark, sql)
    if not schema or not table:
        raise ValueError("an extract needs a SQL text, or both a schema and a table")
    keys = list(keys)
    source = where(scan(spark, schema, table), predicate)
    files = "/" in schema  # a table of the catalogue may be a view
    if not keys:
        return project(limit(source, rows, scanned=files), columns)
    if rows <= 0:
        return project(ordered(source, keys, steady_scan=True), columns)
    if rows > FEW and all(isinstance(source.schema[k].dataType, ORDERED) for k, _ in named_keys(keys)):
        return project(ordered(top_rows(source, named_keys(keys), rows, scanned=files), keys, steady_scan=True), columns)
    return project(source.orderBy(*sort_keys(keys)).limit(rows), columns)
