"""Tables of a remote SQL database, read in parallel slices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tablex.functions.declared import declared, with_types
from tablex.functions.names import quoted
from tablex.session import configure

# Kinds whose native transfer is safe; all others travel as text, so that NaN, infinity,
# arrays and intervals do not depend on the driver.
NATIVE_TRANSFER = {"bool", "int32", "int64", "float32", "float64"}


def sql_quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def remote_select(
    schema: str,
    table: str,
    types: Mapping[str, str],
    columns: Sequence[str] = (),
    where: str = "",
    partition_column: str = "",
) -> str:
    """The sub-query the database runs: projection, predicate and text transfer happen there.

    The column that cuts the slices must be native, so it travels once more if it is text.
    """
    items = []
    names = list(columns or types)
    for name in names:
        native = declared(types[name]).kind in NATIVE_TRANSFER
        item = sql_quoted(name)
        items.append(item if native else f"{item}::text AS {item}")
    if partition_column:
        items.append(f"{sql_quoted(partition_column)} AS {sql_quoted(slice_name(names))}")
    source = f"{sql_quoted(schema)}.{sql_quoted(table)}"
    sql = f"SELECT {', '.join(items)} FROM {source}"
    return f"{sql} WHERE {where}" if where else sql


def slice_name(names: Sequence[str]) -> str:
    name = "slice_key"
    while name in names:
        name += "_"
    return name


def jdbc_options(
    url: str,
    sql: str,
    partition_column: str = "",
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": f"({sql}) source_rows", "fetchsize": str(fetch_size)}
    if partition_column:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def scan_jdbc(
    spark: SparkSession,
    url: str,
    schema: str,
    table: str,
    types: Mapping[str, str],
    columns: Sequence[str] = (),
    where: str = "",
    partition_column: str = "",
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A remote table as columns tagged with their declared types, ready for `normalize`.

    partitions=1 uses one connection, for a source that permits one session only. Rows stream
    through a cursor of fetch_size, so a slice never sits in memory whole.
    """
    names = list(columns or types)
    sql = remote_select(schema, table, types, names, where, partition_column)
    slices = sql_quoted(slice_name(names)) if partition_column else ""
    options = jdbc_options(url, sql, slices, lower, upper, partitions, fetch_size)
    reader = configure(spark).read.format("jdbc").options(**options, **(properties or {}))
    return with_types(reader.load().select(*map(quoted, names)), [types[n] for n in names])


def query_jdbc(
    spark: SparkSession,
    url: str,
    sql: str,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A raw SQL text run by the remote database, on one connection."""
    options = jdbc_options(url, sql, fetch_size=fetch_size)
    return configure(spark).read.format("jdbc").options(**options, **(properties or {})).load()
