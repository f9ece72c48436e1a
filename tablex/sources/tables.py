"""Tables and raw SQL as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tablex.functions.names import quoted
from tablex.session import configure, path_exists
from tablex.sinks.versions import MANIFESTS, read_version
from tablex.sources.csvtext import read_csv, whole_files


def scan(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """A table of a catalogue schema, or of a folder that holds `<table>.parquet`."""
    configure(spark)
    if "/" in schema:
        return spark.read.parquet(f"{schema.rstrip('/')}/{table}.parquet")
    return spark.table(f"{quoted(schema)}.{quoted(table)}")


def query(spark: SparkSession, sql: str) -> DataFrame:
    """A SQL text, passed through unchanged."""
    return configure(spark).sql(sql)


def register(spark: SparkSession, folder: str, tables: Iterable[str]) -> None:
    """Make the named tables of a folder visible to SQL texts as temporary views."""
    for table in tables:
        scan(spark, folder, table).createOrReplaceTempView(table)


def read_export(
    spark: SparkSession, path: str, fmt: str = "", multiline: bool = True
) -> DataFrame:
    """Read an export back; one that did not complete is refused.

    A job leaves `_SUCCESS` when it commits, a stream keeps a log of its committed files; of an export in versions
    the newest is read.

    multiline   CSV cells may hold line ends, at the price of one more pass over the lines
    """
    configure(spark)
    if path_exists(spark, f"{path}/{MANIFESTS}"):
        return read_version(spark, path)
    if not any(path_exists(spark, f"{path}/{mark}") for mark in ("_SUCCESS", "_spark_metadata")):
        raise FileNotFoundError(f"{path} is not a completed export")
    if (fmt.lower() or ("csv" if path.lower().endswith(".csv") else "parquet")) == "csv":
        return read_csv(spark, path) if multiline else whole_files(spark, path, multiline=False)
    return spark.read.parquet(path)
