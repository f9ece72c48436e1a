"""Queries that write an export and read it back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import count

from tablex.functions.celltext import csv_text
from tablex.functions.normalize import normalize
from tablex.operators.extract import extract
from tablex.plans.export import export
from tablex.session import stored, work_folder
from tablex.sinks.copytext import dump_types, write_copy
from tablex.sinks.files import write, write_parquet
from tablex.sinks.layout import clustered
from tablex.sinks.versions import read_version, write_version
from tablex.sources.copytext import read_copy_stream
from tablex.sources.tables import query, read_export, register, scan
from tablex.streaming.export import export_stream


def csv_cells(spark: SparkSession, sf: str) -> DataFrame:
    return csv_text(scan(spark, sf, "orders"))


def csv_moments(spark: SparkSession, sf: str) -> DataFrame:
    return csv_text(scan(spark, sf, "events"))


SMALL_AND_LARGE = """
SELECT l_orderkey, l_linenumber,
       (l_extendedprice::decimal(12,2) * 0.000001)::{text} AS small,
       (l_extendedprice::decimal(12,2) * 1000000000000)::{text} AS large
FROM lineitem
"""


def csv_numerics(spark: SparkSession, sf: str) -> DataFrame:
    """Numerics of eight decimals and of eighteen digits keep every digit in a CSV."""
    register(spark, sf, ["lineitem"])
    path = f"{work_folder(spark, 'numerics')}/numerics.csv"
    types = {"small": "numeric(20,8)", "large": "numeric"}
    export(spark, path, types, sql=SMALL_AND_LARGE.format(text="string"))
    return read_export(spark, path)


def write_read_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{work_folder(spark, 'lineitem')}/lineitem.parquet"
    export(
        spark,
        path,
        types={"l_extendedprice": "numeric(12,2)", "l_tax": "numeric(12,2)"},
        decimal=True,
        schema=sf,
        table="lineitem",
        columns="l_orderkey, l_partkey, l_extendedprice, l_shipdate",
        predicate="l_shipdate >= '1996-01-01' AND l_shipdate < '1997-01-01'",
    )
    return read_export(spark, path)


def write_read_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{work_folder(spark, 'documents')}/documents.csv"
    write(scan(spark, sf, "documents"), path)
    return read_export(spark, path)


def empty_result(spark: SparkSession, sf: str) -> DataFrame:
    """No line item has a negative quantity: the export holds the schema alone."""
    path = f"{work_folder(spark, 'empty')}/empty.parquet"
    write(extract(spark, sf, "lineitem", predicate="l_quantity < 0"), path)
    return read_export(spark, path)


def where_false(spark: SparkSession, sf: str) -> DataFrame:
    """A literal WHERE false: the export has every column and no row."""
    register(spark, sf, ["orders"])
    path = f"{work_folder(spark, 'none')}/none.parquet"
    write(query(spark, "SELECT * FROM orders WHERE false"), path)
    return read_export(spark, path)


LONG_CELLS = """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_partkey % 1000 = 0 THEN repeat(l_returnflag || l_orderkey || '-é', {times}) ELSE l_linestatus END AS label
FROM lineitem
"""
#: Repetitions that make a cell of more than 100 KB, and the rows of a row group.
REPEATED, GROUP_ROWS = 25_000, 10_000


def long_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of 100 KB on every thousandth part, over many row groups; read back, each tells its length and digest."""
    register(spark, sf, ["lineitem"])
    path = f"{work_folder(spark, 'long')}/long.parquet"
    write_parquet(query(spark, LONG_CELLS.format(times=REPEATED)), path, row_group_rows=GROUP_ROWS)
    return read_export(spark, path).selectExpr("l_orderkey", "l_linenumber", "l_partkey", "length(label) AS letters", "md5(label) AS digest")


def row_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Row groups of an export: read in splits smaller than any, a split with rows is a row group."""
    path = f"{work_folder(spark, 'groups')}/lineitem.parquet"
    write_parquet(extract(spark, sf, "lineitem"), path, row_group_rows=GROUP_ROWS)
    old = {key: spark.conf.get(key, None) for key in SMALL_SPLITS}
    for key, value in SMALL_SPLITS.items():
        spark.conf.set(key, value)
    try:
        split = ["_metadata.file_path", "_metadata.file_block_start"]
        groups = stored(read_export(spark, path).groupBy(*split).agg(count("*").alias("rows")), "groups")
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return groups.selectExpr("sum(rows) AS rows", "max(rows) AS largest", f"count(*) >= ceil(sum(rows) / {GROUP_ROWS}) AS enough")


SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": "32768", "spark.sql.files.openCostInBytes": "32768"}


def clustered_export(spark: SparkSession, sf: str) -> DataFrame:
    """Line items laid out by part, supplier and price; what predicates on each of them find is the same."""
    path = f"{work_folder(spark, 'clustered')}/lineitem.parquet"
    write_parquet(clustered(extract(spark, sf, "lineitem"), ["l_partkey", "l_suppkey", "l_extendedprice"]), path)
    back = read_export(spark, path)
    predicates = ["l_partkey BETWEEN 90 AND 99", "l_suppkey IN (3, 7)", "l_extendedprice < 1500"]
    parts = [back.where(p).selectExpr(f"{k} AS predicate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice") for k, p in enumerate(predicates)]
    return reduce(DataFrame.unionAll, parts)


def versioned_export(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of an export of orders: written, replaced, added to; all are read back, the newest twice."""
    path = f"{work_folder(spark, 'versions')}/orders"
    for mode, year in (("errorifexists", 1995), ("overwrite", 1996), ("append", 1997)):
        write_version(extract(spark, sf, "orders", predicate=f"year(o_orderdate) = {year}"), path, mode)
    parts = [(number, read_version(spark, path, number)) for number in (1, 2, 3, None)]
    every = [df.selectExpr(f"{number or 0} AS version", "o_orderkey", "o_orderdate", "o_totalprice") for number, df in parts]
    return reduce(DataFrame.unionAll, every)


def stream_export(spark: SparkSession, sf: str) -> DataFrame:
    """A dump normalised and exported as a stream of its files."""
    source = scan(spark, sf, "lineitem")
    folder = work_folder(spark, "stream")
    write_copy(source, f"{folder}/dump")
    types = dump_types(source)
    stream = normalize(read_copy_stream(spark, f"{folder}/dump", types), types)
    export_stream(stream, f"{folder}/export", f"{folder}/checkpoint")
    return read_export(spark, f"{folder}/export")


QUERIES = {
    "csv_cells": csv_cells,
    "csv_moments": csv_moments,
    "csv_numerics": csv_numerics,
    "write_read_parquet": write_read_parquet,
    "write_read_csv": write_read_csv,
    "empty_result": empty_result,
    "where_false": where_false,
    "long_cells": long_cells,
    "row_groups": row_groups,
    "clustered_export": clustered_export,
    "versioned_export": versioned_export,
    "stream_export": stream_export,
}

PLAIN = "regexp_replace(CAST({0} AS VARCHAR), '\\.0$', '')"

ORACLES = {
    "csv_cells": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, {PLAIN.format("o_totalprice")} AS o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
        FROM orders
    """,
    "csv_moments": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               CASE WHEN CAST(ts AS DATE) = ts THEN strftime(ts, '%Y-%m-%d')
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS ts,
               CAST(user_id AS VARCHAR) AS user_id, event_type, {PLAIN.format("value")} AS "value", props
        FROM events
    """,
    "csv_numerics": """
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
               rtrim(rtrim(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.000001 AS VARCHAR), '0'), '.') AS small,
               CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS HUGEINT) * 10000000000 AS VARCHAR) AS large
        FROM lineitem
    """,
    "write_read_parquet": """
        SELECT l_orderkey, l_partkey, CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
               l_shipdate
        FROM lineitem WHERE l_shipdate >= '1996-01-01' AND l_shipdate < '1997-01-01'
    """,
    "write_read_csv": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang, source,
               CAST(n_chars AS VARCHAR) AS n_chars
        FROM documents
    """,
    "empty_result": "SELECT * FROM lineitem WHERE l_quantity < 0",
    "where_false": "SELECT * FROM orders WHERE false",
    "long_cells": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(length(label) AS INTEGER) AS letters, md5(label) AS digest
        FROM ({LONG_CELLS.format(times=REPEATED)})
    """,
    "row_groups": f"""
        SELECT count(*) AS "rows", least(count(*), {GROUP_ROWS}) AS largest, TRUE AS enough FROM lineitem
    """,
    "clustered_export": """
        SELECT 0 AS predicate, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_partkey BETWEEN 90 AND 99
        UNION ALL SELECT 1, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_suppkey IN (3, 7)
        UNION ALL SELECT 2, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_extendedprice < 1500
    """,
    "versioned_export": """
        SELECT CAST(version AS INTEGER) AS version, o_orderkey, o_orderdate, o_totalprice
        FROM orders JOIN (VALUES (1, 1995), (2, 1996), (3, 1996), (3, 1997), (0, 1996), (0, 1997)) v(version, y)
          ON year(o_orderdate) = y
    """,
    "stream_export": "SELECT * FROM lineitem",
}
