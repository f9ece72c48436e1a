"""Queries that count, sample and describe tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablex.operators.estimate import estimated_rows
from tablex.operators.extract import extract
from tablex.operators.profile import (
    catalog_dictionary,
    dictionary,
    extract_count,
    info_json,
    preview,
    profile,
    sample,
    search_columns,
)
from tablex.operators.search import search_index, write_search_index
from tablex.session import work_folder
from tablex.sources.tables import query, register, scan

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def every_table(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: scan(spark, sf, name) for name in TABLES}


def count_extract(spark: SparkSession, sf: str) -> DataFrame:
    return extract_count(extract(spark, sf, "lineitem", predicate="l_returnflag = 'R'"))


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    first = extract(
        spark,
        sf,
        "orders",
        columns="o_orderkey, o_orderstatus, o_orderpriority",
        keys=[("o_orderkey", "desc")],
    )
    return sample(first.withColumn("note", F.lit(None).cast("string")))


def preview_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A preview without a number shows fifty rows: all nations."""
    return preview(scan(spark, sf, "nation"), 0)[0]


def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of all tables; the size in bytes is left to the check that it is positive."""
    sizes = profile(every_table(spark, sf), "shop")
    return sizes.withColumn("has_bytes", F.col("bytes") > 0).drop("bytes", "comment")


# A catalogue snapshot as large as the tables it is made of: an order is a table, its line
# items are the columns, its customer the schema.
ATTRIBUTES = """
SELECT l_orderkey AS attrelid,
       l_linenumber AS attnum,
       'col_' || l_linenumber AS attname,
       CASE min(l_returnflag) WHEN 'R' THEN 'integer' WHEN 'A' THEN 'text' ELSE 'date' END
           AS atttype,
       max(l_linestatus) = 'O' AS attnotnull,
       min(l_quantity) < 3 AS attisdropped
FROM lineitem
GROUP BY l_orderkey, l_linenumber
"""
CLASSES = """
SELECT o_orderkey AS oid, 'orders_' || o_orderkey AS relname, o_custkey AS relnamespace
FROM orders
"""
NAMESPACES = "SELECT c_custkey AS oid, c_name AS nspname FROM customer"
DESCRIPTIONS = """
SELECT l_orderkey AS objoid, l_linenumber AS objsubid,
       'Ships ' || min(l_returnflag) || ' to Line ' || l_linenumber AS description
FROM lineitem
WHERE l_discount > 0.04
GROUP BY l_orderkey, l_linenumber
"""


def described_catalog(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, ["lineitem", "orders", "customer"])
    parts = [query(spark, sql) for sql in (ATTRIBUTES, CLASSES, NAMESPACES, DESCRIPTIONS)]
    return catalog_dictionary(*parts)


def column_search(spark: SparkSession, sf: str) -> DataFrame:
    return search_columns(described_catalog(spark, sf), "R to LINE")


def indexed_search(spark: SparkSession, sf: str) -> DataFrame:
    """The same search by an index of trigrams over the whole catalogue."""
    path = work_folder(spark, "search")
    write_search_index(described_catalog(spark, sf), f"{path}/index")
    return search_index(spark, f"{path}/index", "R to LINE")


def row_estimates(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every table from its files' footers: exact for tables of few files."""
    parts = [estimated_rows(df).select(F.lit(name).alias("table"), "rows") for name, df in every_table(spark, sf).items()]
    return reduce(DataFrame.unionAll, parts)


def table_info(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON report of every table, without the size in bytes."""
    tables = every_table(spark, sf)
    notes = [("orders", "o_totalprice", "Price of the whole order"), ("labels", "toxic", "0 or 1")]
    descriptions = spark.createDataFrame(notes, "table string, name string, description string")
    profiles = profile(tables, "shop", {"events": "Stream of events"})
    return info_json(
        profiles.withColumn("bytes", F.lit(None).cast("bigint")),
        dictionary(spark, tables, descriptions),
    )


QUERIES = {
    "extract_count": count_extract,
    "sample_rows": sample_rows,
    "preview_rows": preview_rows,
    "table_profile": table_profile,
    "catalog_dictionary": described_catalog,
    "column_search": column_search,
    "column_search_indexed": indexed_search,
    "row_estimates": row_estimates,
    "info_json": table_info,
}

DUCK_CATALOG = f"""
SELECT n.nspname AS "schema", c.relname AS "table", a.attnum AS ordinal, a.attname AS name,
       a.atttype AS type, NOT a.attnotnull AS nullable,
       coalesce(d.description, '') AS description
FROM ({ATTRIBUTES}) a
JOIN ({CLASSES}) c ON a.attrelid = c.oid
JOIN ({NAMESPACES}) n ON c.relnamespace = n.oid
LEFT JOIN ({DESCRIPTIONS}) d ON d.objoid = c.oid AND d.objsubid = a.attnum
WHERE a.attnum > 0 AND NOT a.attisdropped
"""

DUCK_TYPE = """
CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'integer'
               WHEN 'DOUBLE' THEN 'double precision' WHEN 'FLOAT[]' THEN 'real[]'
               WHEN 'TIMESTAMP' THEN 'timestamp without time zone' ELSE 'text' END
"""

COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS n FROM {t}" for t in TABLES)

ORACLES = {
    "preview_rows": """
        SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
        FROM nation
    """,
    "extract_count": "SELECT count(*) AS \"rows\" FROM lineitem WHERE l_returnflag = 'R'",
    "sample_rows": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority,
               'NULL' AS note
        FROM orders ORDER BY orders.o_orderkey DESC LIMIT 5
    """,
    "table_profile": f"""
        SELECT 'shop' AS "schema", tbl AS "table", n AS row_count, true AS has_bytes
        FROM ({COUNTS})
    """,
    "catalog_dictionary": DUCK_CATALOG,
    **dict.fromkeys(("column_search", "column_search_indexed"), f"""
        SELECT * FROM ({DUCK_CATALOG})
        WHERE contains(lower(name), 'r to line') OR contains(lower(description), 'r to line')
    """),
    "row_estimates": f"""SELECT tbl AS "table", n AS "rows" FROM ({COUNTS})""",
    "info_json": f"""
        WITH entries AS (
            SELECT table_name AS tbl,
                   string_agg('{{"name":"' || column_name || '","type":"' || {DUCK_TYPE}
                              || '","nullable":true'
                              || CASE WHEN table_name = 'orders' AND column_name = 'o_totalprice'
                                      THEN ',"description":"Price of the whole order"'
                                      WHEN table_name = 'labels' AND column_name = 'toxic'
                                      THEN ',"description":"0 or 1"' ELSE '' END || '}}',
                              ',' ORDER BY ordinal_position) AS list
            FROM information_schema.columns GROUP BY table_name
        )
        SELECT tbl AS "table",
               '{{"schema":"shop","table":"' || tbl || '",'
               || CASE tbl WHEN 'events' THEN '"comment":"Stream of events",' ELSE '' END
               || '"row_count":' || n || ',"columns":[' || list || ']}}' AS info
        FROM ({COUNTS}) JOIN entries USING (tbl)
    """,
}
