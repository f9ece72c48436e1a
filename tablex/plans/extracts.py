"""Queries over extracts: projection, predicate, order, limit, raw SQL, repeated names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablex.functions.names import unique_columns
from tablex.operators.extract import extract, limit
from tablex.sources.tables import query, register


def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return extract(spark, sf, "lineitem", columns="l_orderkey, l_partkey , l_extendedprice")


def filter_date_range(spark: SparkSession, sf: str) -> DataFrame:
    return extract(
        spark,
        sf,
        "lineitem",
        columns="l_orderkey, l_partkey, l_extendedprice",
        predicate="l_shipdate >= '1996-01-01' AND l_shipdate < '1997-01-01'",
    )


def filter_in_ints(spark: SparkSession, sf: str) -> DataFrame:
    return extract(
        spark, sf, "part", columns="p_partkey,p_size", predicate="p_size IN (1, 7, 15, 28, 49)"
    )


def filter_in_strings(spark: SparkSession, sf: str) -> DataFrame:
    return extract(spark, sf, "orders", predicate="o_orderpriority IN ('1-URGENT', '2-HIGH')")


def filter_between(spark: SparkSession, sf: str) -> DataFrame:
    return extract(
        spark,
        sf,
        "customer",
        columns="c_custkey, c_acctbal",
        predicate="c_acctbal BETWEEN -100 AND 2500.5",
    )


def extract_top(spark: SparkSession, sf: str) -> DataFrame:
    return extract(
        spark,
        sf,
        "lineitem",
        columns="l_orderkey, l_linenumber, l_extendedprice",
        predicate="l_returnflag <> 'A'",
        rows=1000,
        keys=["l_orderkey", ("l_extendedprice", "desc"), "l_linenumber"],
    )


def extract_top_large(spark: SparkSession, sf: str) -> DataFrame:
    """A top-n too large for one task."""
    return extract(
        spark,
        sf,
        "lineitem",
        columns="l_orderkey, l_extendedprice",
        rows=25_000,
        keys=[("l_shipdate", "desc"), "l_orderkey", "l_extendedprice"],
    )


def limit_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Which rows an unordered limit of a join keeps is open; how many is not, nor that each is a joined row."""
    register(spark, sf, ["lineitem", "orders"])
    joined = query(spark, "SELECT l_orderkey, o_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    kept = limit(joined, 50_000)
    return kept.selectExpr("count(*) AS rows", "count_if(l_orderkey = o_orderkey) AS joined")


def extract_top_ties(spark: SparkSession, sf: str) -> DataFrame:
    """The nth row lies among thousands of equal leading keys, NULLs first: the next keys cut them."""
    return extract(
        spark,
        sf,
        "lineitem",
        columns="l_returnflag, l_shipdate, l_orderkey, l_linenumber",
        predicate="l_quantity > 3",
        rows=21_000,
        keys=[("l_returnflag", "desc"), "l_shipdate", ("l_orderkey", "desc"), "l_linenumber"],
    )


def limit_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Which rows a limit keeps is open; they meet the predicate, and none is kept more often than the table has it."""
    kept = extract(spark, sf, "lineitem", predicate="l_quantity > 5", rows=45_000)
    beyond = kept.exceptAll(extract(spark, sf, "lineitem")).selectExpr("0L AS kept", "1L AS beyond", "true AS meets")
    counted = kept.selectExpr("1L AS kept", "0L AS beyond", "l_quantity > 5 AS meets").unionAll(beyond)
    return counted.selectExpr("sum(kept) AS rows", "sum(beyond) AS beyond", "every(meets) AS meets")


RAW = """
SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS top_price
FROM orders
WHERE o_orderdate >= '1997-01-01'
GROUP BY o_orderpriority
"""


def raw_sql(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, ["orders"])
    return extract(spark, "ignored", "ignored", rows=1, sql=RAW)


def self_join_names(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer beside the next one: names repeat, and one is taken already."""
    register(spark, sf, ["customer"])
    joined = query(
        spark,
        """
        SELECT a.c_nationkey, b.c_nationkey, b.c_name, a.c_name, b.c_mktsegment AS c_name_1
        FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1
        """,
    )
    return unique_columns(joined)


QUERIES = {
    "project_columns": project_columns,
    "filter_date_range": filter_date_range,
    "filter_in_ints": filter_in_ints,
    "filter_in_strings": filter_in_strings,
    "filter_between": filter_between,
    "extract_top": extract_top,
    "extract_top_large": extract_top_large,
    "extract_top_ties": extract_top_ties,
    "limit_rows": limit_rows,
    "limit_scan": limit_scan,
    "raw_sql": raw_sql,
    "self_join_names": self_join_names,
}

ORACLES = {
    "project_columns": "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem",
    "filter_date_range": """
        SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
        WHERE l_shipdate >= '1996-01-01' AND l_shipdate < '1997-01-01'
    """,
    "filter_in_ints": "SELECT p_partkey, p_size FROM part WHERE p_size IN (1, 7, 15, 28, 49)",
    "filter_in_strings": "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "filter_between": """
        SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN -100 AND 2500.5
    """,
    "extract_top": """
        SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        WHERE l_returnflag <> 'A'
        ORDER BY l_orderkey, l_extendedprice DESC, l_linenumber LIMIT 1000
    """,
    "extract_top_large": """
        SELECT l_orderkey, l_extendedprice FROM lineitem
        ORDER BY l_shipdate DESC, l_orderkey, l_extendedprice LIMIT 25000
    """,
    "extract_top_ties": """
        SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 3
        ORDER BY l_returnflag DESC NULLS FIRST, l_shipdate, l_orderkey DESC, l_linenumber LIMIT 21000
    """,
    "limit_scan": """
        SELECT least(count(*), 45000) AS "rows", CAST(0 AS BIGINT) AS beyond, TRUE AS meets
        FROM lineitem WHERE l_quantity > 5
    """,
    "limit_rows": """
        SELECT least(count(*), 50000) AS "rows", least(count(*), 50000) AS joined
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "raw_sql": RAW,
    "self_join_names": """
        SELECT a.c_nationkey, b.c_nationkey AS c_nationkey_1, b.c_name, a.c_name AS c_name_2,
               b.c_mktsegment AS c_name_1
        FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1
    """,
}
