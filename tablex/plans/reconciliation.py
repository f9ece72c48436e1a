"""Queries that reconcile a table with a copy of it that was changed in known places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablex.operators.extract import ordered
from tablex.operators.position import diff_rows
from tablex.operators.reconcile import (
    diff_cells,
    diff_counts,
    diff_report,
    fingerprint,
    reconcile,
    verdict,
)
from tablex.session import work_folder
from tablex.sinks.files import write
from tablex.sinks.ranges import diff_exports, write_ranges
from tablex.sources.tables import query, read_export, register, scan

# One order in a thousand changed, another dropped, another copied under a negative key.
CHANGED_ORDERS = """
SELECT o_orderkey,
       o_custkey,
       CASE o_orderkey % 1000 WHEN 0 THEN lower(o_orderstatus) ELSE o_orderstatus END
           AS o_orderstatus,
       CASE o_orderkey % 1000 WHEN 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       o_orderpriority
FROM orders WHERE o_orderkey % 1000 <> 1
UNION ALL
SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 1000 = 2
"""


def changed_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    register(spark, sf, ["orders"])
    return scan(spark, sf, "orders"), query(spark, CHANGED_ORDERS)


def cell_diff(spark: SparkSession, sf: str) -> DataFrame:
    return diff_cells(*changed_orders(spark, sf), ["o_orderkey"])


def cell_diff_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """The same differences, found from sketches."""
    return diff_cells(*changed_orders(spark, sf), ["o_orderkey"], sketch=True)


def cell_diff_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The same differences from two exports that keep fingerprints of key ranges; only ranges that differ are read."""
    source, changed = changed_orders(spark, sf)
    folder = work_folder(spark, "ranges")
    write_ranges(source, f"{folder}/want", "o_orderkey")
    write_ranges(changed, f"{folder}/got", "o_orderkey", like=f"{folder}/want")
    return diff_exports(spark, f"{folder}/want", f"{folder}/got", ["o_orderkey"])


def cell_diff_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed by supplier and line number, which name no single row: rows are matched as copies."""
    register(spark, sf, ["lineitem"])
    columns = "l_suppkey, l_linenumber, l_returnflag, l_linestatus"
    want = query(spark, f"SELECT {columns} FROM lineitem")
    got = query(
        spark,
        f"""
        SELECT l_suppkey, l_linenumber,
               CASE WHEN l_partkey % 500 = 3 THEN 'X' ELSE l_returnflag END AS l_returnflag,
               l_linestatus
        FROM lineitem WHERE l_partkey % 500 <> 7
        """,
    )
    diffs = diff_cells(want, got, ["l_suppkey", "l_linenumber"])
    net = F.when(F.col("status") != "extra", F.col("copies")).otherwise(0)
    gained = F.when(F.col("status") != "missing", F.col("copies")).otherwise(0)
    return diffs.groupBy("l_suppkey", "l_linenumber").agg(
        F.sum(net).alias("want_copies"), F.sum(gained).alias("got_copies")
    )


def diff_samples(spark: SparkSession, sf: str) -> DataFrame:
    return diff_report(cell_diff(spark, sf), ["o_orderkey"])


def timestamp_tolerance(spark: SparkSession, sf: str) -> DataFrame:
    """Event times off by up to 1 ms pass, those off by 2 ms do not."""
    register(spark, sf, ["events"])
    shifted = query(
        spark,
        """
        SELECT event_id, user_id, event_type, value, props,
               CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN ts + INTERVAL '0.0005' SECOND
                                 WHEN 2 THEN ts - INTERVAL '0.001' SECOND
                                 ELSE ts + INTERVAL '0.002' SECOND END AS ts
        FROM events
        """,
    )
    source = scan(spark, sf, "events").select(*shifted.columns)
    return diff_cells(source, shifted, ["event_id"], tolerance_us=1000)


PUT_IN = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 500 = 4 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus
FROM orders
UNION ALL SELECT (SELECT max(o_orderkey) FROM orders) * 3 div 4, -1, 'new'
"""


def row_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Two ordered exports compared row by row; one row put in moves all that follow it."""
    register(spark, sf, ["orders"])
    folder, keys = work_folder(spark, "rows"), ["o_orderkey", "o_custkey"]
    source = scan(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for name, df in (("want", source), ("got", query(spark, PUT_IN))):
        write(ordered(df, keys), f"{folder}/{name}.parquet")
    return diff_rows(*[read_export(spark, f"{folder}/{name}.parquet") for name in ("want", "got")], scanned=True)


def count_diff(spark: SparkSession, sf: str) -> DataFrame:
    return diff_counts(*changed_orders(spark, sf))


def reconcile_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Two cases: an unchanged copy, and one with changed rows and one column as text."""
    source, changed = changed_orders(spark, sf)
    retyped = changed.withColumn("o_custkey", F.col("o_custkey").cast("string"))
    shuffled = source.repartition("o_custkey")
    return reconcile(
        spark,
        {
            "same": (source, shuffled, ["o_orderkey"]),
            "changed": (source, retyped, ["o_orderkey"]),
        },
    )


def reconcile_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """Customers against a copy that lost some and has other balances in some."""
    source = scan(spark, sf, "customer")
    copy = source.where("c_custkey % 100 <> 7").selectExpr(
        "c_custkey", "c_name", "c_nationkey",
        "CASE WHEN c_custkey % 100 = 9 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal", "c_mktsegment",
    )
    return verdict(reconcile(spark, {"copy": (source, copy, ["c_custkey"])}))


def document_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint(scan(spark, sf, "documents"))


LINE_NAMES = (
    "l_discount,l_extendedprice,l_linenumber,l_linestatus,l_orderkey,l_partkey,l_quantity,"
    "l_returnflag,l_shipdate,l_suppkey,l_tax"
)


def lineitem_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint(scan(spark, sf, "lineitem"))


def tolerance_of_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by priority, status and moment only: of one day's orders those moved by six hours match, one to one; one in twenty moves by 13."""
    register(spark, sf, ["orders"])
    source = query(spark, "SELECT o_orderpriority, o_orderstatus, CAST(o_orderdate AS TIMESTAMP) AS moment FROM orders")
    moved = query(
        spark,
        "SELECT o_orderpriority, o_orderstatus, CAST(o_orderdate AS TIMESTAMP)"
        " + CASE WHEN o_orderkey % 20 = 0 THEN INTERVAL '13' HOUR ELSE INTERVAL '6' HOUR END AS moment FROM orders",
    )
    return diff_cells(source, moved, ["o_orderpriority"], tolerance_us=7 * 3_600_000_000)


QUERIES = {
    "cell_diff": cell_diff,
    "cell_diff_sketch": cell_diff_sketch,
    "cell_diff_ranges": cell_diff_ranges,
    "cell_diff_copies": cell_diff_copies,
    "diff_report": diff_samples,
    "timestamp_tolerance": timestamp_tolerance,
    "tolerance_of_repeated_keys": tolerance_of_repeated_keys,
    "row_diff": row_diff,
    "count_diff": count_diff,
    "reconcile": reconcile_orders,
    "reconcile_verdict": reconcile_verdict,
    "fingerprint": document_fingerprint,
    "fingerprint_lineitem": lineitem_fingerprint,
}

ROW = """
'["' || o_orderkey || '","' || o_custkey || '","' || o_orderstatus || '","'
     || o_totalprice || '","' || epoch_us(o_orderdate) || '","' || o_orderpriority || '"]'
"""
ROW_AS_EXTRA = ROW.replace("o_orderkey ||", "-o_orderkey ||")

DUCK_CELLS = f"""
SELECT o_orderkey, 'changed' AS status, 'o_orderstatus' AS "column", o_orderstatus AS want,
       lower(o_orderstatus) AS got, CAST(1 AS BIGINT) AS copies
FROM orders WHERE o_orderkey % 1000 = 0
UNION ALL
SELECT o_orderkey, 'changed', 'o_totalprice', CAST(o_totalprice AS VARCHAR),
       CAST(o_totalprice * 2 AS VARCHAR), 1
FROM orders WHERE o_orderkey % 1000 = 0
UNION ALL
SELECT o_orderkey, 'missing', NULL, {ROW}, NULL, 1 FROM orders WHERE o_orderkey % 1000 = 1
UNION ALL
SELECT -o_orderkey, 'extra', NULL, NULL, {ROW_AS_EXTRA}, 1
FROM orders WHERE o_orderkey % 1000 = 2
"""

ORACLES = {
    "cell_diff": DUCK_CELLS,
    "cell_diff_sketch": DUCK_CELLS,
    "cell_diff_ranges": DUCK_CELLS,
    "row_diff": f"""
        WITH want AS (
            SELECT row_number() OVER (ORDER BY o_orderkey, o_custkey) - 1 AS "row", o_orderkey, o_custkey, o_orderstatus FROM orders
        ), got AS (
            SELECT row_number() OVER (ORDER BY o_orderkey, o_custkey) - 1 AS "row", o_orderkey AS k, o_custkey AS c, o_orderstatus AS s
            FROM ({PUT_IN.replace(" div ", " // ")}) AS other
        ), pairs AS (
            SELECT * FROM want JOIN got USING ("row")
        )
        SELECT "row", 'changed' AS status, 'o_orderkey' AS "column", CAST(o_orderkey AS VARCHAR) AS want, CAST(k AS VARCHAR) AS got
        FROM pairs WHERE o_orderkey <> k
        UNION ALL
        SELECT "row", 'changed', 'o_custkey', CAST(o_custkey AS VARCHAR), CAST(c AS VARCHAR) FROM pairs WHERE o_custkey <> c
        UNION ALL
        SELECT "row", 'changed', 'o_orderstatus', o_orderstatus, s FROM pairs WHERE o_orderstatus <> s
        UNION ALL
        SELECT "row", 'extra', NULL, NULL, '["' || k || '","' || c || '","' || s || '"]'
        FROM got WHERE "row" >= (SELECT count(*) FROM orders)
    """,
    "cell_diff_copies": """
        WITH want AS (
            SELECT l_suppkey, l_linenumber, l_returnflag, l_linestatus, count(*) AS n
            FROM lineitem GROUP BY ALL
        ), got AS (
            SELECT l_suppkey, l_linenumber,
                   CASE WHEN l_partkey % 500 = 3 THEN 'X' ELSE l_returnflag END AS l_returnflag,
                   l_linestatus, count(*) AS n
            FROM lineitem WHERE l_partkey % 500 <> 7 GROUP BY ALL
        ), rest AS (
            SELECT l_suppkey, l_linenumber, coalesce(want.n, 0) - coalesce(got.n, 0) AS surplus
            FROM want FULL JOIN got USING (l_suppkey, l_linenumber, l_returnflag, l_linestatus)
        )
        SELECT l_suppkey, l_linenumber,
               CAST(sum(greatest(surplus, 0)) AS BIGINT) AS want_copies,
               CAST(sum(greatest(-surplus, 0)) AS BIGINT) AS got_copies
        FROM rest WHERE surplus <> 0 GROUP BY l_suppkey, l_linenumber
    """,
    "diff_report": f"""
        SELECT o_orderkey, status, "column", want, got, copies, "rank",
               greatest(total - 3, 0) AS more
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY status, "column"
                                                ORDER BY o_orderkey) AS INTEGER) AS "rank",
                     count(*) OVER (PARTITION BY status, "column") AS total
              FROM ({DUCK_CELLS}))
        WHERE "rank" <= 3
    """,
    "timestamp_tolerance": """
        SELECT event_id, 'changed' AS status, 'ts' AS "column",
               CAST(epoch_us(ts) AS VARCHAR) AS want, CAST(epoch_us(ts) + 2000 AS VARCHAR) AS got,
               CAST(1 AS BIGINT) AS copies
        FROM events WHERE event_id % 4 = 3
    """,
    "tolerance_of_repeated_keys": """
        WITH far AS (
            SELECT o_orderpriority, o_orderstatus, epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS moment, count(*) AS copies
            FROM orders WHERE o_orderkey % 20 = 0 GROUP BY ALL
        ), both_sides AS (
            SELECT *, 'missing' AS status FROM far
            UNION ALL SELECT o_orderpriority, o_orderstatus, moment + 46800000000, copies, 'extra' FROM far
        ), texts AS (
            SELECT *, '["' || o_orderpriority || '","' || o_orderstatus || '","' || moment || '"]' AS cells FROM both_sides
        )
        SELECT o_orderpriority, status, CAST(NULL AS VARCHAR) AS "column",
               CASE status WHEN 'missing' THEN cells END AS want, CASE status WHEN 'extra' THEN cells END AS got, copies
        FROM texts
    """,
    "count_diff": f"""
        SELECT want_rows, got_rows, want_rows = got_rows AS equal
        FROM (SELECT count(*) AS want_rows FROM orders),
             (SELECT count(*) AS got_rows FROM ({CHANGED_ORDERS}))
    """,
    "reconcile": f"""
        WITH rows_of AS (
            SELECT (SELECT count(*) FROM orders) AS want,
                   (SELECT count(*) FROM ({CHANGED_ORDERS})) AS got
        )
        SELECT 'changed' AS "case", 'schema' AS "check", 'column 2' AS subject,
               'o_custkey int' AS want, 'o_custkey string' AS got
        UNION ALL
        SELECT 'changed', 'rows', 'row count', CAST(want AS VARCHAR), CAST(got AS VARCHAR)
        FROM rows_of WHERE want <> got
        UNION ALL
        SELECT 'changed', status, concat_ws(' ', CAST(o_orderkey AS VARCHAR), "column"),
               replace(want, cust, ''), replace(got, cust, '')
        FROM (SELECT d.*, '"' || o.o_custkey || '",' AS cust
              FROM ({DUCK_CELLS}) d JOIN orders o ON o.o_orderkey = abs(d.o_orderkey))
    """,
    "reconcile_verdict": """
        SELECT count(*) FILTER (WHERE c_custkey % 100 IN (7, 9))
                   + CAST(count(*) FILTER (WHERE c_custkey % 100 = 7) > 0 AS BIGINT) AS problems,
               count(*) FILTER (WHERE c_custkey % 100 IN (7, 9)) = 0 AS equal
        FROM customer
    """,
    "fingerprint": """
        WITH digests AS (
            SELECT sha256(concat_ws('|', doc_id, length(lang) || ':' || lang, n_chars,
                                    length(source) || ':' || source,
                                    length(text) || ':' || text)) AS d
            FROM documents
        ), words AS (
            SELECT CAST('0x' || substr(d, 1, 15) AS BIGINT) AS w0,
                   CAST('0x' || substr(d, 16, 15) AS BIGINT) AS w1
            FROM digests
        ), totals AS (
            SELECT count(*) AS n,
                   concat_ws('|', sum(w0 >> 40), sum((w0 >> 20) & 1048575), sum(w0 & 1048575),
                                  sum(w1 >> 40), sum((w1 >> 20) & 1048575), sum(w1 & 1048575))
                       AS sums
            FROM words
        )
        SELECT n AS "rows", 'doc_id,lang,n_chars,source,text' AS "columns",
               sha256('doc_id,lang,n_chars,source,text|' || n || '|' || sums) AS fingerprint
        FROM totals
    """,
    "fingerprint_lineitem": f"""
        WITH digests AS (
            SELECT sha256(concat_ws('|', l_discount, l_extendedprice, l_linenumber, length(l_linestatus) || ':' || l_linestatus,
                                    l_orderkey, l_partkey, l_quantity, length(l_returnflag) || ':' || l_returnflag,
                                    epoch_us(l_shipdate), l_suppkey, l_tax)) AS d
            FROM lineitem
        ), words AS (
            SELECT CAST('0x' || substr(d, 1, 15) AS BIGINT) AS w0, CAST('0x' || substr(d, 16, 15) AS BIGINT) AS w1
            FROM digests
        ), totals AS (
            SELECT count(*) AS n,
                   concat_ws('|', sum(w0 >> 40), sum((w0 >> 20) & 1048575), sum(w0 & 1048575),
                                  sum(w1 >> 40), sum((w1 >> 20) & 1048575), sum(w1 & 1048575)) AS sums
            FROM words
        )
        SELECT n AS "rows", '{LINE_NAMES}' AS "columns", sha256('{LINE_NAMES}|' || n || '|' || sums) AS fingerprint
        FROM totals
    """,
}
