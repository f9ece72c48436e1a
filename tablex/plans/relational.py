"""Queries over the relational and scalar features extracts use in their SQL texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablex.functions.normalize import normalize
from tablex.operators.extract import spread
from tablex.operators.profile import extract_count
from tablex.sources.tables import query, register, scan


def agg_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of exact numerics leave as doubles, as unconstrained numerics do."""
    register(spark, sf, ["orders"])
    totals = query(
        spark,
        """
        SELECT count(DISTINCT o_custkey) AS buyers,
               sum(o_custkey % 7) AS weekdays,
               sum(o_totalprice::decimal(14,2)) AS revenue,
               avg(length(o_orderpriority)) AS mean_label,
               avg(o_custkey % 100) FILTER (WHERE o_orderstatus <> 'F') AS open_slots,
               min(o_orderdate::date) AS first_day,
               max(o_orderdate) FILTER (WHERE o_orderpriority = '5-LOW') AS last_low
        FROM orders
        """,
    )
    return normalize(totals, {"revenue": "numeric", "mean_label": "numeric"}, decimal=True)


def string_agg_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Counted first, so that each text joins one entry per status, however many orders."""
    register(spark, sf, ["orders"])
    return query(
        spark,
        """
        SELECT o_orderpriority,
               string_agg(o_orderstatus || '=' || n, ',') WITHIN GROUP (ORDER BY o_orderstatus)
                   AS statuses
        FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n
              FROM orders GROUP BY o_orderpriority, o_orderstatus) counted
        GROUP BY o_orderpriority
        """,
    )


def generated_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A few delivery slots for every part, with values that hang on both."""
    register(spark, sf, ["part"])
    rows = query(
        spark,
        """
        SELECT p_partkey, slot,
               md5(p_name || '#' || slot::string) AS token,
               CASE WHEN p_size % 4 = slot THEN (p_size * 0.25)::numeric(8,2) END AS weight,
               CASE WHEN p_size % 10 = slot THEN repeat(p_name || ' · ', 400 + p_size)
                    ELSE p_brand || ' · ' || p_type END AS label,
               date '1995-03-01' + p_size * slot AS due
        FROM part, LATERAL explode(sequence(p_size % 3, 4)) AS slots(slot)
        """,
    )
    return normalize(rows, {"weight": "numeric(8,2)"})


GENERATED = """
SELECT r.{id} AS i, 's' || r.{id} AS s, CAST(r.{id} * 0.5 AS DOUBLE) AS x, date '2000-01-01' + CAST(r.{id} % 5000 AS INT) AS d,
       count(o_orderkey) AS orders, max(o_orderkey) AS last_order
FROM {rows} LEFT JOIN orders ON o_orderkey % 30005 + 1 = r.{id}
GROUP BY r.{id}
"""


def generated_range(spark: SparkSession, sf: str) -> DataFrame:
    """A relation of generated rows, and what orders fall on each."""
    register(spark, sf, ["orders"])
    return query(spark, GENERATED.format(id="id", rows="range(1, 30006) AS r"))


WIDTH = 1000


def wide_column(j: int) -> tuple[str, str]:
    """(source text, declared type) of the j-th column, a variation of one of a customer's cells."""
    kinds = [
        (f"CAST(c_custkey * {j + 3} AS STRING)", "bigint"),
        (f"substr(c_name || c_mktsegment, {1 + j % 9}, 12)", "text"),
        (f"CAST(CAST(c_acctbal AS DECIMAL(12,2)) + {j} AS STRING)", "numeric(12,2)"),
        (f"CAST(c_nationkey + {j} AS STRING)", "smallint"),
    ]
    return kinds[j % 4]


def wide_1000(spark: SparkSession, sf: str) -> DataFrame:
    """A thousand columns per customer, normalised from text, added up row by row."""
    columns = {f"c{j}": wide_column(j) for j in range(WIDTH)}
    texts = spread(scan(spark, sf, "customer"), WIDTH).selectExpr("c_custkey", *[f"{text} AS {c}" for c, (text, _) in columns.items()])
    wide = normalize(texts, {c: type_name for c, (_, type_name) in columns.items()})
    values = ["CAST({c} AS BIGINT)", "CAST(length({c}) AS BIGINT)", "CAST(floor({c} * 100 + 0.5D) AS BIGINT)", "CAST({c} AS BIGINT)"]
    names, chunk = ["keys", "characters", "cents", "nations"], 25
    sums = {}
    for kind, name in enumerate(names):
        cells = [values[kind].format(c=f"c{j}") for j in range(kind, WIDTH, 4)]
        for k in range(0, len(cells), chunk):
            sums[f"{name}_{k}"] = " + ".join(cells[k : k + chunk])
    parts = wide.selectExpr("c_custkey", *[f"{text} AS {name}" for name, text in sums.items()])
    return parts.selectExpr("c_custkey", *[" + ".join(s for s in sums if s.startswith(f"{name}_")) + f" AS {name}" for name in names])


def left_join_keys(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, ["conversations"])
    return query(
        spark,
        """
        SELECT a.conv_id, a.turn, a.role, coalesce(b.role, '') AS answered_by
        FROM conversations a
        LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
        """,
    )


def left_join_labels(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, ["documents", "labels"])
    return query(
        spark,
        """
        SELECT d.doc_id, d.lang, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
        """,
    )


def chained_joins(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, ["lineitem", "orders", "customer"])
    return query(
        spark,
        """
        SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_orderstatus, c.c_mktsegment
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        """,
    )


def count_subquery(spark: SparkSession, sf: str) -> DataFrame:
    """A count over a sub-query whose output repeats a name."""
    register(spark, sf, ["orders"])
    joined = query(
        spark, "SELECT a.o_orderkey, b.o_orderkey FROM orders a JOIN orders b USING (o_orderkey)"
    )
    return extract_count(joined)


def scalar_features(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, ["customer"])
    return query(spark, SCALARS.format(text="string"))


SCALARS = """
SELECT c_custkey AS "Odd Name",
       COALESCE(CASE WHEN c_custkey % 3 = 0 THEN c_name END, '') AS name,
       NOT (c_mktsegment IN ('BUILDING', 'MACHINERY')) AS other,
       c_nationkey::{text} || '/' || c_mktsegment AS joined
FROM customer
WHERE c_nationkey NOT IN (1, 2, 3) AND c_name NOT LIKE '%7'
"""

QUERIES = {
    "agg_filter": agg_filter,
    "string_agg_ordered": string_agg_ordered,
    "generated_rows": generated_rows,
    "generated_range": generated_range,
    "wide_1000": wide_1000,
    "left_join_keys": left_join_keys,
    "left_join_labels": left_join_labels,
    "chained_joins": chained_joins,
    "count_subquery": count_subquery,
    "scalar_features": scalar_features,
}

ORACLES = {
    "generated_range": GENERATED.format(id="g", rows="range(1, 30006) AS r(g)"),
    "agg_filter": """
        SELECT count(DISTINCT o_custkey) AS buyers,
               CAST(sum(o_custkey % 7) AS BIGINT) AS weekdays,
               CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS revenue,
               avg(length(o_orderpriority)) AS mean_label,
               avg(o_custkey % 100) FILTER (WHERE o_orderstatus <> 'F') AS open_slots,
               min(CAST(o_orderdate AS DATE)) AS first_day,
               max(o_orderdate) FILTER (WHERE o_orderpriority = '5-LOW') AS last_low
        FROM orders
    """,
    "string_agg_ordered": """
        SELECT o_orderpriority,
               string_agg(o_orderstatus || '=' || n, ',' ORDER BY o_orderstatus) AS statuses
        FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n
              FROM orders GROUP BY o_orderpriority, o_orderstatus) counted
        GROUP BY o_orderpriority
    """,
    "generated_rows": """
        SELECT p_partkey, slot,
               md5(p_name || '#' || slot) AS token,
               CASE WHEN p_size % 4 = slot THEN p_size * 0.25::DOUBLE END AS weight,
               CASE WHEN p_size % 10 = slot THEN repeat(p_name || ' · ', 400 + p_size)
                    ELSE p_brand || ' · ' || p_type END AS label,
               CAST(DATE '1995-03-01' + p_size * slot AS DATE) AS due
        FROM (SELECT *, CAST(unnest(generate_series(p_size % 3, 4)) AS INTEGER) AS slot FROM part)
    """,
    "wide_1000": f"""
        SELECT c_custkey,
               CAST(sum(c_custkey * (j + 3)) FILTER (WHERE j % 4 = 0) AS BIGINT) AS keys,
               CAST(sum(length(substr(c_name || c_mktsegment, 1 + j % 9, 12))) FILTER (WHERE j % 4 = 1) AS BIGINT)
                   AS characters,
               CAST(sum((CAST(c_acctbal AS DECIMAL(12,2)) + j) * 100) FILTER (WHERE j % 4 = 2) AS BIGINT) AS cents,
               CAST(sum(c_nationkey + j) FILTER (WHERE j % 4 = 3) AS BIGINT) AS nations
        FROM customer, (SELECT CAST(unnest(range({WIDTH})) AS INTEGER) AS j)
        GROUP BY c_custkey
    """,
    "left_join_keys": """
        SELECT a.conv_id, a.turn, a.role, coalesce(b.role, '') AS answered_by
        FROM conversations a
        LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
    """,
    "left_join_labels": """
        SELECT d.doc_id, d.lang, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    """,
    "chained_joins": """
        SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_orderstatus, c.c_mktsegment
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
    """,
    "count_subquery": """
        SELECT count(*) AS "rows" FROM orders a JOIN orders b USING (o_orderkey)
    """,
    "scalar_features": SCALARS.format(text="VARCHAR"),
}
