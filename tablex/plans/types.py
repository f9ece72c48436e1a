"""Queries over the type rules: normalisation from text, numerics, temporal values, dumps."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablex.functions.declared import expected_kinds, with_numeric_type
from tablex.functions.normalize import normalize, refused
from tablex.functions.temporal import encode_temporal
from tablex.session import work_folder
from tablex.sinks.copytext import dump_types, write_copy
from tablex.sources.copytext import read_copy, read_types
from tablex.sources.tables import query, register, scan

# A text for every declared type, made from each line item's own cells; the special values stand
# where the line number says so.
SOURCE_TEXT = """
SELECT l_orderkey::string AS order_no,
       CASE WHEN l_discount > 0.05 THEN 'true' WHEN l_discount > 0.02 THEN 'no' END AS rebate,
       l_linenumber::string AS line,
       (l_suppkey % 1000 - 500)::string AS shift,
       (l_orderkey * 1000000007)::string AS wide_no,
       CASE l_linenumber WHEN 7 THEN 'Infinity' ELSE (l_quantity / 4)::string END AS quarter,
       CASE l_linenumber WHEN 2 THEN '-Infinity' WHEN 5 THEN 'NaN' WHEN 6 THEN '-0'
                         ELSE l_extendedprice::string END AS amount,
       CASE l_linenumber WHEN 3 THEN NULL ELSE (l_quantity::int * 3)::string END AS pieces,
       CASE l_linenumber WHEN 4 THEN 'NaN' ELSE l_tax::decimal(9,3)::string END AS tax_rate,
       (CASE l_linestatus WHEN 'O' THEN '-' ELSE '' END)
           || l_extendedprice::decimal(12,2)::string || '0478' AS margin,
       l_partkey::string || '.25' AS shelf,
       CASE l_linenumber WHEN 1 THEN '-infinity' WHEN 2 THEN 'infinity'
                         ELSE l_shipdate::date::string END AS shipped,
       CASE l_linenumber WHEN 3 THEN 'infinity'
                         ELSE l_shipdate::date::string || ' 17:45:30.5' END AS packed,
       CASE l_linenumber WHEN 1 THEN '-infinity'
                         WHEN 2 THEN l_shipdate::date::string || ' 23:15:00+09'
                         ELSE l_shipdate::date::string || ' 00:20:00-03:30' END AS sent,
       '2' || (l_linenumber % 4) || ':07:00.25' AS gate,
       l_returnflag || ' ¿' || l_linestatus || '?' AS remark,
       CASE l_returnflag WHEN 'N' THEN '      '
                         ELSE rpad(l_returnflag || ' ' || l_linestatus, 6, ' ') END AS code,
       '{' || l_suppkey || ',' || l_linenumber || '}' AS steps,
       NULL::string AS nothing
FROM lineitem
"""

DECLARED = {
    "order_no": "bigint",
    "rebate": "boolean",
    "line": "smallint",
    "shift": "integer",
    "wide_no": "bigint",
    "quarter": "real",
    "amount": "double precision",
    "pieces": "numeric",
    "tax_rate": "numeric(9,3)",
    "margin": "numeric(15,5)",
    "shelf": "numeric(18,2)",
    "shipped": "date",
    "packed": "timestamp without time zone",
    "sent": "timestamp with time zone",
    "gate": "time without time zone",
    "remark": "text",
    "code": "character(6)",
    "steps": "integer[]",
    "nothing": "smallint",
}


def labelled(df: DataFrame, name: str) -> DataFrame:
    """A float column as its finite value and a label, since NaN has no equal in most clients."""
    labels = "map('NaN', 'nan', 'Infinity', 'inf', '-Infinity', '-inf', '0.0', '0', '-0.0', '-0')"
    label = f"nvl2({name}, coalesce(try_element_at({labels}, CAST({name} AS STRING)), 'finite'), NULL)"
    finite = f"CASE WHEN abs({name}) > 0 AND abs({name}) < double('Infinity') THEN {name} END"
    return df.withColumns({f"{name}_label": F.expr(label), name: F.expr(finite)})


def normalize_types(spark: SparkSession, sf: str, decimal: bool) -> DataFrame:
    register(spark, sf, ["lineitem"])
    out = encode_temporal(normalize(query(spark, SOURCE_TEXT), DECLARED, decimal))
    for name in ["quarter", "amount"] if decimal else ["quarter", "amount", "tax_rate"]:
        out = labelled(out, name)
    return out


def expected_types(decimal: bool) -> str:
    price = "CAST(l_extendedprice AS DECIMAL(12,2))"
    tax = "CAST(l_tax AS DECIMAL(9,3))"
    day = "date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))"
    sign = "CASE l_linestatus WHEN 'O' THEN -1 ELSE 1 END"
    if decimal:
        exact = f"""
            CASE WHEN l_linenumber <> 4 THEN {tax} END AS tax_rate,
            CAST({sign} * ({price} + 0.00047) AS DECIMAL(15,5)) AS margin
        """
    else:
        exact = f"""
            CASE WHEN l_linenumber <> 4 AND {tax} > 0 THEN CAST({tax} AS DOUBLE) END AS tax_rate,
            CASE WHEN l_linenumber = 4 THEN 'nan' WHEN {tax} = 0 THEN '0' ELSE 'finite' END
                AS tax_rate_label,
            CAST({sign} * ({price} + 0.000478) AS DOUBLE) AS margin
        """
    return f"""
        SELECT l_orderkey AS order_no,
               CASE WHEN l_discount > 0.05 THEN true WHEN l_discount > 0.02 THEN false END AS rebate,
               l_linenumber AS line,
               CAST(l_suppkey % 1000 - 500 AS INTEGER) AS shift,
               l_orderkey * 1000000007 AS wide_no,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity / 4 AS FLOAT) END AS quarter,
               CASE WHEN l_linenumber = 7 THEN 'inf' ELSE 'finite' END AS quarter_label,
               CASE WHEN l_linenumber NOT IN (2, 5, 6) THEN l_extendedprice END AS amount,
               CASE l_linenumber WHEN 2 THEN '-inf' WHEN 5 THEN 'nan' WHEN 6 THEN '-0'
                                 ELSE 'finite' END AS amount_label,
               CASE WHEN l_linenumber <> 3 THEN l_quantity * 3 END AS pieces,
               l_partkey + 0.25::DOUBLE AS shelf,
               CAST(CASE l_linenumber WHEN 1 THEN -2147483647 WHEN 2 THEN 2147483647
                                      ELSE {day} END AS INTEGER) AS shipped,
               CASE l_linenumber WHEN 3 THEN 9223372036854775807
                    ELSE {day} * 86400000000 + 63930500000 END AS packed,
               CASE l_linenumber WHEN 1 THEN -9223372036854775807
                    WHEN 2 THEN {day} * 86400000000 + 51300000000
                    ELSE {day} * 86400000000 + 13800000000 END AS sent,
               CAST(72420250000 + 3600000000 * (l_linenumber % 4) AS BIGINT) AS gate,
               l_returnflag || ' ¿' || l_linestatus || '?' AS remark,
               CASE l_returnflag WHEN 'N' THEN '' ELSE l_returnflag || ' ' || l_linestatus END AS code,
               '{{' || l_suppkey || ',' || l_linenumber || '}}' AS steps,
               CAST(NULL AS INTEGER) AS nothing,
               {exact}
        FROM lineitem
    """


def numeric_values(spark: SparkSession, sf: str, decimal: bool) -> DataFrame:
    prices = scan(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    types = {"l_extendedprice": "numeric(12,2)", "l_discount": "numeric(20,2)"}
    return normalize(prices, types, decimal)


def typmod_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Type modifiers built from every line item: precision 1..60, scale -3..3."""
    register(spark, sf, ["lineitem"])
    catalog = query(
        spark,
        """
        SELECT l_orderkey AS attrelid, l_linenumber AS attnum,
               CASE l_returnflag WHEN 'N' THEN -1
                    ELSE ((1 + l_partkey % 60) * 65536 + ((l_linenumber - 4) & 2047) + 4)::int
               END AS atttypmod
        FROM lineitem
        """,
    )
    return with_numeric_type(catalog)


TYPE_NAMES = """
SELECT CASE l_linenumber
           WHEN 1 THEN 'numeric(' || (1 + l_partkey % 20) || ',' || (l_suppkey % 5) || ')'
           WHEN 2 THEN 'character varying(' || (1 + l_partkey % 20) || ')'
           WHEN 3 THEN 'timestamp with time zone'
           WHEN 4 THEN CASE l_returnflag WHEN 'R' THEN 'smallint' WHEN 'A' THEN 'real'
                                         ELSE 'double precision' END
           WHEN 5 THEN 'time(3) without time zone'
           WHEN 6 THEN CASE l_linestatus WHEN 'F' THEN 'integer[]' ELSE 'boolean' END
           ELSE 'date' END AS type
FROM lineitem
"""


def declared_kinds(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, ["lineitem"])
    kinds = expected_kinds(query(spark, TYPE_NAMES), decimal=True)
    return kinds.groupBy("type", "kind").agg(F.count(F.lit(1)).alias("columns"))


def temporal_encode(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, ["events"])
    return encode_temporal(
        query(
            spark,
            """
            SELECT event_id, ts, ts::date AS d, ts::timestamp AS tstz,
                   date_format(ts, 'HH:mm:ss.SSSSSS')::time(6) AS tm
            FROM events
            """,
        )
    )


def char_unpad(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, ["customer"])
    padded = query(
        spark, "SELECT c_custkey, rpad(' ' || c_mktsegment, 25, ' ') AS segment FROM customer"
    )
    return normalize(padded, {"segment": "character(25)"})


def text_roundtrip(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A table dumped as text, read back and normalised from its declared types."""
    source = scan(spark, sf, table)
    path = f"{work_folder(spark, table)}/dump"
    write_copy(source, path)
    types = dump_types(source)
    return normalize(read_copy(spark, path, types), types)


UNSURE = """
SELECT l_orderkey, l_linenumber,
       CASE l_partkey % 50 WHEN 3 THEN l_tax::string || 'x' WHEN 4 THEN '1.2.3' WHEN 5 THEN '7d'
                           ELSE l_extendedprice::string END AS price,
       CASE l_suppkey % 40 WHEN 1 THEN l_shipdate::date::string || ' 10:00:00+02'
                           ELSE l_shipdate::date::string || ' 10:00:00' END AS shipped
FROM lineitem
"""


def refused_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Which line items a strict load would refuse, and for which columns."""
    register(spark, sf, ["lineitem"])
    found = refused(query(spark, UNSURE), {"price": "numeric(10,2)", "shipped": "timestamp"})
    return found.selectExpr("l_orderkey", "l_linenumber", "array_join(refused, ',') AS refused")


def types_file(spark: SparkSession, sf: str) -> DataFrame:
    """Orders loaded from a dump whose column types stand in a file of their own."""
    source = scan(spark, sf, "orders")
    folder = work_folder(spark, "typed")
    write_copy(source, f"{folder}/dump")
    lines = spark.createDataFrame([(f"{name}\t{kind}",) for name, kind in dump_types(source)], "value string")
    lines.coalesce(1).write.text(f"{folder}/types")
    types = read_types(spark, f"{folder}/types")
    return normalize(read_copy(spark, f"{folder}/dump", types), types)


def text_roundtrip_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays leave as their text; read back, the text gives every item again."""
    rows = text_roundtrip(spark, sf, "embeddings")
    items = "posexplode(transform(split(substr(embedding, 2, length(embedding) - 2), ','), x -> CAST(x AS FLOAT)))"
    return rows.selectExpr("vec_id", "label", f"{items} AS (place, item)")


ROUNDTRIPS = [
    "region",
    "nation",
    "lineitem",
    "orders",
    "customer",
    "supplier",
    "part",
    "events",
    "documents",
    "conversations",
    "pages",
    "benchmark",
    "labels",
]

QUERIES = {
    "normalize_types_double": partial(normalize_types, decimal=False),
    "normalize_types_decimal": partial(normalize_types, decimal=True),
    "numeric_double": partial(numeric_values, decimal=False),
    "numeric_decimal": partial(numeric_values, decimal=True),
    "typmod_decode": typmod_decode,
    "declared_kinds": declared_kinds,
    "temporal_encode": temporal_encode,
    "char_unpad": char_unpad,
    **{f"text_roundtrip_{t}": partial(text_roundtrip, table=t) for t in ROUNDTRIPS},
    "text_roundtrip_embeddings": text_roundtrip_embeddings,
    "refused_texts": refused_texts,
    "types_file": types_file,
}

DUCK_TYPE_NAMES = """
SELECT CASE l_linenumber
           WHEN 1 THEN 'numeric(' || (1 + l_partkey % 20) || ',' || (l_suppkey % 5) || ')'
           WHEN 2 THEN 'character varying(' || (1 + l_partkey % 20) || ')'
           WHEN 3 THEN 'timestamp with time zone'
           WHEN 4 THEN CASE l_returnflag WHEN 'R' THEN 'smallint' WHEN 'A' THEN 'real'
                                         ELSE 'double precision' END
           WHEN 5 THEN 'time(3) without time zone'
           WHEN 6 THEN CASE l_linestatus WHEN 'F' THEN 'integer[]' ELSE 'boolean' END
           ELSE 'date' END AS type,
       CASE l_linenumber
           WHEN 1 THEN CASE WHEN l_partkey % 20 < 16 AND l_suppkey % 5 <= 1 + l_partkey % 20
                            THEN 'decimal' ELSE 'float' END
           WHEN 2 THEN 'string'
           WHEN 3 THEN 'timestamptz'
           WHEN 4 THEN CASE l_returnflag WHEN 'R' THEN 'int' WHEN 'A' THEN 'float32'
                                         ELSE 'float' END
           WHEN 5 THEN 'time'
           WHEN 6 THEN CASE l_linestatus WHEN 'F' THEN 'string' ELSE 'bool' END
           ELSE 'date' END AS kind
FROM lineitem
"""

ORACLES = {
    "normalize_types_double": expected_types(decimal=False),
    "normalize_types_decimal": expected_types(decimal=True),
    "numeric_double": """
        SELECT l_orderkey, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS l_extendedprice,
               l_discount
        FROM lineitem
    """,
    "numeric_decimal": """
        SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice, l_discount
        FROM lineitem
    """,
    "typmod_decode": """
        SELECT l_orderkey AS attrelid, l_linenumber AS attnum,
               CASE WHEN l_returnflag = 'N' THEN -1
                    ELSE CAST((1 + l_partkey % 60) * 65536
                              + (CASE WHEN l_linenumber < 4 THEN 2044 + l_linenumber
                                      ELSE l_linenumber - 4 END) + 4 AS INTEGER)
               END AS atttypmod,
               CASE WHEN l_returnflag <> 'N' THEN CAST(1 + l_partkey % 60 AS INTEGER) END
                   AS "precision",
               CASE WHEN l_returnflag <> 'N' THEN l_linenumber - 4 END AS scale
        FROM lineitem
    """,
    "declared_kinds": f"""
        SELECT type, kind, count(*) AS "columns" FROM ({DUCK_TYPE_NAMES}) GROUP BY type, kind
    """,
    "temporal_encode": """
        SELECT event_id, epoch_us(ts) AS ts,
               CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS d,
               epoch_us(ts) AS tstz,
               epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS tm
        FROM events
    """,
    "char_unpad": "SELECT c_custkey, ' ' || c_mktsegment AS segment FROM customer",
    **{f"text_roundtrip_{t}": f"SELECT * FROM {t}" for t in ROUNDTRIPS},
    "types_file": "SELECT * FROM orders",
    "refused_texts": """
        SELECT l_orderkey, l_linenumber,
               concat_ws(',', CASE WHEN l_partkey % 50 IN (3, 4, 5) THEN 'price' END,
                              CASE WHEN l_suppkey % 40 = 1 THEN 'shipped' END) AS refused
        FROM lineitem WHERE l_partkey % 50 IN (3, 4, 5) OR l_suppkey % 40 = 1
    """,
    "text_roundtrip_embeddings": """
        SELECT vec_id, label, CAST(i AS INTEGER) AS place, embedding[i + 1] AS item
        FROM (SELECT *, unnest(range(len(embedding))) AS i FROM embeddings)
    """,
}
