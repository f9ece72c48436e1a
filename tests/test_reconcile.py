import math
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablex import (
    actual_kinds,
    diff_cells,
    diff_counts,
    diff_report,
    diff_schema,
    fingerprint,
    reconcile,
    same,
    scan,
    verdict,
)
from tablex.plans.profiles import TABLES


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("CAST(NULL AS INT)", "CAST(NULL AS INT)", True),
        ("CAST(NULL AS STRING)", "''", False),
        ("1", "1", True),
        ("1", "2", False),
        ("double('NaN')", "double('NaN')", True),
        ("0D", "-0D", False),
        ("-0D", "-0D", True),
        ("0.1D", "CAST(0.1F AS DOUBLE)", False),
        ("double('NaN')", "CAST(NULL AS DOUBLE)", False),
        ("1.50BD", "1.5000BD", True),
        ("-0.01BD", "0.01BD", False),
        ("timestamp'2020-01-01'", "timestamp'2020-01-01 00:00:00.000001'", False),
        ("array(1, NULL)", "array(1, NULL)", True),
    ],
)
def test_same(spark, a, b, want):
    df = spark.sql(f"SELECT {a} AS a, {b} AS b")
    assert df.selectExpr(same("a", "b", df.schema["a"].dataType) + " AS s").first().s is want


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("0", "1000", True),
        ("0", "1001", False),
        ("9223372036854775807", "9223372036854775807", True),
        ("9223372036854775807", "9223372036854775000", True),
        ("9223372036854775807", "-9223372036854775807", False),
        ("9223372036854775806", "-9223372036854775806", False),
        ("NULL", "0", False),
        ("NULL", "NULL", True),
    ],
)
def test_same_instant_within_a_millisecond(spark, a, b, want):
    df = spark.sql(f"SELECT timestamp_micros({a}) AS a, timestamp_micros({b}) AS b")
    condition = same("a", "b", df.schema["a"].dataType, tolerance_us=1000)
    assert df.selectExpr(f"{condition} AS s").first().s is want


def test_schema_diff(spark):
    a = spark.sql("SELECT 1 AS id, 'x' AS s, 1.5D AS f")
    b = spark.sql("SELECT 1L AS id, 2 AS s, 1.5D AS g, 1 AS extra")
    rows = diff_schema(actual_kinds(a), actual_kinds(b)).orderBy("ordinal").collect()
    assert [tuple(r) for r in rows] == [
        (2, "s", "string", "s", "int"), (3, "f", "float", "g", "float"), (4, None, None, "extra", "int"),
    ]


def test_count_diff(spark):
    assert tuple(diff_counts(spark.range(3), spark.range(3)).first()) == (3, 3, True)
    assert tuple(diff_counts(spark.range(0), spark.range(3)).first()) == (0, 3, False)


@pytest.mark.parametrize("table", TABLES)
def test_a_table_equals_its_shuffled_copy(spark, small, table):
    df = scan(spark, small, table)
    key = df.columns[0]
    assert diff_cells(df, df.repartition(5).select("*"), [key]).isEmpty()


SCHEMA = "k string, n int, x double, d decimal(10,2), s string"


def test_exactly_the_changed_cells_are_named(spark):
    rows = [(f"k{i}", i, i * 0.5, Decimal(i), "v") for i in range(50)]
    changed = list(rows)
    changed[3] = ("k3", 3, -0.0, Decimal(3), "v")
    changed[4] = ("k4", None, 2.0, Decimal("4.01"), "")
    changed[0] = ("k0", 0, -0.0, Decimal(0), "v")
    del changed[10]
    changed.append(("new", 1, math.nan, None, None))
    diffs = diff_cells(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(changed, SCHEMA), ["k"])
    got = sorted((tuple(r) for r in diffs.collect()), key=str)
    assert got == sorted(
        [
            ("k0", "changed", "x", "0.0", "-0.0", 1),
            ("k3", "changed", "x", "1.5", "-0.0", 1),
            ("k4", "changed", "n", "4", None, 1),
            ("k4", "changed", "d", "4", "4.01", 1),
            ("k4", "changed", "s", "v", "", 1),
            ("k10", "missing", None, '["k10","10","5.0","10","v"]', None, 1),
            ("new", "extra", None, None, '["new","1","NaN",null,null]', 1),
        ],
        key=str,
    )


def test_missing_keys_pair_with_each_other(spark):
    a = spark.createDataFrame([(None, 1), ("", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 5), ("", 2)], "k string, v int")
    assert [tuple(r) for r in diff_cells(a, b, ["k"]).collect()] == [(None, "changed", "v", "1", "5", 1)]


def expected_differences(a, b, names):
    """The rule in plain Python: rows cancel copy by copy, single leftovers of a key pair up."""
    left, right = Counter(a), Counter(b)
    want, got = left - right, right - left
    out = Counter()
    for key in {r[0] for r in want} | {r[0] for r in got}:
        w = [r for r in want.elements() if r[0] == key]
        g = [r for r in got.elements() if r[0] == key]
        if len(w) == len(g) == 1:
            for name, x, y in zip(names, w[0], g[0]):
                if x != y:
                    out[(key, "changed", name, str(x), str(y), 1)] += 1
            continue
        for status, rows in (("missing", Counter(w)), ("extra", Counter(g))):
            for row, n in rows.items():
                text = "[" + ",".join(f'"{c}"' for c in row) + "]"
                pair = (text, None) if status == "missing" else (None, text)
                out[(key, status, None, *pair, n)] += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_tables_with_repeated_and_hot_keys(spark, seed):
    rng = random.Random(seed)

    def row():
        key = 0 if rng.random() < 0.4 else rng.randrange(40)
        return (key, rng.randrange(3), f"v{rng.randrange(3)}")

    a = [row() for _ in range(400)] + [(7, 1, "hot")] * 300
    b = list(a)
    for _ in range(30):
        b[rng.randrange(len(b))] = row()
    del b[5:15]
    names = ["k", "n", "s"]
    diffs = diff_cells(
        spark.createDataFrame(a, "k int, n int, s string").repartition(4),
        spark.createDataFrame(b, "k int, n int, s string").repartition(3),
        ["k"],
    )
    assert Counter(tuple(r) for r in diffs.collect()) == expected_differences(a, b, names)


def test_tolerance(spark):
    a = spark.sql("SELECT id, timestamp_micros(id * 10) AS t, 'x' AS s FROM range(6)")
    b = spark.sql("SELECT id, timestamp_micros(id * 10 + id * 300) AS t, 'x' AS s FROM range(6)")
    diffs = diff_cells(a, b, ["id"], tolerance_us=1000)
    assert sorted((r.id, r.column) for r in diffs.collect()) == [(4, "t"), (5, "t")]


def test_columns_must_agree(spark):
    with pytest.raises(ValueError):
        diff_cells(spark.range(1), spark.range(1).toDF("x"), ["id"])


def test_report_is_capped_per_column_and_counts_the_rest(spark):
    a = spark.range(100).selectExpr("id", "id AS x", "id AS y")
    b = spark.range(98).selectExpr("id", "id + 1 AS x", "CASE WHEN id < 2 THEN -1 ELSE id END AS y")
    report = diff_report(diff_cells(a, b, ["id"]), ["id"])
    rows = sorted((r.status, r.column or "", r.id, r.more) for r in report.collect())
    assert rows == [
        ("changed", "x", 0, 95), ("changed", "x", 1, 95), ("changed", "x", 2, 95),
        ("changed", "y", 0, 0), ("changed", "y", 1, 0),
        ("missing", "", 98, 0), ("missing", "", 99, 0),
    ]


def test_report_prunes_before_it_shuffles(spark):
    diffs = spark.range(1000).selectExpr(
        "id", "'changed' AS status", "concat('c', id % 3) AS column", "'a' AS want", "'b' AS got", "1L AS copies"
    )
    plan = diff_report(diffs, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_fingerprint_ignores_row_and_column_order(spark, small):
    df = scan(spark, small, "lineitem")
    want = fingerprint(df).first()
    shuffled = df.repartition(7, "l_partkey").select(*reversed(df.columns))
    assert fingerprint(shuffled).first() == want
    assert want.rows == df.count() and len(want.fingerprint) == 64


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT id, 'a' AS s FROM range(11)",
        "SELECT id, CASE id WHEN 3 THEN 'b' ELSE 'a' END AS s FROM range(10)",
        "SELECT id, CASE id WHEN 3 THEN NULL ELSE 'a' END AS s FROM range(10)",
        "SELECT id, 'a' AS t FROM range(10)",
        "SELECT id % 9 AS id, 'a' AS s FROM range(10)",
    ],
)
def test_fingerprint_sees_every_change(spark, sql):
    base = fingerprint(spark.sql("SELECT id, 'a' AS s FROM range(10)")).first().fingerprint
    assert fingerprint(spark.sql(sql)).first().fingerprint != base


def test_fingerprint_cells_cannot_run_together(spark):
    a = spark.sql("SELECT '1' AS a, '1:1' AS b")
    b = spark.sql("SELECT '1|1:1' AS a, '' AS b")
    c = spark.sql("SELECT '' AS a, CAST(NULL AS STRING) AS b")
    d = spark.sql("SELECT CAST(NULL AS STRING) AS a, '' AS b")
    prints = [fingerprint(df).first().fingerprint for df in (a, b, c, d)]
    assert len(set(prints)) == 4


def test_fingerprint_of_nothing(spark):
    assert fingerprint(spark.range(0)).first().rows == 0


def test_reconcile_and_verdict(spark):
    a = spark.sql("SELECT id, 'x' AS s, 1 AS n FROM range(5)")
    b = spark.sql("SELECT id, 'x' AS s, 1.5D AS n FROM range(4)")
    problems = reconcile(spark, {"same": (a, a, ["id"]), "other": (a, b, ["id"])})
    assert sorted(tuple(r) for r in problems.collect()) == [
        ("other", "missing", "4", '["4","x"]', None),
        ("other", "rows", "row count", "5", "4"),
        ("other", "schema", "column 3", "n int", "n float"),
    ]
    assert verdict(problems).first().equal is False
    assert verdict(reconcile(spark, {"same": (a, a, ["id"])})).first().equal is True
    assert verdict(reconcile(spark, {})).first().equal is True


def test_key_of_another_kind_still_pairs_rows(spark):
    a = spark.sql("SELECT id AS k, id * 2 AS v FROM range(4)")
    b = spark.sql("SELECT CAST(id AS STRING) AS k, CASE id WHEN 2 THEN -1L ELSE id * 2 END AS v FROM range(3)")
    problems = reconcile(spark, {"c": (a, b, ["k"])}).where("check <> 'rows'")
    assert sorted((r.check, r.subject, r.want, r.got) for r in problems.collect()) == [
        ("changed", "2 v", "4", "-1"),
        ("missing", "3", '["3","6"]', None),
        ("schema", "column 1", "k int", "k string"),
    ]


def test_extremes_keep_their_sign_only(spark):
    a = spark.sql("SELECT 1 AS k, timestamp_micros(9223372036854775807) AS t UNION ALL SELECT 2, timestamp_micros(-9223372036854775807) UNION ALL SELECT 3, timestamp_micros(9223372036854775807) UNION ALL SELECT 4, NULL")
    b = spark.sql("SELECT 1 AS k, timestamp_micros(9223372036854770000) AS t UNION ALL SELECT 2, timestamp_micros(-9223372036854775808) UNION ALL SELECT 3, timestamp_micros(-9223372036854775807) UNION ALL SELECT 4, NULL")
    assert [r.k for r in diff_cells(a, b, ["k"], tolerance_us=1).collect()] == [3]


def test_tolerance_sees_other_columns_and_missing_rows(spark):
    a = spark.sql("SELECT id, timestamp_micros(id * 10) AS t, 'x' AS s FROM range(6)")
    b = spark.sql("SELECT id, timestamp_micros(id * 10 + id % 3) AS t, CASE id WHEN 4 THEN 'y' ELSE 'x' END AS s FROM range(1, 7)")
    got = sorted((r.id, r.status, r.column) for r in diff_cells(a, b, ["id"], tolerance_us=1).collect())
    assert got == [(0, "missing", None), (2, "changed", "t"), (4, "changed", "s"), (5, "changed", "t"), (6, "extra", None)]


def test_a_reader_with_milliseconds_and_no_zones(spark):
    a = spark.sql("SELECT id, timestamp_micros(id * 1000000 + 999) AS t FROM range(4)")
    b = spark.sql("SELECT id, CAST(timestamp_millis(id * 1000) AS TIMESTAMP_NTZ) AS t FROM range(4)")
    cases = {"reader": (a, b, ["id"])}
    strict = reconcile(spark, cases)
    assert [tuple(r)[1:4] for r in strict.collect()] == [("schema", "column 2", "t timestamptz")]
    accepted = [("timestamptz", "timestamp")]
    assert reconcile(spark, cases, accepted=accepted).count() == 4
    assert verdict(reconcile(spark, cases, 1000, accepted)).first().equal is True
