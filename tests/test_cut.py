"""Limits and top-n cut by counts, against Python's sort; no exchange to one partition."""

import math
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablex.operators.cut import by_place, first_rows, top_rows
from tablex.operators.extract import extract

SCHEMA = "k int, d double, s string, t timestamp_ntz, day date, n decimal(12,3), z timestamp"


def made(seed, rows=3000):
    rng = random.Random(seed)
    some = lambda value: None if rng.random() < 0.08 else value
    out = []
    for _ in range(rows):
        out.append(
            (
                some(rng.choice([1, 1, 1, 2, 3, rng.randrange(100)])),
                some(rng.choice([math.nan, -math.inf, math.inf, -0.0, 0.0, rng.random(), rng.gauss(0, 1e9)])),
                some(rng.choice(["", "a", "é'\"\\", "z" * 30, str(rng.randrange(500))])),
                some(datetime(2020, 1, 1) + timedelta(microseconds=rng.randrange(10**9))),
                some(date(1, 1, 1) + timedelta(days=rng.randrange(3_000_000))),
                some(Decimal(rng.randrange(-(10**9), 10**9)) / 1000),
                some(datetime(1999, 12, 31, 23) + timedelta(seconds=rng.randrange(9000))),
            )
        )
    return out


def rank(value):
    """NULL above NaN above every other value; both zeros alike."""
    if value is None:
        return (2, 0)
    if isinstance(value, float) and math.isnan(value):
        return (1, 0)
    return (0, value)


def expected(rows, names, keys, n):
    order = list(range(len(rows)))
    for name, descending in reversed(keys):
        order.sort(key=lambda i: rank(rows[i][names.index(name)]), reverse=descending)
    return [[rank(rows[i][names.index(k)]) for k, _ in keys] for i in order[:n]]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = made(5)
    path = f"{tmp_path_factory.mktemp('cut')}/rows"
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(path)
    return rows, spark.read.parquet(path)


KEYS = [
    [("k", False)], [("k", True)], [("k", False), ("s", True)], [("d", False), ("k", True)], [("d", True)], [("s", False), ("t", True), ("n", False)],
    [("t", True)], [("day", False)], [("n", True), ("day", True)], [("z", False), ("d", True)], [("k", True), ("k", False), ("s", False)],
]


@pytest.mark.parametrize("keys", KEYS, ids=str)
@pytest.mark.parametrize("n", [1, 250, 1499, 2800, 2999, 3000, 5000])
def test_top_rows(table, keys, n):
    rows, df = table
    got = top_rows(df, keys, n, scanned=True, few=40)
    names = df.columns
    kept = sorted([[rank(r[names.index(k)]) for k, _ in keys] for r in got.collect()])
    assert kept == sorted(expected(rows, names, keys, n))
    # The rows kept are rows of the table, none more often than it has them.
    assert got.exceptAll(df).count() == 0


@pytest.mark.parametrize("n", [1, 7, 500, 501, 1700, 2999, 3000, 9000])
def test_first_rows(table, n):
    rows, df = table
    for relation, scanned in ((df, True), (df.where("k IS NOT NULL").select("k", "s"), True), (df.groupBy("k", "s", "d").agg(F.count("*")), False)):
        size = relation.count()
        got = first_rows(relation, n, scanned, few=40)
        assert got.count() == min(n, size) and got.columns == relation.columns
        assert got.exceptAll(relation).count() == 0


def test_a_cut_opens_only_the_files_it_needs(table, capsys):
    _, df = table
    cut = by_place(df, 100, few=40)
    assert len(set(r[0] for r in cut.select("_metadata.file_name").distinct().collect())) == 1
    cut.explain("formatted")
    plan = capsys.readouterr().out
    assert "SinglePartition" not in plan and "file_path" in plan


def plan_of(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_extracts_use_every_task(spark, capsys):
    sf = "/root/testdata/sf0.01"
    cut = extract(spark, sf, "lineitem", predicate="l_quantity > 5", rows=30_000)
    assert cut.count() == 30_000 and "SinglePartition" not in plan_of(cut, capsys)
    top = extract(spark, sf, "lineitem", columns="l_orderkey", rows=30_000, keys=["l_shipdate", "l_orderkey"])
    plan = plan_of(top, capsys)
    assert "SinglePartition" not in plan and "PushedFilters" in plan and "l_shipdate" in plan
    want = spark.read.parquet(f"{sf}/lineitem.parquet").orderBy("l_shipdate", "l_orderkey").select("l_orderkey").limit(30_000)
    assert [r[0] for r in top.collect()] == [r[0] for r in want.collect()]


def test_a_predicate_that_no_row_meets(spark):
    sf = "/root/testdata/sf0.01"
    assert extract(spark, sf, "lineitem", predicate="l_quantity < 0", rows=30_000).count() == 0
    assert extract(spark, sf, "lineitem", predicate="l_quantity < 0", rows=30_000, keys=["l_shipdate"]).count() == 0
