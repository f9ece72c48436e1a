"""Row numbers and comparison by place, against lists."""

import random

import pytest

from tablex.operators.position import diff_rows, numbered


def table(spark, rows, parts=5):
    indexed = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(indexed, "i int, a int, s string, `row` double")
    return df.repartitionByRange(parts, "i").sortWithinPartitions("i").drop("i")


def made(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, 1, 2]), rng.choice([None, "", "x", "é"]), rng.choice([None, 0.0, 1.5])) for _ in range(n)]


def brute_force(want, got):
    out, text = [], lambda v: None if v is None else str(v)
    for i in range(max(len(want), len(got))):
        if i >= len(got):
            out.append((i, "missing", None))
        elif i >= len(want):
            out.append((i, "extra", None))
        else:
            out += [(i, "changed", c, text(x), text(y)) for c, x, y in zip(("a", "s", "row"), want[i], got[i]) if text(x) != text(y)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.row, r.status, r.column, r.want, r.got) if r.column else (r.row, r.status, None) for r in df.collect()), key=str)


@pytest.mark.parametrize("case", ["put in", "cut", "changed", "same", "empty", "both empty"])
def test_equals_lists(spark, case):
    want = [] if case == "both empty" else made(1, 400)
    got = list(want)
    if case == "put in":
        got.insert(150, (7, "new", 2.0))
    elif case == "cut":
        del got[399], got[30]
    elif case == "changed":
        got = [(a, "y" if i % 50 == 0 else s, d) for i, (a, s, d) in enumerate(got)]
    elif case == "empty":
        got = []
    assert found(diff_rows(table(spark, want), table(spark, got, 3))) == brute_force(want, got)


@pytest.mark.parametrize("block", [7, 100_000])
def test_numbers(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr("tablex.operators.position.BLOCK", block)
    path = str(tmp_path / "t")
    spark.range(1000).repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(path)
    df = spark.read.parquet(path)
    assert all(r.row == r.id for r in numbered(df, scanned=True).collect())
    odd = numbered(df.where("id % 2 = 1 OR id > 700"), scanned=True).orderBy("row").collect()
    ids = [i for i in range(1000) if i % 2 == 1 or i > 700]
    assert [(r.row, r.id) for r in odd] == list(enumerate(ids))
    assert [(r.row, r.id) for r in numbered(df.orderBy(df.id.desc())).orderBy("row").collect()] == [(i, 999 - i) for i in range(1000)]


def test_tolerance(spark):
    a = spark.sql("SELECT timestamp_ntz'2020-01-01 10:00:00' AS t UNION ALL SELECT timestamp_ntz'2020-01-01 11:00:00'")
    b = spark.sql("SELECT timestamp_ntz'2020-01-01 10:00:00.000001' AS t UNION ALL SELECT timestamp_ntz'2020-01-01 11:00:01'")
    rows = diff_rows(a.coalesce(1), b.coalesce(1), tolerance_us=10).collect()
    assert [(r.row, r.column) for r in rows] == [(1, "t")]
