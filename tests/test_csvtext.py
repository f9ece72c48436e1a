"""CSV with line ends in its cells, read in many splits, against Spark's reader of whole files."""

import random

import pytest

from tablex import read_export, write_csv
from tablex.sources.csvtext import numbered_lines, read_csv, whole_files


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def same(spark, path):
    want, got = whole_files(spark, path, multiline=True), read_csv(spark, path)
    assert got.columns == want.columns
    return sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


PIECES = ["a", "bc", " ", "\n", "\n\n", '"', '""', ",", "é", "\\", '\\"', "'", "\t", "long " * 40, "😀", ";\n"]


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_reader_of_whole_files(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    cell = lambda: None if rng.random() < 0.1 else "".join(rng.choices(PIECES, k=rng.randrange(12)))
    rows = [(i, cell(), cell(), "end") for i in range(150)]
    path = str(tmp_path / "t.csv")
    write_csv(spark.createDataFrame(rows, "i int, a string, `b, \"c` string, z string").repartition(3), path)
    assert numbered_lines(spark, path).select("file", "start").distinct().count() > 20
    assert same(spark, path)
    assert read_export(spark, path).count() == 150


def test_a_cell_over_many_splits(spark, tmp_path, small_splits):
    path = str(tmp_path / "t.csv")
    rows = [(1, "x"), (2, 'line with "quotes"\n' * 300), (3, "y"), (4, "\n" * 2000), (5, None)]
    write_csv(spark.createDataFrame(rows, "i int, s string").coalesce(1), path)
    assert same(spark, path)
    assert {r.i: r.s for r in read_csv(spark, path).collect()} == {str(i): s for i, s in rows}


def test_plain_files_and_odd_headers(spark, tmp_path, small_splits):
    plain, odd, none = (str(tmp_path / n) for n in ("plain.csv", "odd.csv", "none.csv"))
    write_csv(spark.range(300).selectExpr("id", "'a,b' AS s"), plain)
    assert same(spark, plain)
    write_csv(spark.createDataFrame([(1, "a\nb")], "`x\ny` int, s string"), odd)
    assert same(spark, odd)
    write_csv(spark.createDataFrame([], "x int, s string"), none)
    assert read_export(spark, none).count() == 0


def test_a_row_that_looks_like_the_header(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write_csv(spark.createDataFrame([("a", "b"), ("two\nlines", "b")], "a string, b string").coalesce(1), path)
    assert sorted(map(tuple, read_csv(spark, path).collect())) == [("a", "b"), ("two\nlines", "b")]


def test_what_is_broadcast_does_not_grow_with_the_records(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write_csv(spark.range(1_000_000).selectExpr("id", "concat('a', chr(10), 'b \"', id, '\"', chr(10), 'c') AS s").coalesce(2), path)
    spark.conf.set("spark.sql.maxBroadcastTableSize", "66MB")
    try:
        got = read_csv(spark, path)
        assert got.selectExpr("sum(CAST(id AS BIGINT)) AS s").first().s == 1_000_000 * 999_999 // 2
        assert got.where("s = concat('a', chr(10), 'b \"', id, '\"', chr(10), 'c')").count() == 1_000_000
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
