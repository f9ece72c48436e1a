"""Z-ordered exports: the same rows, and fewer row groups for predicates on any of the columns."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablex import read_export, write_parquet
from tablex.sinks.layout import clustered, range_bounds, range_number


def overlapping(path, column, low, high):
    """(row groups whose range of a column meets [low, high], all row groups), from the footers."""
    met = every = 0
    for file in Path(path).glob("part-*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            every += 1
            met += stats.min <= high and stats.max >= low
    return met, every


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")


def test_row_groups_are_skipped(spark, lines, tmp_path):
    names = ["l_partkey", "l_suppkey", "l_extendedprice"]
    plain, ordered = str(tmp_path / "plain"), str(tmp_path / "ordered")
    write_parquet(lines, plain, row_group_rows=1000)
    write_parquet(clustered(lines, names, files=4), ordered, row_group_rows=1000)
    back = read_export(spark, ordered)
    assert back.exceptAll(lines).count() == 0 and back.count() == lines.count()
    for name, low, high in (("l_partkey", 600, 700), ("l_suppkey", 30, 35), ("l_extendedprice", 20_000.0, 22_000.0)):
        before, after = overlapping(plain, name, low, high), overlapping(ordered, name, low, high)
        assert before[0] == before[1] >= 60 and after[0] < 0.5 * after[1], name
        where = f"{name} BETWEEN {low} AND {high}"
        assert back.where(where).count() == lines.where(where).count() > 0


def test_range_numbers(spark):
    df = spark.range(1000).selectExpr("id", "IF(id % 10 = 0, NULL, CAST(id AS STRING)) AS s", "CAST(NULL AS DATE) AS none", "1.5D AS same")
    bounds = range_bounds(df, ["id", "s", "none", "same"], bits=3)
    assert [len(bounds[n]) for n in ("id", "s", "none", "same")] == [7, 7, 0, 1]
    numbers = df.select(range_number("id", bounds["id"]).alias("n")).groupBy("n").count().collect()
    assert sorted(r.n for r in numbers) == list(range(8)) and all(115 <= r["count"] <= 135 for r in numbers)
    nulls = df.where("s IS NULL").select(range_number("s", bounds["s"]).alias("n")).distinct().collect()
    assert [r.n for r in nulls] == [7]


def test_a_frequent_value_spreads(spark):
    df = spark.range(20_000).selectExpr("IF(id < 15000, 7, id) AS a", "id AS b")
    parts = clustered(df, ["a", "b"], files=8).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 6000


def test_edges(spark):
    empty = spark.createDataFrame([], "a int, s string")
    assert clustered(empty, ["a", "s"]).count() == 0
    rows = spark.createDataFrame([(None, None), (1, "x"), (None, "y")], "a int, `s.t` string")
    assert clustered(rows, ["a", "s.t"]).count() == 3
    with pytest.raises(ValueError):
        clustered(rows.selectExpr("array(a) AS x"), ["x"])
