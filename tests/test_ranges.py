"""Exports that keep fingerprints of key ranges: what a later check reads falls with what changed."""

import pytest
from pyspark.sql import functions as F

from tablex import diff_cells, diff_exports, write_ranges
from tablex.sinks.ranges import RANGE, changed_ranges, read_ranges


def rows(spark, n=4000):
    return spark.range(n).selectExpr("IF(id % 400 = 9, NULL, id) AS k", "concat('row ', id % 17) AS s", "id / 7 AS d")


@pytest.fixture
def exports(spark, tmp_path):
    source = rows(spark)
    changed = source.withColumn("s", F.when(F.col("k").between(1000, 1010), "other").otherwise(F.col("s"))).where("k IS NULL OR k <> 3000")
    paths = [str(tmp_path / name) for name in ("a", "b", "c")]
    assert write_ranges(source, paths[0], "k", bits=5) == 4000
    assert write_ranges(changed, paths[1], "k", like=paths[0]) == 3999
    assert write_ranges(source.orderBy(F.desc("d")), paths[2], "k", like=paths[0]) == 4000
    return source, changed, paths


def test_only_changed_ranges_are_read(spark, exports):
    source, changed, (a, b, c) = exports
    ranges = changed_ranges(spark, a, b)
    assert 1 <= len(ranges) <= 3 and changed_ranges(spark, a, c) == []
    pruned = read_ranges(spark, a).where(F.col(RANGE).isin(ranges))
    opened = {r[0] for r in pruned.select("_metadata.file_path").distinct().collect()}
    assert len(opened) <= len(read_ranges(spark, a).inputFiles()) / 8
    text = lambda df: sorted(map(str, df.collect()))
    assert text(diff_exports(spark, a, b, ["k"])) == text(diff_cells(source, changed, ["k"])) != []
    assert diff_exports(spark, a, c, ["k"]).count() == 0


def test_ranges_hold_their_keys(spark, exports):
    found = read_ranges(spark, exports[2][0]).where("k IS NOT NULL").groupBy(RANGE).agg(F.min("k").alias("low"), F.max("k").alias("high")).orderBy(RANGE).collect()
    assert len(found) == 32 and all(x.high < y.low for x, y in zip(found, found[1:]))


def test_other_bounds_are_refused(spark, exports, tmp_path):
    other = str(tmp_path / "other")
    write_ranges(rows(spark, 100), other, "k", bits=3)
    with pytest.raises(ValueError):
        changed_ranges(spark, exports[2][0], other)
    with pytest.raises(FileExistsError):
        write_ranges(rows(spark, 5), other, "k")


def test_an_empty_export(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert write_ranges(rows(spark, 50), a, "k", bits=2) == 50
    assert write_ranges(rows(spark, 50).where("false"), b, "k", like=a) == 0
    assert len(changed_ranges(spark, a, b)) >= 3
