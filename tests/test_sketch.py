"""Difference sketches against the exact way."""

import pytest
from pyspark.sql import functions as F

from tablex.operators import sketch
from tablex.operators.reconcile import diff_cells, unmatched_hashes


def exact(a, b):
    return sorted(map(tuple, unmatched_hashes(a, b).select("h1", "h2", "surplus").collect()))


def told(found):
    return None if found is None else sorted(map(tuple, found.select("h1", "h2", "surplus").collect()))


def rows(spark, n, every=10**9, text="x"):
    return spark.range(n).selectExpr(f"CASE WHEN id % {every} = 3 THEN -id ELSE id END AS id", f"concat('{text}', id % 7) AS s", "IF(id % 11 = 0, NULL, id / 3) AS d")


@pytest.mark.parametrize("n, every", [(0, 2), (1, 2), (5000, 10**9), (5000, 500), (5000, 7), (40_000, 400)])
def test_equals_the_exact_way(spark, n, every):
    a, b = rows(spark, n), rows(spark, n, every)
    assert told(sketch.surplus_by_sketch(a, b)) == exact(a, b)


def test_copies_are_counted(spark):
    a = rows(spark, 300).unionAll(rows(spark, 20)).unionAll(rows(spark, 5)).unionAll(rows(spark, 5))
    b = rows(spark, 290)
    want = exact(a, b)
    assert {s for _, _, s in want} >= {1, 3}
    assert told(sketch.surplus_by_sketch(a, b)) == want
    assert told(sketch.surplus_by_sketch(b, a)) == sorted((h1, h2, -s) for h1, h2, s in want)


def test_a_sketch_too_small_says_so(spark):
    a, b = rows(spark, 5000), rows(spark, 5000, 5)
    assert sketch.surplus_by_sketch(a, b, cells=600) is None
    assert sketch.surplus_by_sketch(a, b, most=100) is None


def test_the_estimate(spark):
    a, b = rows(spark, 20_000), rows(spark, 20_000, 20)
    assert 1700 < sketch.estimated(a, b) < 2300 and sketch.estimated(a, a) == 0


def test_what_is_shuffled_follows_the_difference(spark):
    """The sketch of 200,000 rows a side with few differences has few cells."""
    a, b = rows(spark, 200_000), rows(spark, 200_000, 20_000)
    cells = sketch.sketched(a, b, 900)
    assert 0 < cells.count() <= 2 * 10 * sketch.PARTS


def test_cells_found_by_sketch(spark):
    a = rows(spark, 3000)
    b = a.withColumn("s", F.when(F.col("id") % 100 == 5, "other").otherwise(F.col("s"))).where("id % 100 <> 6")
    want = sorted(map(str, diff_cells(a, b, ["id"]).collect()))
    assert sorted(map(str, diff_cells(a, b, ["id"], sketch=True).collect())) == want and len(want) == 60
