"""Reports while a write runs."""

import pytest
from pyspark.sql import functions as F

from tablex import write


@pytest.mark.parametrize("name", ["t.parquet", "t.csv"])
def test_reports_rise_and_end_with_the_rows(spark, tmp_path, name):
    slow = F.expr("reduce(sequence(1, 60000), id, (a, x) -> xxhash64(a, x))")
    calls = []
    rows = write(spark.range(0, 640, 1, 32).select("id", slow.alias("h")), str(tmp_path / name), progress=lambda *call: calls.append(call))
    assert rows == 640 and calls[-1] == (32, 32, 640)
    done = [c[0] for c in calls]
    assert done == sorted(done) and all(c[0] <= c[1] for c in calls) and all(c[2] is None for c in calls[:-1])
    assert len(calls) > 1


def test_failing_write_reports_no_rows_and_keeps_the_group(spark, tmp_path):
    context, calls = spark.sparkContext, []
    context.setJobGroup("mine", "my jobs")
    with pytest.raises(Exception):
        write(spark.range(10).selectExpr("raise_error('no') AS x"), str(tmp_path / "t"), progress=lambda *call: calls.append(call))
    assert all(c[2] is None for c in calls) and context.getLocalProperty("spark.jobGroup.id") == "mine"
    context.setLocalProperty("spark.jobGroup.id", None)


def test_no_callback(spark, tmp_path):
    assert write(spark.range(3), str(tmp_path / "t")) == 3
