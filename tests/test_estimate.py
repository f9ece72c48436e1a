"""Row estimates from a bounded number of files."""

import pytest

from tablex.operators.estimate import estimated_rows


def test_few_files_are_exact(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    row = estimated_rows(orders).first()
    assert (row.rows, row.standard_error, row.files, row.files_read) == (orders.count(), 0.0, 1, 1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_skewed_files(spark, tmp_path, seed):
    """Two hundred files of 1 to 20,000 rows, of narrow and wide rows."""
    folder = str(tmp_path / "a part+of 100%")
    spark.sql(
        f"SELECT id, CASE WHEN file % 5 = 0 THEN repeat(md5(CAST(id AS STRING)), 2) END AS note, file FROM"
        f" (SELECT explode(sequence(1, CAST(pow(1.06, file % 170) AS INT))) AS id, file FROM (SELECT pmod(xxhash64(id, {seed}), 170) AS file FROM range(200)))"
    ).write.partitionBy("file").parquet(folder)
    table = spark.read.parquet(folder)
    row = estimated_rows(table.drop("file"), 4).first()
    assert row.files_read < row.files == len(table.inputFiles())
    assert 0 < row.standard_error and abs(row.rows - table.count()) <= 3 * row.standard_error


def test_no_file_and_no_row(spark, tmp_path):
    assert estimated_rows(spark.range(5)).first().files == 0
    spark.range(0).write.parquet(str(tmp_path / "none"))
    row = estimated_rows(spark.read.parquet(str(tmp_path / "none"))).first()
    assert (row.rows, row.standard_error) == (0, 0.0)
