from decimal import Decimal

import pytest

from tablex import dry_run, export, read_export


def test_export_in_one_call(spark, small, tmp_path):
    options = {"schema": small, "table": "orders", "columns": "o_orderkey,o_totalprice", "predicate": "o_orderkey < 50"}
    types = {"o_totalprice": "numeric(12,2)", "o_orderstatus": "text"}
    path = str(tmp_path / "o.parquet")
    assert export(spark, path, types, decimal=True, **options) == 50
    row = read_export(spark, path).orderBy("o_orderkey").first()
    assert row.o_orderkey == 0 and isinstance(row.o_totalprice, Decimal)
    assert export(spark, str(tmp_path / "o.csv"), types, **options) == 50


def test_export_of_a_sql_text_with_repeated_names(spark, tmp_path):
    path = str(tmp_path / "q")
    sql = "SELECT a.id, b.id, '7' AS n FROM range(3) a JOIN range(3) b USING (id)"
    assert export(spark, path, {"n": "integer"}, sql=sql, table="ignored") == 3
    assert read_export(spark, path).dtypes == [("id", "bigint"), ("id_1", "bigint"), ("n", "int")]


def test_dry_run(spark, small):
    count, rows = dry_run(spark, schema=small, table="orders", predicate="o_orderkey < 50")
    assert count.first().rows == 50 and rows.count() == 5


def test_types_of_unknown_columns_are_refused(spark, small, tmp_path):
    with pytest.raises(ValueError, match="o_totalprise"):
        export(spark, str(tmp_path / "o"), {"o_totalprise": "numeric"}, schema=small, table="orders", columns="o_orderkey")


def test_csv_keeps_every_digit_of_a_numeric(spark, tmp_path):
    sql = "SELECT '12345678901234567.890' AS a, 0.0000100BD AS b, 'NaN' AS c, 5e-6D AS d, 2e22D AS e, '1.5e3' AS f"
    path = str(tmp_path / "n.csv")
    export(spark, path, dict.fromkeys("abcdef", "numeric"), sql=sql)
    assert tuple(read_export(spark, path).first()) == ("12345678901234567.89", "0.00001", "NaN", "0.000005", "2" + "0" * 22, "1500")
