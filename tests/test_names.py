import pytest

from tablex import quoted, unique_columns, unique_names


@pytest.mark.parametrize(
    "names, want",
    [
        (["price"], ["price"]),
        (["price", "tax", "price", "tax"], ["price", "tax", "price_1", "tax_1"]),
        (["qty_2", "qty", "qty", "qty"], ["qty_2", "qty", "qty_1", "qty_3"]),
        (["day_1", "day_1", "day", "day"], ["day_1", "day_1_1", "day", "day_2"]),
        (["Tax", "tax", "TAX", "tax"], ["Tax", "tax", "TAX", "tax_1"]),
        (["", ""], ["", "_1"]),
    ],
)
def test_unique_names(names, want):
    assert unique_names(names) == want


def test_many_repeats_stay_distinct():
    names = unique_names(["c"] * 1000 + ["c_5", "c_5"])
    assert len(set(names)) == 1002


@pytest.mark.parametrize(
    "name, want", [("a", "`a`"), ("a.b", "`a.b`"), ("a`b", "`a``b`"), ("With Space", "`With Space`")]
)
def test_quoted(name, want):
    assert quoted(name) == want


def test_unique_columns_renames_by_position(spark):
    df = spark.sql("SELECT 'x' AS cost_1, 'y' AS cost, 'z' AS cost, 'w' AS Cost")
    out = unique_columns(df)
    assert out.columns == ["cost_1", "cost", "cost_2", "Cost"]
    assert tuple(out.first()) == ("x", "y", "z", "w")
