"""The trigram index finds what a scan finds."""

import random

import pytest

from tablex import search_columns
from tablex.operators.search import rarest, search_index, write_search_index


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(3)
    words = ["price", "Order", "ab", "", "line", "ÄRGER", "x", "linear", "pri", "a%b_c"]
    rows = [(f"t{i}", i, rng.choice(words) + rng.choice(words), " ".join(rng.choices(words, k=rng.randint(0, 5))) if i % 7 else None) for i in range(400)]
    columns = spark.createDataFrame(rows, "table string, ordinal int, name string, description string")
    path = str(tmp_path_factory.mktemp("index") / "i")
    write_search_index(columns, path)
    return columns, path


@pytest.mark.parametrize("text", ["", "e", "ne", "PRICE", "line", "linear p", "ärger", "nowhere", "a%b", "xab", "order\nab", "price price"])
def test_equals_a_scan(spark, indexed, text):
    columns, path = indexed
    found = search_index(spark, path, text)
    assert found.columns == columns.columns
    assert sorted(found.collect(), key=str) == sorted(search_columns(columns, text).collect(), key=str)


def test_rarest_grams_come_first(spark, indexed):
    _, path = indexed
    grams = rarest(spark, path, "linear")
    assert len(grams) == 4 and [n for _, n in grams] == sorted(n for _, n in grams)
    assert grams[0][1] < dict(rarest(spark, path, "line"))["lin"] < spark.read.parquet(f"{path}/rows").count()
    assert rarest(spark, path, "nowhere") == [] and rarest(spark, path, "ab") is None


def test_index_must_be_new_and_whole(spark, indexed, tmp_path):
    columns, path = indexed
    with pytest.raises(FileExistsError):
        write_search_index(columns, path)
    with pytest.raises(FileNotFoundError):
        search_index(spark, str(tmp_path), "abc")
    write_search_index(columns.where("false"), str(tmp_path / "none"))
    assert search_index(spark, str(tmp_path / "none"), "abc").count() == 0


def test_a_posting_holds_the_rows_of_a_block(spark, tmp_path):
    path = str(tmp_path / "blocks")
    columns = spark.range(640).coalesce(1).selectExpr("'t' AS table", "CAST(id AS INT) AS ordinal", "'col_' || id AS name", "'Ships to Line' AS description")
    write_search_index(columns, path)
    assert spark.read.parquet(f"{path}/postings").where("gram = 'ine'").count() == 10
    assert dict(rarest(spark, path, "line"))["ine"] == 640
    assert search_index(spark, path, "to line").count() == 640
    assert sorted(r.ordinal for r in search_index(spark, path, "ol_63").collect()) == [63, *range(630, 640)]
