import json

from tablex import (
    catalog_dictionary,
    dictionary,
    extract_count,
    info_json,
    normalize,
    preview,
    profile,
    sample,
    scan,
    search_columns,
)


def test_count_and_sample(spark):
    df = spark.sql("SELECT id, CASE WHEN id > 0 THEN id * 0.5D END AS x FROM range(9)")
    assert extract_count(df).first().rows == 9
    rows = [tuple(r) for r in sample(df).collect()]
    assert rows[:2] == [("0", "NULL"), ("1", "0.5")] and len(rows) == 5


def test_sample_of_repeated_names(spark):
    df = spark.sql("SELECT 1 AS id, array(1, NULL) AS id")
    assert sample(df).first().asDict() == {"id": "1", "id_1": "[1,null]"}


def test_preview(spark):
    rows, total = preview(spark.range(60), 0)
    assert rows.count() == 50 and total.first().rows == 60
    assert preview(spark.range(60), 7)[0].count() == 7


def test_profile(spark, small):
    from pathlib import Path

    tables = {"orders": scan(spark, small, "orders"), "made": spark.range(4), "none": scan(spark, small, "orders").where("false")}
    rows = {r.table: r for r in profile(tables, "shop", {"orders": "All orders"}).collect()}
    assert rows["orders"].row_count == scan(spark, small, "orders").count()
    assert rows["orders"].bytes == Path(f"{small}/orders.parquet").stat().st_size
    assert rows["orders"].comment == "All orders"
    assert (rows["made"].row_count, rows["made"].bytes, rows["made"].comment) == (4, None, None)
    assert rows["none"].row_count == 0


def test_bytes_count_files_without_rows(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(10).repartition(2).write.parquet(folder)
    spark.range(0).write.mode("append").parquet(folder)
    row = profile({"t": spark.read.parquet(folder)}).first()
    assert (row.row_count, row.bytes) == (10, sum(f.stat().st_size for f in (tmp_path / "t").glob("part-*")))


def test_profile_reads_no_column(spark, small):
    plan = profile({"t": scan(spark, small, "lineitem")})._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_dictionary_and_search(spark):
    df = normalize(spark.sql("SELECT '1' AS id, '2.50' AS Price, 'x' AS note"), {"id": "integer", "Price": "numeric(10,2)"})
    notes = spark.createDataFrame([("t", "note", "Free Text of a price")], "table string, name string, description string")
    columns = dictionary(spark, {"t": df}, notes)
    assert [tuple(r) for r in columns.collect()] == [
        ("t", 1, "id", "integer", True, ""),
        ("t", 2, "Price", "numeric(10,2)", True, ""),
        ("t", 3, "note", "text", False, "Free Text of a price"),
    ]
    assert [r.name for r in search_columns(columns, "PRICE").collect()] == ["Price", "note"]
    assert search_columns(columns, "").count() == 3
    assert search_columns(columns, "%").count() == 0


def test_catalog_dictionary(spark):
    attributes = spark.createDataFrame(
        [(1, 1, "a", "integer", True, False), (1, 2, "gone", "text", False, True), (1, -1, "ctid", "tid", True, False),
         (1, 3, "b", "text", False, False), (2, 1, "a", "date", False, False), (9, 1, "orphan", "date", False, False)],
        "attrelid int, attnum int, attname string, atttype string, attnotnull boolean, attisdropped boolean",
    )
    classes = spark.createDataFrame([(1, "t", 10), (2, "u", 10), (3, "v", 11)], "oid int, relname string, relnamespace int")
    namespaces = spark.createDataFrame([(10, "s"), (11, "z")], "oid int, nspname string")
    descriptions = spark.createDataFrame([(1, 3, "bee"), (1, 0, "the table")], "objoid int, objsubid int, description string")
    rows = catalog_dictionary(attributes, classes, namespaces, descriptions, "s", "t").orderBy("ordinal").collect()
    assert [tuple(r) for r in rows] == [
        ("s", "t", 1, "a", "integer", False, ""), ("s", "t", 3, "b", "text", True, "bee"),
    ]
    assert catalog_dictionary(attributes, classes, namespaces, descriptions).count() == 3


def test_info_json(spark, small):
    tables = {"labels": scan(spark, small, "labels")}
    notes = spark.createDataFrame([("labels", "toxic", "0 or 1")], "table string, name string, description string")
    row = info_json(profile(tables, "shop"), dictionary(spark, tables, notes)).first()
    info = json.loads(row.info)
    assert list(info) == ["schema", "table", "row_count", "size", "columns"]
    assert info["columns"] == [
        {"name": "doc_id", "type": "bigint", "nullable": True},
        {"name": "quality", "type": "integer", "nullable": True},
        {"name": "toxic", "type": "integer", "nullable": True, "description": "0 or 1"},
    ]
