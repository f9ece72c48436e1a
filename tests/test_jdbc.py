from tablex.sources.jdbc import jdbc_options, remote_select

TYPES = {"item": "integer", "price": "numeric(10,6)", "Odd \"N\"": "text", "slice_key": "date"}


def test_projection_predicate_and_text_transfer_run_remotely():
    sql = remote_select("s", 'we"ird', TYPES, ["item", "price"], "date >= '2020-01-01'")
    assert sql == (
        'SELECT "item", "price"::text AS "price" FROM "s"."we""ird" WHERE date >= \'2020-01-01\''
    )


def test_the_slicing_column_stays_native():
    sql = remote_select("s", "t", TYPES, partition_column="price")
    assert sql == (
        'SELECT "item", "price"::text AS "price", "Odd ""N"""::text AS "Odd ""N""", '
        '"slice_key"::text AS "slice_key", "price" AS "slice_key_" FROM "s"."t"'
    )


def test_options():
    assert jdbc_options("jdbc:x", "SELECT 1") == {
        "url": "jdbc:x", "dbtable": "(SELECT 1) source_rows", "fetchsize": "10000",
    }
    sliced = jdbc_options("jdbc:x", "SELECT 1", "k", 1, 100, 8, 500)
    assert sliced["partitionColumn"] == "k" and sliced["numPartitions"] == "8"
    assert (sliced["lowerBound"], sliced["upperBound"], sliced["fetchsize"]) == ("1", "100", "500")
