from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tablex import normalize, read_export, write, write_csv, write_parquet
from tablex.sinks.files import sink_format


def parts(path, kind="parquet"):
    return sorted(Path(path).glob(f"part-*.{kind}"))


@pytest.mark.parametrize(
    "path, fmt, want",
    [
        ("out.parquet", "", "parquet"),
        ("out.csv", "", "csv"),
        ("OUT.CSV", "", "csv"),
        ("out", "", "parquet"),
        ("out.csv", "parquet", "parquet"),
        ("out.parquet", "CSV", "csv"),
        ("out.csv", "orc", "parquet"),
    ],
)
def test_sink_format(path, fmt, want):
    assert sink_format(path, fmt) == want


def test_parquet_layout(spark, tmp_path):
    df = spark.sql(
        "SELECT 1 AS i, 2L AS l, 12.34BD AS n9, CAST(1.5 AS DECIMAL(16,6)) AS n16, timestamp'2020-01-01' AS tz, "
        "timestamp_ntz'2020-01-01' AS ts, CAST('09:00:00' AS TIME(6)) AS tm, date'2020-01-01' AS d, 'x' AS s"
    )
    out = str(tmp_path / "out.parquet")
    assert write_parquet(normalize(df, None, decimal=True), out) == 1
    file = pq.ParquetFile(parts(out)[0])
    schema = file.schema
    columns = {schema.column(i).name: schema.column(i) for i in range(len(schema))}
    assert columns["n9"].physical_type == "INT32"
    assert columns["n16"].physical_type == "INT64"
    assert "isAdjustedToUTC=true, timeUnit=microseconds" in str(columns["tz"].logical_type)
    assert "isAdjustedToUTC=false, timeUnit=microseconds" in str(columns["ts"].logical_type)
    assert "Time(isAdjustedToUTC=false, timeUnit=microseconds" in str(columns["tm"].logical_type)
    assert all(c.max_definition_level == 1 for c in columns.values()), "every field is optional"
    assert file.metadata.row_group(0).column(0).compression == "ZSTD"


def test_counts_are_optional_fields(spark, tmp_path):
    out = str(tmp_path / "x")
    write_parquet(spark.range(5).selectExpr("count(*) AS n", "sum(id) AS total"), out)
    schema = pq.ParquetFile(parts(out)[0]).schema
    assert [schema.column(i).max_definition_level for i in range(2)] == [1, 1]
    assert tuple(read_export(spark, out).first()) == (5, 10)


def test_empty_export_keeps_its_schema(spark, tmp_path, small):
    df = spark.read.parquet(f"{small}/orders.parquet").where("false")
    assert write(df, str(tmp_path / "e")) == 0
    back = read_export(spark, str(tmp_path / "e"))
    assert back.dtypes == df.dtypes and back.count() == 0


def test_row_groups_can_be_capped(spark, tmp_path):
    out = str(tmp_path / "rg")
    assert write_parquet(spark.range(25_000).coalesce(1), out, row_group_rows=10_000) == 25_000
    meta = pq.ParquetFile(parts(out)[0]).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [10_000, 10_000, 5_000]


def test_failed_export_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "bad.parquet")
    bad = spark.range(1000).selectExpr("CASE WHEN id = 999 THEN 'x' ELSE '1' END AS n")
    with pytest.raises(Exception):
        write(normalize(bad, {"n": "integer"}), out)
    assert not Path(out).exists()
    with pytest.raises(FileNotFoundError):
        read_export(spark, out)


def test_existing_export_is_kept_unless_overwritten(spark, tmp_path):
    out = str(tmp_path / "x")
    write(spark.range(3), out)
    with pytest.raises(FileExistsError):
        write(spark.range(5), out, mode="errorifexists")
    assert read_export(spark, out).count() == 3
    assert write(spark.range(5), out, mode="overwrite") == 5
    assert read_export(spark, out).count() == 5


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_failures_leave_the_earlier_export(spark, tmp_path, fmt):
    out = str(tmp_path / "x")
    write(spark.range(3), out, fmt)
    if fmt == "parquet":  # refused before it starts
        with pytest.raises(Exception):
            write(spark.sql("SELECT make_interval(1) AS a"), out, fmt, mode="overwrite")
    bad = spark.range(1000).selectExpr("CASE WHEN id = 999 THEN 'x' ELSE '1' END AS n")  # fails in the middle
    with pytest.raises(Exception):
        write(normalize(bad, {"n": "integer"}), out, fmt, mode="overwrite")
    assert read_export(spark, out, fmt).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["x"]
    assert write(spark.range(4), out, fmt, mode="overwrite") == 4
    assert read_export(spark, out, fmt).count() == 4 and [p.name for p in tmp_path.iterdir()] == ["x"]


def test_unfinished_export_is_refused(spark, tmp_path):
    out = tmp_path / "x"
    write(spark.range(3), str(out))
    (out / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError):
        read_export(spark, str(out))


def test_csv_text_survives(spark, tmp_path):
    values = ["plain", "a,b", 'say "hi"', "line\nbreak", " lead", "trail ", "", None, "é漢🎉", "\\", "cr\r\nlf", '"']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    out = str(tmp_path / "x.csv")
    assert write(df, out) == len(values)
    back = read_export(spark, out)
    assert back.columns == ["i", "s"]
    got = [r.s for r in sorted(back.collect(), key=lambda r: int(r.i))]
    assert [g or "" for g in got] == [v or "" for v in values]
    raw = "".join(p.read_text() for p in parts(out, "csv"))
    assert raw.count("i,s") == len(parts(out, "csv"))


def test_csv_missing_cells_are_empty(spark, tmp_path):
    out = str(tmp_path / "x.csv")
    write_csv(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, '' AS c, 2.50BD AS d"), out)
    assert parts(out, "csv")[0].read_text() == "a,b,c,d\n1,,,2.5\n"


def test_repeated_names_are_told_apart(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, 2 AS id, 3 AS ID")
    write(df, str(tmp_path / "p"))
    assert read_export(spark, str(tmp_path / "p")).columns == ["id", "id_1", "ID"]
