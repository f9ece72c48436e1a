"""Parquet and CSV sinks: complete or absent, with the number of rows written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, Observation, functions as F

from tablex.functions.celltext import csv_text
from tablex.functions.names import quoted, unique_columns
from tablex.session import configure, move_path, path_exists, remove_path
from tablex.sinks.progress import Progress, watched

def optional_fields(df: DataFrame) -> DataFrame:
    """Every column as an optional field, also one that can never be NULL, such as a count.

    The guard is always true; Spark does not fold it away because a partition's number is only
    known in the task.
    """
    names = [quoted(name) for name in df.columns]
    return df.selectExpr(*[f"CASE WHEN spark_partition_id() >= 0 THEN {n} END AS {n}" for n in names])


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The relation, and a row count taken while it is written instead of in a second pass."""
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def commit(writer: DataFrameWriter, df: DataFrame, path: str, mode: str) -> None:
    """Write beside the path, then move into place: until then an earlier export stays as it was.

    A write that fails, whether before it starts or in the middle, removes only what it wrote itself.
    """
    spark = df.sparkSession
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError(f"mode {mode!r}: overwrite or errorifexists")
    if mode != "overwrite" and path_exists(spark, path):
        raise FileExistsError(path)
    place, mark = path.rstrip("/"), uuid.uuid4().hex
    folder, _, name = place.rpartition("/")
    beside = f"{folder}/" if folder or place.startswith("/") else ""
    new, old = f"{beside}.{name}.{mark}.new", f"{beside}.{name}.{mark}.old"
    try:
        writer.mode("errorifexists").save(new)
        replaced = path_exists(spark, place)
        if replaced:
            move_path(spark, place, old)
        try:
            move_path(spark, new, place)
        except Exception:
            if replaced:
                move_path(spark, old, place)
            raise
    except Exception:
        remove_path(spark, new)
        raise
    if replaced:
        remove_path(spark, old)


def committed(writer: DataFrameWriter, df: DataFrame, path: str, mode: str, rows: Observation, progress: Progress | None) -> int:
    """`commit`, with progress if asked for; returns the rows written."""
    with watched(df.sparkSession, progress) as finished:
        commit(writer, df, path, mode)
        finished(rows.get["rows"])
    return rows.get["rows"]


def write_parquet(
    df: DataFrame, path: str, mode: str = "errorifexists", row_group_rows: int = 0, progress: Progress | None = None
) -> int:
    """ZSTD Parquet, microsecond timestamps, decimals as integers; returns the rows written.

    row_group_rows  cap of a row group in rows; 0 leaves row groups sized in bytes, which is
                    what scans of large tables want
    progress        called while the write runs, see `watched`
    """
    configure(df.sparkSession)
    df, rows = counted(optional_fields(unique_columns(df)))
    writer = df.write.format("parquet").option("compression", "zstd")
    if row_group_rows:
        writer = writer.option("parquet.block.row.count.limit", row_group_rows)
    return committed(writer, df, path, mode, rows, progress)


def write_parquet_folder(df: DataFrame, path: str, by: list[str]) -> None:
    """ZSTD Parquet in a folder for each value of the columns `by`, moved into place when complete."""
    commit(df.write.format("parquet").option("compression", "zstd").partitionBy(*by), df, path, "errorifexists")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", fraction: bool = False, progress: Progress | None = None) -> int:
    """CSV with a header in every part; returns the rows written."""
    configure(df.sparkSession)
    df, rows = counted(csv_text(df, fraction))
    writer = df.write.format("csv").options(
        header=True,
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return committed(writer, df, path, mode, rows, progress)


def sink_format(path: str, fmt: str = "") -> str:
    """The named format, else CSV for a `.csv` path in any case; whatever is not CSV is Parquet."""
    named = fmt.lower() or ("csv" if path.lower().endswith(".csv") else "parquet")
    return "csv" if named == "csv" else "parquet"


def write(df: DataFrame, path: str, fmt: str = "", mode: str = "errorifexists", progress: Progress | None = None) -> int:
    """Write to the sink the format or the path names; returns the rows written."""
    sink = write_csv if sink_format(path, fmt) == "csv" else write_parquet
    return sink(df, path, mode, progress=progress)
