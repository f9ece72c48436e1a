"""How many rows a table of files holds, from a few of its files, with a standard error."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, Window, functions as F

# Files opened of each size class; a class spans a factor of two, so at most 64 classes are met.
FILES = 8


def one_form(path: str) -> str:
    """SQL of a path with one slash after its scheme."""
    return f"regexp_replace({path}, '^([A-Za-z0-9]+):/+', '$1:/')"


def estimated_rows(df: DataFrame, files: int = FILES) -> DataFrame:
    """One row: rows (rounded), standard_error, files, files_read, of a table read from Parquet files.

    Files are classed by size. Of each class `files` are taken by the hash of their path, and their footers give rows
    per byte, times the bytes of the class. A class of that many files or fewer is exact and adds no error; with
    `files=1` the spread within a class is unknown, so it takes two at least. A table without files has no rows.
    """
    spark, files = df.sparkSession, max(files, 2)
    paths = [unquote(path) for path in df.inputFiles()]
    if not paths:
        return spark.sql("SELECT 0L AS rows, 0D AS standard_error, 0L AS files, 0L AS files_read")
    sized = spark.read.format("binaryFile").load(paths).select("path", "length", F.floor(F.log2(F.greatest("length", F.lit(1)))).alias("size_class"))
    order = Window.partitionBy("size_class").orderBy(F.xxhash64("path"), "path")
    chosen = sized.withColumn("place", F.row_number().over(order)).where(F.col("place") <= files).select("path", "length", "size_class")
    # At most `files` of 64 classes: a bounded list.
    taken = chosen.collect()
    listed = spark.createDataFrame([tuple(row) for row in taken], chosen.schema).withColumn("path", F.expr(one_form("path")))
    decoded = "url_decode(replace(_metadata.file_path, '+', '%2B'))"
    counts = spark.read.schema(df.schema).parquet(*[row.path for row in taken]).groupBy(F.expr(one_form(decoded)).alias("path")).agg(F.count(F.lit(1)).alias("n"))
    read = listed.join(counts, "path", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ratios = read.groupBy("size_class").agg(
        F.count(F.lit(1)).alias("read"), F.sum("n").alias("rows_read"), (F.sum("n") / F.sum("length")).alias("ratio"),
        F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("n") * F.col("length").cast("double")).alias("nb"), F.sum(F.col("length").cast("double") * F.col("length")).alias("bb"),
    )
    totals = sized.groupBy("size_class").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    each = totals.join(ratios, "size_class").selectExpr(
        "files", "read",
        "CASE WHEN files = read THEN CAST(rows_read AS DOUBLE) ELSE ratio * bytes END AS estimate",
        "CASE WHEN files = read THEN 0D ELSE greatest(nn - 2 * ratio * nb + ratio * ratio * bb, 0D) / (read - 1)"
        " * files * (files - read) / read END AS variance",
    )
    return each.selectExpr(
        "CAST(round(sum(estimate)) AS BIGINT) AS rows", "sqrt(sum(variance)) AS standard_error", "sum(files) AS files", "sum(read) AS files_read"
    )
