"""CSV whose cells hold line ends, read by as many tasks as its files have splits.

Spark reads such a file in one task, for only from its start is it known whether a line end stands in quotes. Here files are
read as lines, in splits. A line with an odd number of quotes opens or closes a quoted cell that goes on over a line
end; how many such lines stand before a split, a sum over a few numbers per split, tells how it begins. Lines of a split
without any are parsed where they are read. Those of the others are shuffled once, each to the split in which its
record opens, where they are put together in order; all that is broadcast is a few numbers per split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablex.session import stored

#: What `write_csv` writes: quotes are doubled within quotes, and nothing else is an escape.
DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def whole_files(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    """Spark's own reader."""
    return spark.read.options(**DIALECT).csv(path, header=True, multiLine=multiline, enforceSchema=False)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, id, file, start, odd) of every line; ids rise within a split and are the same each time."""
    lines = spark.read.text(path, lineSep="\n")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(
        F.col("value").alias("line"),
        F.monotonically_increasing_id().alias("id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        (quotes % 2 == 1).alias("odd"),
    )


def placed(splits: DataFrame) -> DataFrame:
    """Splits with what their lines need to find their record: one row per split.

    head        whether the split begins its file
    plain       whether no line opens, closes or belongs to a longer record
    closing     id of the last line that belongs to a record opened in an earlier split, -1 if none does
    opener      first id of the split that opened it
    """
    of_file = Window.partitionBy("file").orderBy("start")  # splits of a file
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2 == 1
    opener = F.last(F.when(F.col("odds") > 0, F.col("first")), ignorenulls=True).over(earlier)
    return splits.select(
        "file",
        "start",
        "first",
        (F.row_number().over(of_file) == 1).alias("head"),
        (~within & (F.col("odds") == 0)).alias("plain"),
        F.when(within, F.coalesce("first_odd", "last")).otherwise(-1).alias("closing"),
        opener.alias("opener"),
    )


def whole_records(lines: DataFrame) -> DataFrame:
    """(line) of every record, from the lines (line, id, start, odd, home) of splits that are not plain.

    Of the lines with an odd number of quotes, counted from a record's beginning, the first, third … open a record that the next closes.
    """
    upto = Window.partitionBy("home").orderBy("start", "id").rowsBetween(Window.unboundedPreceding, 0)
    counted = lines.withColumn("count", F.count_if("odd").over(upto))
    longer = F.col("odd") | (F.col("count") % 2 == 1)
    record = F.when(longer, -F.ceil(F.col("count") / 2)).otherwise(F.col("id"))
    pieces = F.array_sort(F.collect_list(F.struct("start", "id", "line")))
    joined = F.concat_ws("\n", F.transform(pieces, lambda x: x["line"]))
    return counted.withColumn("record", record).groupBy("home", "record").agg(joined.alias("line")).select("line")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header in every file, cells as text; a cell may go on over any number of lines and splits."""
    lines = numbered_lines(spark, path)
    ends = [F.min("id").alias("first"), F.max("id").alias("last"), F.min(F.when(F.col("odd"), F.col("id"))).alias("first_odd")]
    splits = stored(lines.groupBy("file", "start").agg(*ends, F.count_if("odd").alias("odds"), F.min_by("odd", "id").alias("broken")), "splits")
    if not splits.where("odds > 0").head(1):
        return whole_files(spark, path, multiline=False)
    heads = splits.groupBy("file").agg(F.min_by("broken", "start").alias("broken"))
    if heads.where("broken").head(1):  # a column's name holds a line end
        return whole_files(spark, path, multiline=True)
    schema = whole_files(spark, path, multiline=False).schema
    places = stored(placed(splits), "places")
    known = lines.join(F.broadcast(places), ["file", "start"]).where("NOT (head AND id = first)")
    home = F.when(F.col("id") <= F.col("closing"), F.col("opener")).otherwise(F.col("first"))
    records = whole_records(known.where("NOT plain").select("line", "id", "start", "odd", home.alias("home")))
    if places.where("plain").head(1):
        records = records.unionAll(known.where("plain").select("line"))
    records = records.where(F.trim("line") != "")
    return records.select(F.from_csv("line", ddl(schema), {**DIALECT, "multiLine": "true"}).alias("row")).select("row.*")


def ddl(schema) -> str:
    """The columns, all text."""
    names = (f.name.replace("`", "``") for f in schema)
    return ", ".join(f"`{n}` STRING" for n in names)
