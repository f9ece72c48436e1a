"""Before an extract runs: counts, samples, table profiles and column dictionaries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablex.functions.declared import source_type
from tablex.functions.names import quoted, unique_columns

# Rows of a dry run and of a preview that names no number.
SAMPLE_ROWS = 5
PREVIEW_ROWS = 50

DICTIONARY = "table string, ordinal int, name string, type string, nullable boolean"


def extract_count(df: DataFrame) -> DataFrame:
    """One row: the exact number of rows."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def shown(field: T.StructField) -> Column:
    c = F.col(quoted(field.name))
    nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    text = F.to_json(c) if nested else c.cast("string")
    return F.coalesce(text, F.lit("NULL")).alias(field.name)


def sample(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first n rows as text, a missing value shown as NULL."""
    df = unique_columns(df)
    return df.limit(n).select(*[shown(field) for field in df.schema])


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> tuple[DataFrame, DataFrame]:
    """A sample of n rows (50 for n <= 0), and the number of rows in all."""
    return sample(df, n if n > 0 else PREVIEW_ROWS), extract_count(df)


def from_files(df: DataFrame) -> bool:
    """Whether every row can name the file it came from."""
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return False
    return True


def relation_bytes(df: DataFrame) -> int | None:
    """Bytes of all files a table is read from, empty ones too, as its file listing has them; NULL without files."""
    if not from_files(df):
        return None
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    scans = [leaf for leaf in map(leaves.apply, range(leaves.size())) if leaf.getClass().getSimpleName() == "LogicalRelation"]
    return sum(int(leaf.relation().sizeInBytes()) for leaf in scans)


def profile(
    tables: Mapping[str, DataFrame], schema: str = "", comments: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per table: schema, table, comment, row_count, bytes.

    A count of a Parquet table reads row counts only, no column; bytes come from the listing of its files
    and are NULL for a table not read from files.
    """
    rows = []
    for name, df in tables.items():
        comment = F.lit((comments or {}).get(name)).cast("string")
        size = F.lit(relation_bytes(df)).cast("bigint")
        rows.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(schema).alias("schema"), F.lit(name).alias("table"), comment.alias("comment"), "row_count", size.alias("bytes")))
    return reduce(DataFrame.unionAll, rows)


def dictionary(
    spark: SparkSession, tables: Mapping[str, DataFrame], descriptions: DataFrame | None = None
) -> DataFrame:
    """One row per column: table, ordinal, name, type, nullable, description.

    descriptions    rows of (table, name, description); a column without one has ''
    """
    rows = [
        (table, i, field.name, source_type(field), field.nullable)
        for table, df in tables.items()
        for i, field in enumerate(df.schema, start=1)
    ]
    columns = spark.createDataFrame(rows, DICTIONARY)
    if descriptions is None:
        described = columns.withColumn("description", F.lit(""))
    else:
        described = columns.join(descriptions, ["table", "name"], "left").withColumn(
            "description", F.coalesce("description", F.lit(""))
        )
    return described.select(*columns.columns, "description").orderBy("table", "ordinal")


def catalog_dictionary(
    attributes: DataFrame,
    classes: DataFrame,
    namespaces: DataFrame,
    descriptions: DataFrame,
    schema: str = "",
    table: str = "",
) -> DataFrame:
    """The dictionary of every table in a snapshot of a database catalogue.

    attributes      attrelid, attnum, attname, atttype, attnotnull, attisdropped
    classes         oid, relname, relnamespace
    namespaces      oid, nspname
    descriptions    objoid, objsubid, description (one per object and column)
    schema, table   keep one schema, one table

    Spark broadcasts a side only where its statistics show it small enough.
    """
    if schema:
        namespaces = namespaces.where(F.col("nspname") == schema)
    if table:
        classes = classes.where(F.col("relname") == table)
    live = attributes.where((F.col("attnum") > 0) & ~F.col("attisdropped"))
    relations = classes.join(
        namespaces.select(F.col("oid").alias("relnamespace"), "nspname"), "relnamespace"
    ).select(F.col("oid").alias("attrelid"), "nspname", "relname")
    texts = descriptions.select(
        F.col("objoid").alias("attrelid"), F.col("objsubid").alias("attnum"), "description"
    )
    return (
        live.join(relations, "attrelid")
        .join(texts, ["attrelid", "attnum"], "left")
        .select(
            F.col("nspname").alias("schema"),
            F.col("relname").alias("table"),
            F.col("attnum").alias("ordinal"),
            F.col("attname").alias("name"),
            F.col("atttype").alias("type"),
            (~F.col("attnotnull")).alias("nullable"),
            F.coalesce("description", F.lit("")).alias("description"),
        )
        .orderBy("schema", "table", "ordinal")
    )


def search_columns(columns: DataFrame, text: str) -> DataFrame:
    """Dictionary rows whose name or description holds the text, in any case; '' keeps all."""
    if not text:
        return columns
    wanted = F.lit(text.lower())
    return columns.where(
        F.contains(F.lower("name"), wanted) | F.contains(F.lower("description"), wanted)
    )


def info_json(profiles: DataFrame, columns: DataFrame) -> DataFrame:
    """One JSON text per table; an absent comment, size or description leaves no key.

    A table's group is its list of columns, as long as the table is wide.
    """
    entry = F.struct(
        "ordinal",
        F.struct(
            "name", "type", "nullable", F.nullif("description", F.lit("")).alias("description")
        ).alias("column"),
    )
    lists = columns.groupBy("table").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    info = F.struct(
        "schema",
        "table",
        F.nullif("comment", F.lit("")).alias("comment"),
        "row_count",
        F.col("bytes").alias("size"),
        F.coalesce(F.col("entries.column"), F.array()).alias("columns"),
    )
    return profiles.join(lists, "table", "left").select(
        "table", F.to_json(info).alias("info")
    )
