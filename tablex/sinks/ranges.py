"""Exports cut by key ranges, each with its fingerprint kept beside the data: a later check reads only ranges that differ.

    tx_range=<k>/part-….parquet     the rows of a range of keys, sorted
    _ranges/                        schema and bounds of the ranges, and rows and fingerprint sums of each; complete
                                    once these are

Two exports with the same bounds are compared range by range from `_ranges` alone, a few numbers each. Spark then prunes
both to the folders of the ranges that differ: what is read and compared row by row falls with the share that changed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablex.functions.names import quoted, unique_columns
from tablex.operators.cut import key_constant
from tablex.operators.reconcile import diff_cells, digest_sums
from tablex.session import configure, create_once, path_exists, read_text
from tablex.sinks.files import optional_fields, write_parquet_folder
from tablex.sinks.layout import range_number, range_texts

#: An export is cut into 2^BITS ranges of about as many rows each.
BITS = 6
RANGE = "tx_range"


def head_of(spark: SparkSession, path: str) -> dict:
    """Schema and bounds of an export."""
    return json.loads(read_text(spark, f"{path.rstrip('/')}/_ranges/head.json"))


def write_ranges(df: DataFrame, path: str, key: str, like: str = "", bits: int = BITS) -> int:
    """Write an export cut by ranges of its leading key; returns the rows written.

    like    an export whose bounds this one takes, so that the two can be compared
    """
    spark = configure(df.sparkSession)
    df = unique_columns(df)
    if RANGE in df.columns:
        raise ValueError(f"a column is named {RANGE}")
    root, dtype = path.rstrip("/"), df.schema[key].dataType
    if path_exists(spark, root):
        raise FileExistsError(path)
    texts = head_of(spark, like)["bounds"] if like else range_texts(df, key, bits)
    number = range_number(key, [key_constant(t, dtype) for t in texts])
    keyed = optional_fields(df).withColumn(RANGE, number)
    dealt = keyed.repartitionByRange(RANGE, quoted(key)).sortWithinPartitions(RANGE, quoted(key))
    write_parquet_folder(dealt, root, [RANGE])
    head = {"bounds": texts, "schema": keyed.schema.jsonValue()}
    create_once(spark, f"{root}/_ranges/head.json", json.dumps(head))
    sums = digest_sums(read_ranges(spark, root), RANGE)
    sums.write.option("compression", "zstd").parquet(f"{root}/_ranges/digests")
    return spark.read.parquet(f"{root}/_ranges/digests").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The rows with their range in `tx_range`, a partition column: predicates on it are pruned."""
    return configure(spark).read.schema(T.StructType.fromJson(head_of(spark, path)["schema"])).parquet(path)


def changed_ranges(spark: SparkSession, a: str, b: str) -> list[int]:
    """The ranges in which two exports differ, from their fingerprints alone."""
    if head_of(spark, a)["bounds"] != head_of(spark, b)["bounds"]:
        raise ValueError("the exports were cut at different bounds")
    want, got = (spark.read.parquet(f"{p.rstrip('/')}/_ranges/digests") for p in (a, b))
    sums = [c for c in want.columns if c != RANGE]
    both = want.alias("w").join(got.alias("g"), RANGE, "full")
    alike = " AND ".join(f"w.{quoted(c)} <=> g.{quoted(c)}" for c in sums)
    return sorted(r[0] for r in both.where(f"NOT ({alike})").select(RANGE).collect())  # at most 2^bits numbers


def diff_exports(spark: SparkSession, a: str, b: str, keys: Sequence[str], **kwargs) -> DataFrame:
    """`diff_cells` of two exports cut alike, reading only the files of the ranges that differ."""
    ranges = changed_ranges(spark, a, b)
    want, got = (read_ranges(spark, p).where(F.col(RANGE).isin(ranges)).drop(RANGE) for p in (a, b))
    return diff_cells(want, got, keys, **kwargs)
