"""Search in a large column dictionary by an index of trigrams, with the results of `search_columns`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablex.operators.profile import search_columns
from tablex.session import path_exists

# Letters of a gram, and grams of a text that are looked up: the rarest ones.
LETTERS = 3
LOOKED_UP = 4
ID = "_place"

TEXT = "lower(concat_ws('\\n', name, description))"
# A posting stands for the 64 rows of a block, one bit each.
BLOCK, BIT = f"shiftright({ID}, 6)", f"shiftleft(1L, CAST({ID} & 63 AS INT))"


def write_search_index(columns: DataFrame, path: str) -> None:
    """Rows, postings and counts of postings of a dictionary, in a new folder.

    A posting names the rows of a gram in one block of 64 rows, bit by bit. Postings are put together before they are
    shuffled, then sorted by gram and block over range partitions: a gram that every row has spreads over files, and a look-up
    skips the row groups of other grams. The counts, of rows, are written last and make the index whole.
    """
    spark = columns.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(path)
    columns.withColumn(ID, F.monotonically_increasing_id()).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    texts = rows.selectExpr(f"{BLOCK} AS block", f"{BIT} AS bit", f"{TEXT} AS t").where(f"length(t) >= {LETTERS}")
    places = texts.selectExpr("block", "bit", "t", f"explode(sequence(1, length(t) - {LETTERS - 1})) AS i")
    grams = places.selectExpr(f"substr(t, i, {LETTERS}) AS gram", "block", "bit")
    postings = grams.groupBy("gram", "block").agg(F.bit_or("bit").alias("bits"))
    postings.repartitionByRange("gram", "block").sortWithinPartitions("gram", "block").write.parquet(f"{path}/postings")
    counts = spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.sum(F.bit_count("bits")).alias("n"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/counts")


def rarest(spark: SparkSession, path: str, text: str) -> list[tuple[str, int]] | None:
    """The rarest grams of a text with their rows; empty if a gram is nowhere, None if the text has no gram."""
    text = text.lower()
    grams = sorted({text[i : i + LETTERS] for i in range(len(text) - LETTERS + 1)})
    if not grams:
        return None
    found = spark.read.parquet(f"{path}/counts").where(F.col("gram").isin(grams)).collect()
    if len(found) < len(grams):
        return []
    return sorted(((row.gram, row.n) for row in found), key=lambda pair: (pair[1], pair[0]))[:LOOKED_UP]


def search_index(spark: SparkSession, path: str, text: str) -> DataFrame:
    """Dictionary rows whose name or description holds the text, in any case; '' keeps all.

    Rows with all of the text's rarest trigrams are candidates and are verified; the rarest narrows the others down. A
    text under three letters scans the rows.
    """
    if not path_exists(spark, f"{path}/counts/_SUCCESS"):
        raise FileNotFoundError(f"{path} holds no complete index")
    rows = spark.read.parquet(f"{path}/rows")
    grams = rarest(spark, path, text)
    if grams is None:
        return search_columns(rows, text).drop(ID)
    if not grams:
        return rows.where("false").drop(ID)
    postings = spark.read.parquet(f"{path}/postings")
    found = postings.where(F.col("gram") == grams[0][0]).select("block", "bits")
    for gram, _ in grams[1:]:
        other = postings.where(F.col("gram") == gram).select("block", F.col("bits").alias("more"))
        found = found.join(other, "block").selectExpr("block", "bits & more AS bits").where("bits <> 0")
    found = found.withColumnsRenamed({"block": f"{ID}_block", "bits": f"{ID}_bits"})
    held = F.expr(f"{BLOCK} = {ID}_block AND {BIT} & {ID}_bits <> 0")
    return search_columns(rows.join(found, held, "left_semi"), text).drop(ID)
