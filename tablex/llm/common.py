"""What the operators share: table readers, word and line patterns, exact ranks of spread-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablex.session import stored

#: White space of the word counts: blank, tab, newline, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_WORD = r"[^\x20\x09-\x0D]+"
#: Words of the phrase and shingle operators: digits, lower-case letters and all beyond ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(df: DataFrame, *names: str) -> DataFrame:
    """The columns named as they are and all others in one: names that an operator adds then can't clash with theirs."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*[F.col(f"`{n}`") for n in names], (F.struct(*rest) if rest else F.lit(0)).alias("packed_rest"))


def unpacked(df: DataFrame, columns: list[str], names: tuple[str, ...]) -> DataFrame:
    """`packed` undone: the columns as they were, in their order."""
    return df.select(*[(F.col(f"`{c}`") if c in names else F.col("packed_rest")[c]).alias(c) for c in columns])


def remainder(doc_id: Column | str, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; NULL for a NULL id."""
    return F.pmod(F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")), F.lit(by))


def blank_words(text: Column) -> Column:
    """Words between white space, as an array; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def count_blank_words(parts: Column) -> Column:
    """Number of words, from the text split at white space (only its ends can be empty)."""
    n = F.size(parts)
    return n - (F.get(parts, F.lit(0)) == "").cast("int") - ((F.get(parts, n - 1) == "") & (n > 1)).cast("int")


def letter_words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of digits, letters and all beyond ASCII; none for NULL."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(low, NOT_WORD), lambda w: w != "")


def ranked(df: DataFrame, keys: list[str], rank: str, label: str) -> DataFrame:
    """Adds the dense rank (from 0) of the rows by `keys`, which must be unique and order them; no row is gathered.

    The rows are range-partitioned and stored with their partition, so that the counts per partition
    and the places within them come from the same rows. The rows of one partition must fit a task.
    """
    pid = f"{rank}_part"
    placed = stored(df.repartitionByRange(*keys).withColumn(pid, F.spark_partition_id()), label)
    counts = placed.groupBy(pid).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(pid, before.alias(f"{rank}_start"))  # one row per partition
    place = F.row_number().over(Window.partitionBy(pid).orderBy(*keys))
    return placed.join(F.broadcast(starts), pid).withColumn(rank, F.col(f"{rank}_start") + place - 1).drop(pid, f"{rank}_start")
