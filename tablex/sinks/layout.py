"""Rows laid out so that predicates on any of several columns skip row groups: Z-order over ranges of their values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablex.functions.names import quoted
from tablex.operators.cut import ORDERED, key_constant, key_text
from tablex.session import configure

#: A column is cut into 2^BITS ranges of about as many rows each, by a sample of its values.
BITS, SAMPLED = 6, 8192


def range_texts(df: DataFrame, name: str, bits: int = BITS) -> list[str]:
    """At most 2^bits - 1 values of a column, rising and as text, between ranges of about as many rows.

    The sample only shapes the layout: every row is written whatever it holds.
    """
    dtype, column = df.schema[name].dataType, F.col(quoted(name))
    filled = df.where(column.isNotNull()).select(column.alias("key"), F.expr(key_text(quoted(name), dtype)).alias("text"))
    total = filled.count()
    sample = filled.sample(min(1.0, SAMPLED / total), seed=1) if total > SAMPLED else filled
    texts = [r.text for r in sample.orderBy("key").collect()]
    places = [len(texts) * k // (1 << bits) for k in range(1, 1 << bits)]
    return [*dict.fromkeys(texts[p] for p in places if texts)]


def range_bounds(df: DataFrame, names: Sequence[str], bits: int = BITS) -> dict[str, list[str]]:
    """The same for several columns, as SQL constants."""
    return {name: [key_constant(t, df.schema[name].dataType) for t in range_texts(df, name, bits)] for name in names}


def range_number(name: str, bounds: list[str]) -> Column:
    """How many bounds are not above the column, by a search of nested conditions; NULL comes last."""

    def between(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"CASE WHEN {quoted(name)} < {bounds[middle]} THEN {between(low, middle)} ELSE {between(middle + 1, high)} END"

    return F.expr(between(0, len(bounds)))


def z_order(df: DataFrame, names: Sequence[str], bits: int = BITS) -> Column:
    """The bits of the columns' range numbers in turn, the first column's highest bit first."""
    bounds = range_bounds(df, names, bits)
    key = F.lit(0).cast("bigint")
    for place, name in enumerate(names):
        number = range_number(name, bounds[name]).cast("bigint")
        for bit in range(bits):
            at = bit * len(names) + len(names) - 1 - place
            key = key.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("bigint")), at))
    return key


def clustered(df: DataFrame, names: Sequence[str], files: int = 0, bits: int = BITS) -> DataFrame:
    """The rows, dealt out and sorted by Z-order of the columns; write them as they come.

    files   parts to deal them out to; 0 leaves that to Spark, which goes by their size

    The columns themselves follow the Z-order in the sort, so that rows of one cell, and a frequent value, spread over
    several parts.
    """
    configure(df.sparkSession)
    wrong = [n for n in names if not isinstance(df.schema[n].dataType, ORDERED)]
    if not names or wrong or len(names) * bits > 62:
        raise ValueError(f"can't cluster by {wrong or list(names)}")
    keyed = df.withColumn("tx_z", z_order(df, names, bits))
    order = [F.col("tx_z"), *[F.col(quoted(n)) for n in names]]
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop("tx_z")
