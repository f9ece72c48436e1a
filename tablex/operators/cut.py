"""The first n rows of a relation, by place or by keys: exactly n, without gathering them in one task.

Both cuts end in a predicate, which Spark pushes into the scan. It is found by counting: a few aggregates
over the key or no column at all, whose results are a handful of numbers. The relation is read once for each, so it
must give the same rows every time; what can't promise that is stored first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import sqrt
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tablex.functions.names import quoted
from tablex.functions.temporal import as_integer
from tablex.session import stored

#: So many rows may pass through one task.
FEW = 10_000
#: Keys sampled for a bound, and how many of them are counted in one pass.
SAMPLED, COUNTED = 4096, 16

ORDERED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.TimeType)


def by_place(df: DataFrame, n: int, few: int = FEW) -> DataFrame:
    """The first n rows of a scan of Parquet files, by file and by place within it.

    One pass counts the rows of each file; the file with the last row is counted by blocks of `few`. Files behind
    it are never opened again.
    """
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")

    def holder(counts: DataFrame, rows: int):
        """(key, rows before it, its rows) of the group that holds a row, in order of the keys; one line per group."""
        before = F.sum("rows").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
        placed = counts.select("key", "rows", F.coalesce(before, F.lit(0)).alias("before"))
        return placed.where((F.col("before") < rows) & (F.col("before") + F.col("rows") >= rows)).first()

    last = holder(df.groupBy(path.alias("key")).agg(F.count(F.lit(1)).alias("rows")), n)
    if last is None:
        return df
    rest, inside = n - last.before, df.where(path == last.key)
    if rest == last.rows:
        return df.where(path <= last.key)
    block = holder(inside.groupBy(F.floor(row / few).alias("key")).agg(F.count(F.lit(1)).alias("rows")), rest)
    places = inside.where((row >= block.key * few) & (row < (block.key + 1) * few)).select(row.alias("place"))
    place = places.orderBy("place").offset(rest - block.before - 1).first().place
    return df.where((path <= last.key) & ((path < last.key) | (row <= place)))


def first_rows(df: DataFrame, n: int, scanned: bool = False, few: int = FEW) -> DataFrame:
    """Any n rows of a relation, or all if it has no more.

    scanned     the relation is a scan of Parquet files, below nothing but filters and projections
                whose result is the same each time; any other is stored, n rows of each partition at most
    """
    if n <= few:
        return df.limit(n)
    if not scanned:
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        df = stored(df.where(place < n), "limit")
    return by_place(df, n, few)


def key_text(name: str, dtype: T.DataType) -> str:
    """A key as text that `key_literal` turns back into the same key."""
    return f"CAST({as_integer(name, dtype) if isinstance(dtype, T.DatetimeType) else name} AS STRING)"


def key_constant(text: str, dtype: T.DataType) -> str:
    """The key as a SQL constant, folded before the plan is made, so that comparisons with it reach the scan."""
    if isinstance(dtype, T.DateType):
        return f"date_from_unix_date({text})"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return f"CAST(timestamp_micros({text}L) AS {dtype.simpleString()})"
    quoted_text = "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return quoted_text if isinstance(dtype, T.StringType) else f"CAST({quoted_text} AS {dtype.simpleString()})"


def key_literal(text: str, dtype: T.DataType) -> Column:
    return F.expr(key_constant(text, dtype))


def top_rows(df: DataFrame, keys: Sequence[tuple[str, bool]], n: int, scanned: bool = False, few: int = FEW) -> DataFrame:
    """The first n rows by (name, descending) keys, in no order; NULL sorts above every value. Ties beyond all keys are cut anywhere.

    A bound on the leading key is drawn closer around the nth row: a sample of the keys between the bounds proposes
    values, one pass counts the rows before and at each. Each pass leaves less than a hundredth of the rows between
    them as a rule. Rows before the bound are all kept. If a single value is left with too many rows, they are cut by the
    next key in the same way; `few` rows or less are sorted.
    """
    whole: list[Column] = []  # conditions whose rows are all among the first
    scope: list[Column] = [F.lit(True)]  # where the last of them lie
    all_of = lambda *conditions: reduce(and_, [*scope, *conditions])

    def finished(last: DataFrame | None) -> DataFrame:
        kept = df.where(reduce(or_, whole)) if whole else None
        parts = [part for part in (kept, last) if part is not None]
        return reduce(DataFrame.unionAll, parts)

    for depth, (name, descending) in enumerate(keys):
        key, dtype = F.col(quoted(name)), df.schema[name].dataType
        total, filled = df.where(all_of()).agg(F.count(F.lit(1)), F.count(key)).first()
        if n >= total:
            whole.append(all_of())
            return finished(None)
        nulls = total - filled
        if descending and n > nulls:
            whole.append(all_of(key.isNull()))
            n -= nulls
        elif descending and n <= nulls or n > filled:
            if not descending:
                whole.append(all_of(key.isNotNull()))
                n -= filled
            scope.append(key.isNull())
            continue
        before = (lambda a, b: a > b) if descending else (lambda a, b: a < b)
        between, rows = [key.isNotNull()], filled
        while n and n < rows and rows > few:
            inside = df.where(all_of(*between))
            text = F.expr(key_text(quoted(name), dtype))
            sample = inside.select(key.alias("key"), text.alias("text"))
            if rows > SAMPLED:
                sample = sample.sample(min(1.0, SAMPLED / rows), seed=depth)
            order = F.col("key").desc() if descending else F.col("key").asc()
            sorted_texts = [r.text for r in sample.orderBy(order).collect()] or [sample.first().text]
            share = n / rows
            spread = 4 * sqrt(len(sorted_texts) * share * (1 - share)) + 2
            places = [share * len(sorted_texts) + spread * (2 * k / (COUNTED - 1) - 1) for k in range(COUNTED)]
            tried = dict.fromkeys(sorted_texts[min(len(sorted_texts) - 1, max(0, int(p)))] for p in places)
            values = [key_literal(t, dtype) for t in tried]
            counts = inside.agg(*[F.count_if(c) for v in values for c in (before(key, v), (key == v) | before(key, v))]).first()
            low, high, lower, upper, tie = None, None, 0, rows, None
            for k, v in enumerate(values):
                ahead, upto = counts[2 * k], counts[2 * k + 1]
                if upto < n or upto == n and upto > lower:
                    low, lower = v, upto
                elif ahead < n:
                    tie = v, ahead, upto - ahead
                    break
                else:
                    high, upper = v, ahead
                    break
            if tie:
                v, ahead, rows = tie
                if ahead:
                    whole.append(all_of(*between, before(key, v)))
                between, n = [key == v], n - ahead
                break
            if low is not None:
                whole.append(all_of(*between, (key == low) | before(key, low)))
                between, n = [*between, before(low, key)], n - lower
            if high is not None:
                between = [*between, before(key, high)]
            rows = upper - lower
        if not n:
            return finished(None)
        if n >= rows:
            whole.append(all_of(*between))
            return finished(None)
        if rows <= few:
            order = [F.col(quoted(k)).desc_nulls_first() if d else F.col(quoted(k)).asc_nulls_last() for k, d in keys]
            return finished(df.where(all_of(*between)).orderBy(*order).limit(n))
        scope += between
    return finished(first_rows(df.where(all_of()), n, scanned, few))
