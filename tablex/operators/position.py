"""Rows by their place: numbers without gathering rows, and tables compared row by row where no key names their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tablex.functions.equality import comparable_text
from tablex.functions.names import quoted, unique_columns
from tablex.operators.reconcile import changed_cells, hash_pair, whole_rows
from tablex.session import configure, stored


def numbered(df: DataFrame, name: str = "row", scanned: bool = False) -> DataFrame:
    """The rows with their number, from 0, in the order of the files and of the places within them.

    scanned     the rows come from Parquet files through filters and projections alone. Any other relation is
                stored first, a file for each partition: an ordered one is numbered in its order

    Files count their own rows; the sums of those before a file are one row per file. A filter above the scan leaves
    no gaps: with one, rows are numbered within their file by blocks of places.
    """
    if not scanned:
        df = stored(df, "numbered")
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    kept = df.select("*", file.alias("tx_file"), place.alias("tx_place"))
    # Spark numbers part files; beyond 99999 their names no longer sort as their numbers do.
    part = F.coalesce(F.expr(r"try_cast(regexp_extract(tx_file, 'part-(\\d+)', 1) AS BIGINT)"), F.lit(-1))
    counts = kept.groupBy("tx_file").agg(F.count(F.lit(1)).alias("tx_rows"), F.max("tx_place").alias("tx_last"))
    before = F.coalesce(F.sum("tx_rows").over(Window.orderBy(part, "tx_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored(counts.select("tx_file", "tx_rows", "tx_last", before.alias("tx_start")), "starts")
    number = F.col("tx_start") + F.col("tx_place")
    if starts.where("tx_rows <> tx_last + 1").head(1):
        rank = F.row_number().over(Window.partitionBy("tx_file", "tx_block").orderBy("tx_place"))
        block = F.floor(F.col("tx_place") / BLOCK)
        sizes = kept.groupBy("tx_file", block.alias("tx_block")).agg(F.count(F.lit(1)).alias("tx_size"))
        ahead = F.coalesce(F.sum("tx_size").over(Window.partitionBy("tx_file").orderBy("tx_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        blocks = stored(sizes.select("tx_file", "tx_block", ahead.alias("tx_ahead")), "blocks")
        kept = kept.withColumn("tx_block", block).join(blocks, ["tx_file", "tx_block"]).withColumn("tx_rank", rank - 1)
        number = F.col("tx_start") + F.col("tx_ahead") + F.col("tx_rank")
    # One row per file: Spark broadcasts them if their stored size allows.
    return kept.join(starts.select("tx_file", "tx_start"), "tx_file").select(number.alias(name), *[quoted(c) for c in df.columns])


#: Places of a file that are numbered together where a filter leaves gaps.
BLOCK = 100_000


def diff_rows(a: DataFrame, b: DataFrame, tolerance_us: int = 0, scanned: bool = False) -> DataFrame:
    """Differences of b (got) from a (want), first row against first row: row, status, column, want, got.

    changed     the cell of `column` differs in the row of this number
    missing     only a has so many rows; extra: only b has. `want` or `got` is the whole row

    Numbers and hashes meet in a join; only rows whose hashes differ are read again, with their cells.

    scanned     see `numbered`; else both tables are stored, in the order they have
    tolerance_us    timestamps this close are the same
    """
    a, b = unique_columns(a), unique_columns(b)
    if a.columns != b.columns:
        raise ValueError(f"columns differ: {a.columns} and {b.columns}")
    configure(a.sparkSession)
    want, got = (numbered(df, "tx_row", scanned) for df in (a, b))
    fields = a.schema.fields
    hashes = [df.selectExpr("tx_row", *hash_pair(df.select(*[quoted(f.name) for f in fields]).schema, "h")) for df in (want, got)]
    both = hashes[0].alias("w").join(hashes[1].alias("g"), "tx_row", "full")
    far = stored(both.where("NOT (w.h1 <=> g.h1 AND w.h2 <=> g.h2)").selectExpr("tx_row", "w.h1 IS NOT NULL AS tx_want", "g.h1 IS NOT NULL AS tx_got"), "places")

    def cells(df: DataFrame, name: str) -> DataFrame:
        texts = ", ".join(comparable_text(quoted(f.name), f.dataType) for f in df.schema if f.name != "tx_row")
        return df.join(far.where(f"tx_{name}"), "tx_row").selectExpr("struct(tx_row AS row) AS key", "tx_row", f"array({texts}) AS cells", "tx_want AND tx_got AS tx_both", f"'{name}' AS side", "1L AS copies")

    left, right = cells(want, "want"), cells(got, "got")
    pairs = left.where("tx_both").selectExpr("tx_row", "key", "cells AS want_cells").join(right.where("tx_both").selectExpr("tx_row", "cells AS got_cells"), "tx_row")
    changed = changed_cells(pairs, T.StructType(fields), tolerance_us, ["row"])
    return changed.unionAll(whole_rows(left.unionAll(right).where("NOT tx_both"), ["row"])).drop("copies")
