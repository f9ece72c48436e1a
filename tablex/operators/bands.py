"""One-to-one matching of instants within a tolerance, where keys repeat: as many rows as possible find a partner.

Time is cut into cells as wide as the tolerance. All rows of a cell are close, rows of two cells are close only if the
cells are neighbours. Taken in order of time, a cell hands its last rows, of one side, to the next. How many the next one
can use is bounded by a number that depends on the two cells alone (`partners`), so a cell turns a surplus x (rows of one
side, or as a negative number of the other) into min(max(x, low), high) + step. Such steps compose into one of the same
form: cells are folded in blocks, the blocks in blocks of blocks, and no task sees more than a block of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tablex.functions.equality import EXTREME
from tablex.session import stored

# Cells folded at once: a row holds one block.
BLOCK = 1024

GROUP = ["g1", "g2"]


def partners(points: DataFrame, tolerance_us: int) -> DataFrame:
    """(group, cell, low, high): rows of a cell that can take a partner of the cell before: -low of side a, high of side b.

    The later a row of the cell before, the more partners it has. So as many find one as there are rows, less the
    greatest excess of rows up to some instant over the partners within its reach. The rows of two neighbouring cells are
    sorted for that, by group and direction: distinct rows within twice the tolerance.
    """
    first = points.select(*GROUP, (F.col("cell") + 1).alias("cell"), (F.col("side") > 0).alias("upward"), (F.col("t") + tolerance_us).alias("t"), F.col("copies").alias("weight"))
    second = points.select(*GROUP, "cell", (F.col("side") < 0).alias("upward"), "t", (-F.col("copies")).alias("weight"))
    each = first.unionAll(second).groupBy(*GROUP, "cell", "upward", "t", (F.col("weight") > 0).alias("earlier")).agg(F.sum("weight").alias("weight"))
    order = Window.partitionBy(*GROUP, "cell", "upward").orderBy("t", "weight").rowsBetween(Window.unboundedPreceding, 0)
    earlier = F.col("weight") > 0
    found = each.withColumn("excess", F.sum("weight").over(order)).groupBy(*GROUP, "cell", "upward").agg(
        (F.sum(F.when(earlier, F.col("weight"))) - F.greatest(F.max(F.when(earlier, F.col("excess"))), F.lit(0))).alias("n")
    )
    upward = F.when(F.col("upward"), F.col("n"))
    downward = F.when(~F.col("upward"), F.col("n"))
    return found.groupBy(*GROUP, "cell").agg((-F.coalesce(F.max(downward), F.lit(0))).alias("low"), F.coalesce(F.max(upward), F.lit(0)).alias("high"))


# What a step makes of the surplus x, and of the range (least, most) that earlier steps leave.
CLAMPED = "least(greatest({x}, s.low), s.high) + s.step"


def carried(cells: DataFrame) -> DataFrame:
    """(group, cell, entering): the surplus that enters each cell, for rows (group, cell, low, high, step, linked).

    Cells count from 0. Only a linked cell can take something over, from the cell just before; so a block is open to the
    block before if its very first cell is linked.
    """
    step = F.struct("cell", "low", "high", "step", "linked").alias("s")
    blocks = cells.groupBy(*GROUP, F.expr(f"cell DIV {BLOCK}").alias("block")).agg(F.array_sort(F.collect_list(step)).alias("steps"))
    least, most = CLAMPED.format(x="acc.least"), CLAMPED.format(x="acc.most")
    folded = stored(
        blocks.selectExpr(
            *GROUP, "block", "steps", f"steps[0].linked AND steps[0].cell % {BLOCK} = 0 AS open",
            "aggregate(slice(steps, 2, size(steps)), named_struct('least', steps[0].low + steps[0].step, 'most', steps[0].high + steps[0].step, 'step', steps[0].step),"
            f" (acc, s) -> named_struct('least', {least}, 'most', {most}, 'step', acc.step + s.step)) AS whole",
        ),
        "blocks",
    )
    if folded.where("open").isEmpty():
        started = folded.withColumn("entering", F.lit(0).cast("bigint"))
    else:
        above = folded.selectExpr(*GROUP, "block AS cell", "whole.least - whole.step AS low", "whole.most - whole.step AS high", "whole.step AS step", "open AS linked")
        started = folded.join(carried(above).withColumnRenamed("cell", "block"), [*GROUP, "block"])
    # Each cell's entry is what the cells before it in the block leave; the last one's result is not needed.
    after = "array_append(acc, " + CLAMPED.format(x="element_at(acc, -1)") + ")"
    entries = started.selectExpr(*GROUP, "steps", f"aggregate(slice(steps, 1, size(steps) - 1), array(entering), (acc, s) -> {after}) AS entries")
    return entries.selectExpr(*GROUP, "explode(arrays_zip(steps.cell, entries)) AS e").selectExpr(*GROUP, "e.cell AS cell", "e.entries AS entering")


def without_partner(rows: DataFrame, tolerance_us: int) -> DataFrame:
    """The rows, with the copies that find no partner; rows all of whose copies find one are left out.

    rows    g1, g2 (what must be equal), t (microseconds or NULL), side (1 or -1), copies, and an id of the row, h1 and h2.
            NULL meets NULL only; instants beyond 2^62 meet those of the same sign

    The number of copies left is the least possible. Of a cell's rows the last ones wait for partners of the next, and of
    those the latest find them. Rows with one id and one `t` are one row.
    """
    kind = f"CASE WHEN t IS NULL THEN 1 WHEN t >= {EXTREME}L THEN 2 WHEN t <= -{EXTREME}L THEN 3 ELSE 0 END"
    points = rows.withColumn("g2", F.expr(f"xxhash64(g2, {kind})")).withColumn("t", F.expr(f"CASE WHEN {kind} = 0 THEN t ELSE 0 END"))
    points = stored(points.withColumn("cell", F.expr(f"(t - pmod(t, {tolerance_us}L)) DIV {tolerance_us}L + {2**62 // tolerance_us + 1}L")), "points")
    steps = points.groupBy(*GROUP, "cell").agg(F.sum(F.col("side") * F.col("copies")).alias("step"))
    bounds = stored(partners(points, tolerance_us), "partners")
    cells = stored(
        steps.join(bounds, [*GROUP, "cell"]).join(
            bounds.select(*GROUP, (F.col("cell") - 1).alias("cell"), F.col("low").alias("next_low"), F.col("high").alias("next_high")), [*GROUP, "cell"]
        ),
        "cells",
    )
    leaving = cells.join(carried(cells.select(*GROUP, "cell", "low", "high", "step", (F.col("low") < F.col("high")).alias("linked"))), [*GROUP, "cell"]).selectExpr(
        *GROUP, "cell", "least(greatest(entering, low), high) + step AS out", "next_low", "next_high"
    )
    waiting = leaving.selectExpr(
        *GROUP, "cell", "CAST(sign(out) AS INT) AS side", "abs(out) AS waiting", "CASE WHEN out > 0 THEN next_high ELSE -next_low END AS taken"
    ).where("waiting > taken")
    last = Window.partitionBy(*GROUP, "cell", "side").orderBy(F.desc("t"), "h1", "h2").rowsBetween(Window.unboundedPreceding, 0)
    ranked = points.join(waiting, [*GROUP, "cell", "side"]).withColumn("rank", F.sum("copies").over(last))
    left = "greatest(least(rank, waiting) - greatest(rank - copies, taken), 0)"
    return ranked.withColumn("copies", F.expr(left)).where("copies > 0").select(*[c for c in rows.columns if c not in (*GROUP, "t")])
