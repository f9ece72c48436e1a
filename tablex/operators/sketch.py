"""Differences of two tables from sketches whose size follows the differences, not the tables.

An invertible Bloom lookup table: every row of 128 hash bits goes into one cell of each of three parts. A cell holds sums: of
the copies, of the four quarters of the hash, and of a check word. Rows of the one side count +1, of the other
-1, so rows on both sides leave no trace, whatever their number. Sums of partitions are added map-side: what is shuffled is
at most the cells, from each task, and no row.

A cell with one hash left tells it: its sums divided by its copies. Taking that hash out of its other cells leaves more
cells with one; each round is a join-free aggregate over the cells. With twice as many cells as differences nearly
every sketch unfolds in a few rounds. One that does not says so, and the caller takes the exact way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablex.functions.equality import row_hash
from tablex.session import stored

PARTS = 3
#: Buckets by which the number of differences is estimated, to about 1/20.
BUCKETS = 1024
#: Cells for each estimated difference, at least so many, and the most a sketch may have.
ROOM, LEAST, MOST = 2.0, 600, 3_000_000

LOW = 0xFFFFFFFF
SUMS = ("n", "q1", "q2", "q3", "q4", "check")


def hashed(df: DataFrame) -> DataFrame:
    return df.selectExpr(f"{row_hash(df.schema, 1)} AS h1", f"{row_hash(df.schema, 2)} AS h2")


def both_sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """(h1, h2, n) of every row, n = 1 for rows of a and -1 for rows of b."""
    return hashed(a).withColumn("n", F.lit(1)).unionAll(hashed(b).withColumn("n", F.lit(-1)))


def estimated(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> float:
    """About the number of different rows that one side has more often, each counted by the square of its surplus.

    Rows are added up with random signs; equal rows cancel, and the squares of the sums add up to what is left.
    """
    sign = "CASE WHEN xxhash64(7, h1, h2) >= 0 THEN n ELSE -n END"
    sums = both_sides(a, b).groupBy(F.expr(f"pmod(h2, {buckets})").alias("bucket")).agg(F.expr(f"sum({sign})").alias("s"))
    return sums.agg(F.coalesce(F.sum(F.col("s").cast("double") * F.col("s")), F.lit(0.0))).first()[0]


def cell_of(part: str, cells: int) -> str:
    """The cell of a hash in a part, of `cells` in all."""
    return f"({part} * {cells // PARTS} + pmod(xxhash64({part}, h1, h2), {cells // PARTS}))"


def placed(hashes: DataFrame, cells: int) -> DataFrame:
    """(cell, sums) of hashes (h1, h2, n), in each of their cells, not added up yet."""
    quarters = ["shiftrightunsigned(h1, 32)", f"h1 & {LOW}L", "shiftrightunsigned(h2, 32)", f"h2 & {LOW}L", f"xxhash64(9, h1, h2) & {LOW}L"]
    names = SUMS[1:]
    terms = [f"n * ({q}) AS {name}" for q, name in zip(quarters, names)]
    places = ", ".join(f"CAST({cell_of(str(k), cells)} AS BIGINT)" for k in range(PARTS))
    return hashes.selectExpr(f"explode(array({places})) AS cell", "CAST(n AS BIGINT) AS n", *terms)


def added(cells: DataFrame) -> DataFrame:
    """Sums by cell, of the cells in which something is left."""
    total = cells.groupBy("cell").agg(*[F.sum(s).alias(s) for s in SUMS])
    return total.where(" OR ".join(f"{s} <> 0" for s in SUMS))


def unfolded(sketch: DataFrame, cells: int) -> DataFrame | None:
    """(h1, h2, surplus) of all that the sketch holds, or None if it can't be told."""
    left, found = stored(sketch, "sketch"), None
    while left.head(1):
        left = left.withColumn("of", F.expr("nullif(n, 0)"))
        whole = " AND ".join(f"{s} % of = 0 AND {s} div of BETWEEN 0 AND {LOW}" for s in SUMS[1:])
        single = left.where(whole).selectExpr("cell", "n", "shiftleft(q1 div of, 32) | (q2 div of) AS h1", "shiftleft(q3 div of, 32) | (q4 div of) AS h2", "check div of AS word")
        part = f"(cell div {cells // PARTS})"
        single = single.where(f"word = (xxhash64(9, h1, h2) & {LOW}L) AND cell = {cell_of(f'CAST({part} AS INT)', cells)}")
        single = stored(single.groupBy("h1", "h2").agg(F.max("n").alias("n")), "single")
        if not single.head(1):
            return None
        found = single if found is None else found.unionAll(single)
        taken = placed(single.withColumn("n", -F.col("n")), cells)
        left = stored(added(left.drop("of").unionAll(taken)), "sketch")
    if found is None:
        return left.selectExpr("cell AS h1", "cell AS h2", "n AS surplus")
    return found.groupBy("h1", "h2").agg(F.sum("n").alias("surplus")).where("surplus <> 0")


def sketched(a: DataFrame, b: DataFrame, cells: int) -> DataFrame:
    """The cells in which the two tables differ."""
    return added(placed(both_sides(a, b), cells))


def surplus_by_sketch(a: DataFrame, b: DataFrame, cells: int = 0, most: int = MOST) -> DataFrame | None:
    """(h1, h2, surplus) of the row hashes that one side has more often; None if there are too many, or by bad luck.

    cells   size of the sketch; 0 takes one more pass over both tables to estimate it
    """
    if not cells:
        wanted = ROOM * estimated(a, b)
        if wanted > most:
            return None
        cells = LEAST + int(wanted)
    cells += -cells % PARTS
    return unfolded(sketched(a, b, cells), cells)
