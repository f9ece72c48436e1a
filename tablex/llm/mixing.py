"""Mixing sources to target weights: hash-random order within each source, exact word budgets, repeated epochs.

Sources in code-point order (NULL last) weigh 1, 2, 3, 1, 2, ... and share the words of the whole table;
no source is repeated more than three times, and what it can't use is shared again by weight. A NULL or
empty text has no words and takes none. A document's key is a hash of its id (of its text where the
id is NULL); rows alike in every column have one key and are told apart by no one. The document at the cut
gives its first words only, so that a source gives its budget, rounded down, to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablex.llm.common import BLANKS, count_blank_words, packed, ranked, table, unpacked
from tablex.session import stored

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Rows that share a source and a range of keys, on average; they are sorted and summed by one task.
BUCKET_ROWS = 2_000
KEY_BITS = 60


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    """A 60-bit hash of the id, of the text where the id is NULL."""
    identity = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed} "), identity).cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(m_source, m_total) with m_target: the words each source should give.

    Every round fixes the sources whose share exceeds `epochs` times their words and deals the rest anew;
    only three sums of a round come to the driver.
    """
    order = ranked(sources.withColumn("m_null", F.col("m_source").isNull()), ["m_null", "m_source"], "m_rank", "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("m_rank"), F.lit(len(weights))) + 1).cast("int"))
    order = stored(order.select("m_source", "m_total", weight.cast("long").alias("m_weight")), "weights")
    limit = F.col("m_total") * epochs
    level, fixed = 0.0, -1
    while True:
        above = limit <= F.col("m_weight") * F.lit(level) if fixed >= 0 else F.lit(False)
        row = order.agg(
            F.coalesce(F.sum("m_total"), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(~above, F.col("m_weight"))), F.lit(0)).alias("weight"),
            F.count(F.when(above, 1)).alias("fixed"),
        ).first()
        if row.fixed == fixed or not row.weight:
            break
        fixed, level = row.fixed, (row.words - row.used) / row.weight
    return order.withColumn("m_target", F.least(limit.cast("double"), F.col("m_weight") * F.lit(level)))


def mixed(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows with m_size, m_total and m_target (of the source) and m_taken: the words the mix takes, repeats counted.

    Input columns that begin with m_ are left out.

    The keys of a source are cut into ranges of about `BUCKET_ROWS` rows. The words of each range are
    summed first; a range's rows are then sorted by one task, which starts from the sum of those before it.
    """
    df = df.drop(*[c for c in df.columns if c.startswith("m_")])
    rows = df.count()
    bits = max(0, (max(1, rows) // BUCKET_ROWS).bit_length())
    keyed = df.withColumn("m_parts", F.split(F.coalesce(F.col(text), F.lit("")), BLANKS))
    keyed = keyed.withColumn("m_size", count_blank_words(F.col("m_parts")).cast("long")).drop("m_parts")
    keyed = keyed.withColumn("m_key", random_key(F.col(doc_id), F.col(text), seed)).withColumn("m_range", F.shiftright("m_key", KEY_BITS - bits))
    ranges = stored(keyed.groupBy(F.col(source).alias("m_source"), "m_range").agg(F.sum("m_size").alias("m_words")), "ranges")
    goal = targets(ranges.groupBy("m_source").agg(F.sum("m_words").alias("m_total")), weights, epochs)
    earlier = Window.partitionBy("m_source").orderBy("m_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("m_start", F.coalesce(F.sum("m_words").over(earlier), F.lit(0))).drop("m_words")
    goal = goal.withColumnRenamed("m_source", "m_name")
    starts = starts.join(goal, F.col("m_source").eqNullSafe(F.col("m_name"))).drop("m_name").withColumnRenamed("m_range", "m_at")
    placed = keyed.join(starts, F.col(source).eqNullSafe(F.col("m_source")) & (F.col("m_range") == F.col("m_at"))).drop("m_source", "m_at")
    before = Window.partitionBy(source, "m_range").orderBy("m_key", "m_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("m_start", F.col("m_start") + F.coalesce(F.sum("m_size").over(before), F.lit(0)))
    budget = F.floor("m_target")
    whole = F.when(F.col("m_total") > 0, F.floor(budget / F.greatest(F.col("m_total"), F.lit(1)))).otherwise(0)
    placed = placed.withColumn("m_whole", whole.cast("long"))
    rest = F.greatest(F.lit(0), F.least(F.col("m_size"), budget - F.col("m_whole") * F.col("m_total") - F.col("m_start")))
    placed = placed.withColumn("m_rest", rest.cast("long"))
    return placed.withColumn("m_taken", F.col("m_whole") * F.col("m_size") + F.col("m_rest")).drop("m_start", "m_key", "m_range", "m_weight")


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", n_chars: str = "n_chars", **kwargs) -> DataFrame:
    """The mix itself: each document as often as it is taken, the one at a cut with its first words; columns as given."""
    names = tuple(dict.fromkeys([doc_id, text, source, *([n_chars] if n_chars in df.columns else [])]))
    taken = mixed(packed(df, *names), doc_id, text, source, **kwargs).where("m_taken > 0")
    copies = F.col("m_whole") + (F.col("m_rest") > 0).cast("long")
    rows = taken.withColumn("m_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    pieces = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    start = F.array_join(F.slice(pieces, 1, F.col("m_rest").cast("int")), "")
    cut = (F.col("m_copy") > F.col("m_whole")) & (F.col("m_rest") < F.col("m_size"))
    rows = rows.withColumn(text, F.when(cut, start).otherwise(F.col(text)))
    if n_chars in df.columns:
        rows = rows.withColumn(n_chars, F.when(cut, F.length(text).cast(df.schema[n_chars].dataType)).otherwise(F.col(n_chars)))
    return unpacked(rows, df.columns, names)


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixed(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", F.col("m_size").alias("size"), F.col("m_total").alias("source_size"), F.col("m_target").alias("target"), F.col("m_taken").alias("taken"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANKS}'), lambda x: x <> '')) AS size,
    ('0x' || substr(md5('mix ' || coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, '')))), 1, {KEY_BITS // 4}))::BIGINT AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS total FROM d GROUP BY source),
w AS (SELECT source, total, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS weight FROM s),
o AS (SELECT *, sum(total) OVER () AS words, {MAX_EPOCHS} * total AS cap,
    coalesce(sum({MAX_EPOCHS} * total) OVER (ORDER BY total / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (ORDER BY total / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM w),
l AS (SELECT min_by((words - used)::BIGINT / free::BIGINT, total / weight) AS level FROM o WHERE (words - used)::BIGINT / free::BIGINT < cap / weight),
t AS (SELECT source, total, least(cap::DOUBLE, weight * coalesce(level, 1e300)) AS target FROM o, l),
p AS (SELECT doc_id, size, total, target, floor(target)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, total AS source_size, target,
  CASE WHEN total = 0 THEN 0 ELSE (budget // total) * size + greatest(0, least(size, budget - (budget // total) * total - start)) END AS taken
FROM p
"""

QUERIES = {"op10_mixing": op10_mixing}
ORACLES = {"op10_mixing": ORACLE}
