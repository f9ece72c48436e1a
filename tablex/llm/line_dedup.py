"""Line dedup: later copies of repeated line runs go, found by prefix doubling over the sequences of line ids.

The suffixes of all texts, taken line by line, are ranked by their first line, then by 2, 4, 8, ... lines: the rank
of 2h lines is that of the pair (rank of h lines here, rank of h lines h lines on), and pairs are ranked by a
range sort of the distinct pairs. Suffixes whose prefix stands nowhere else have left by then.

A run counts if it has at least `min_words` words. Let m(i) be the fewest lines from line i that have so many. A
run that counts and stands twice is a chain of windows [i, i + m(i)) that each stand twice, so the intervals of
the suffix array whose common prefix has m(i) lines or more show every maximal run, and ranks up to
max m(i) <= min_words lines suffice: the number of rounds does not grow with the data. Two ranks, of the
window's first and of its last power-of-two lines, name such an interval; its first place stays, and the lines of
all its other places go. What is left of neighbouring windows merges into maximal runs by itself.

Lines are equal if all their characters are; lines without a word belong to no run and stay. The first place is
that of the smallest id (NULL last), then line. Rows alike in id and text are one document: what goes in one
goes in all. NULL texts have no lines and stay NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablex.llm.common import BLANKS, count_blank_words, ranked, table
from tablex.session import stored

MIN_WORDS = 50
KEY = ["x_doc", "x_check"]


def document_key(doc_id: Column, text: Column) -> list[Column]:
    """96 bits that stand for a document (id and text)."""
    return [F.xxhash64(doc_id, text).alias("x_doc"), F.hash(text, doc_id).alias("x_check")]


def worded_lines(text: Column) -> Column:
    """(line, at) of the lines that have a word; `at` counts all lines."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("at"))), lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"))


def line_rows(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """(key, x_id, x_at, x_line, x_line_check, x_lines): each worded line, and how many lines its window has (NULL: the text ends before)."""
    rows = docs.select(*document_key(F.col(doc_id), F.col(text)), F.col(doc_id).alias("x_id"), worded_lines(F.col(text))["line"].alias("x_texts"))
    # Two steps, so that a line is split once and not wherever its parts are used.
    rows = rows.withColumn("x_words", F.transform(F.transform("x_texts", lambda line: F.split(line, BLANKS)), count_blank_words))

    def reach(_, i):
        step = lambda acc, n: F.when(acc["words"] >= min_words, acc).otherwise(F.struct((acc["lines"] + 1).alias("lines"), (acc["words"] + n).alias("words")))
        start = F.struct(F.lit(0).alias("lines"), F.lit(0).alias("words"))
        return F.aggregate(F.slice("x_words", i + 1, min_words), start, step, lambda acc: F.when(acc["words"] >= min_words, acc["lines"]))

    each = F.arrays_zip(F.transform("x_texts", lambda t: F.xxhash64(t)).alias("x_line"), F.transform("x_texts", lambda t: F.hash(t)).alias("x_line_check"), F.transform("x_words", reach).alias("x_lines"))
    return rows.select(*KEY, "x_id", F.posexplode(each).alias("x_at", "x_each")).select(*KEY, "x_id", "x_at", "x_each.x_line", "x_each.x_line_check", "x_each.x_lines")


def named(rows: DataFrame, parts: list[str], label: str) -> DataFrame:
    """The rows whose `parts` occur more than once, with their rank x_rank instead of the parts; copies are counted before they meet."""
    repeated = rows.groupBy(*parts).count().where("count > 1").drop("count")
    return rows.join(ranked(repeated, parts, "x_rank", f"{label}_ranks"), parts).drop(*parts)


def levels(lines: DataFrame, min_words: int) -> list[DataFrame]:
    """Ranks of the prefixes of 1, 2, 4, ... lines: (key, x_at, x_rank), without the prefixes that stand once."""
    place = [*KEY, "x_at"]
    out = [stored(named(lines.select(*place, "x_line", "x_line_check").distinct(), ["x_line", "x_line_check"], "level_1"), "level_1")]
    reach = 1
    while reach * 2 <= min_words:
        level = out[-1].withColumnRenamed("x_rank", "x_first")
        later = out[-1].select(*KEY, (F.col("x_at") - reach).alias("x_at"), F.col("x_rank").alias("x_second"))
        reach *= 2
        out.append(stored(named(level.join(later, place), ["x_first", "x_second"], f"level_{reach}"), f"level_{reach}"))
        if not out[-1].head(1):
            break
    return out


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(key, x_gone): for each document with later copies, its worded lines that go, by their number from 0."""
    place = [*KEY, "x_at"]
    lines = stored(line_rows(docs, doc_id, text, min_words), "lines")
    found = levels(lines, min_words)
    ranks = found[0].withColumn("x_level", F.lit(0))
    for k, level in enumerate(found[1:], 1):
        ranks = ranks.unionByName(level.withColumn("x_level", F.lit(k)))
    windows = lines.where(F.col("x_lines").isNotNull()).select(*place, "x_id", "x_lines").distinct()
    windows = windows.withColumn("x_level", F.floor(F.log2("x_lines") + 1e-9).cast("int"))
    windows = windows.join(ranks.withColumnRenamed("x_rank", "x_first"), [*place, "x_level"])
    windows = windows.withColumn("x_end", F.col("x_at") + F.col("x_lines") - F.pow(F.lit(2.0), "x_level").cast("int"))
    ends = ranks.select(*KEY, F.col("x_at").alias("x_end"), "x_level", F.col("x_rank").alias("x_second"))
    windows = stored(windows.join(ends, [*KEY, "x_end", "x_level"]).drop("x_end"), "windows")
    interval = ["x_level", "x_lines", "x_first", "x_second"]
    here = F.struct(F.col("x_id").isNull(), F.col("x_id"), F.col("x_doc"), F.col("x_check"), F.col("x_at"))
    first = windows.groupBy(*interval).agg(F.min(here).alias("x_kept"), F.count("*").alias("x_places")).where("x_places > 1")
    gone = windows.join(first, interval).where(here > F.col("x_kept")).select(*KEY, F.sequence("x_at", F.col("x_at") + F.col("x_lines") - 1).alias("x_run"))
    return gone.groupBy(*KEY).agg(F.array_distinct(F.flatten(F.collect_list("x_run"))).alias("x_gone"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows with x_n_lines, x_removed (numbers of the lines that go, from 0 over all lines, sorted) and x_kept (the text without them).

    Input columns that begin with x_ are left out.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("x_")])
    key, check = document_key(F.col(doc_id), F.col(text))
    gone = copies(docs, doc_id, text, min_words)
    rows = docs.withColumns({"x_doc": key, "x_check": check}).join(gone, KEY, "left").drop(*KEY)
    rows = rows.withColumn("x_worded", worded_lines(F.col(text))["at"]).withColumn("x_gone", F.coalesce("x_gone", F.array().cast("array<int>")))
    rows = rows.withColumn("x_removed", F.sort_array(F.transform("x_gone", lambda n: F.get(F.col("x_worded"), n))))
    lines = F.split(F.col(text), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("x_removed"))
    kept = F.when(F.size("x_removed") == 0, F.col(text)).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return rows.withColumn("x_n_lines", F.size("x_worded").cast("long")).withColumn("x_kept", kept).drop("x_worded", "x_gone")


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = deduplicated(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("x_n_lines").alias("n_lines"),
        F.size("x_removed").cast("long").alias("n_removed"),
        F.array_join("x_removed", ",").alias("removed_lines"),
        F.length("x_kept").cast("long").alias("kept_chars"),
    )


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT rid, at_line, ls[at_line + 1] AS line, row_number() OVER (PARTITION BY rid ORDER BY at_line) AS n,
    len(list_filter(regexp_split_to_array(ls[at_line + 1], '{BLANKS}'), lambda x: x <> '')) AS words
  FROM (SELECT rid, ls, unnest(range(len(ls))) AS at_line FROM d) WHERE regexp_matches(ls[at_line + 1], '[^\x20\x09-\x0D]')),
s AS (SELECT *, sum(words) OVER (PARTITION BY rid ORDER BY n) AS total FROM l),
m AS (SELECT a.rid, a.n, min(b.n) - a.n + 1 AS size FROM s a JOIN s b ON a.rid = b.rid AND b.n >= a.n AND b.total - a.total + a.words >= {MIN_WORDS} GROUP BY a.rid, a.n),
w AS (SELECT m.rid, m.n, m.size, string_agg(line, chr(10) ORDER BY l.n) AS body FROM m JOIN l ON l.rid = m.rid AND l.n BETWEEN m.n AND m.n + m.size - 1 GROUP BY ALL),
c AS (SELECT rid, n, size, row_number() OVER (PARTITION BY body ORDER BY rid, n) AS copy FROM w),
g AS (SELECT DISTINCT rid, unnest(range(n, n + size)) AS n FROM c WHERE copy > 1),
r AS (SELECT rid, count(*) AS n_removed, string_agg(at_line, ',' ORDER BY at_line) AS removed FROM g JOIN l USING (rid, n) GROUP BY rid),
k AS (SELECT rid, sum(length(line)) + count(*) - 1 AS chars FROM (SELECT rid, at_line, ls[at_line + 1] AS line FROM (SELECT rid, ls, unnest(range(len(ls))) AS at_line FROM d)) x
  WHERE NOT EXISTS (SELECT 1 FROM g JOIN l USING (rid, n) WHERE l.rid = x.rid AND l.at_line = x.at_line) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_lines FROM l GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed_lines,
  CASE WHEN ls IS NULL THEN NULL ELSE coalesce(chars, 0) END::BIGINT AS kept_chars
FROM d LEFT JOIN t USING (rid) LEFT JOIN r USING (rid) LEFT JOIN k USING (rid)
"""

QUERIES = {"op9_line_dedup": op9_line_dedup}
ORACLES = {"op9_line_dedup": ORACLE}
