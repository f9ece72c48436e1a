"""Quality rules as a cascade: rules run cheapest rejection first, and a rejected text meets no later rule.

Counts and rules are built from Spark functions; a text is never split over rows. NULL and empty
texts have no words: they have zero counts and fail the word count. Repeated rows are judged alike.
Only the columns named are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablex.llm.common import BLANKS, blank_words, table
from tablex.session import stored

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3
#: Bits of a window's place in its sorting code; the other 34 hold a hash.
PLACE_BITS = 30
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """`rejects` maps (text, words) to true where the rule rejects; both are NULL for texts rejected before."""

    name: str
    rejects: Callable[[Column, Column], Column]


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, ""))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


RULES = [
    Rule("symbols", lambda text, words: F.regexp_count(text, F.lit(SYMBOLS)) * 4 > F.size(words)),
    Rule("word_length", lambda text, words: ~F.try_divide(word_chars(words), F.size(words)).between(2, 20)),
    Rule("capitals", lambda text, words: F.regexp_count(text, F.lit(r"\p{Lu}")) * 2 > word_chars(words)),
    Rule("few_letters", lambda text, words: F.regexp_count(text, F.lit(r"\p{L}")) * 2 < word_chars(words)),
    Rule("line_copies", lambda text, words: F.size(F.array_distinct(lines_with_words(text))) * 2 < F.size(lines_with_words(text))),
    Rule("shouts", lambda text, words: F.regexp_count(text, F.lit(r"[!?]{2}")) * 4 > F.size(words)),
]


def counted(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Adds `words` and the base counts, all named with `prefix`.

    n_repeat_words: every window of three words gets one long of 34 hash bits and its place; sorting
    the longs puts equal windows side by side. Those with a neighbour of equal hash are compared word
    by word, and the words under the windows that remain are counted once each.
    """
    p = prefix
    col = lambda name: F.col(f"`{p}{name}`")

    def code(word, i):
        words = col("words")
        h = F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2))
        return F.shiftleft(h, PLACE_BITS).bitwiseOR(i.cast("long"))

    def beside(array, same):
        return F.filter(array, lambda x, i: same(x, F.get(array, i - 1)) | same(x, F.get(array, i + 1)))

    body = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn(f"{p}words", blank_words(F.col(text)))
    lines = lines_with_words(body)
    out = out.withColumns(
        {
            f"{p}n_words": F.size(col("words")).cast("long"),
            f"{p}word_chars": word_chars(col("words")).cast("long"),
            f"{p}n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
            f"{p}lines": lines,
            f"{p}codes": F.sort_array(F.transform(F.slice(col("words"), 1, F.greatest(F.size(col("words")) - (WINDOW - 1), F.lit(0))), code)),
        }
    )
    out = out.withColumns(
        {
            f"{p}n_dup_lines": (F.size(col("lines")) - F.size(F.array_distinct(col("lines")))).cast("long"),
            f"{p}codes": beside(col("codes"), lambda a, b: F.coalesce(F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS), F.lit(False))),
        }
    )
    place = F.lit((1 << PLACE_BITS) - 1)
    window = lambda at: [F.get(col("words"), at + k).alias(f"w{k}") for k in range(WINDOW)]
    out = out.withColumn(f"{p}codes", F.transform(col("codes"), lambda c: F.struct(F.struct(*window(c.bitwiseAND(place).cast("int"))).alias("w"), c.bitwiseAND(place).cast("int").alias("at"))))
    out = out.withColumn(f"{p}codes", F.sort_array(col("codes")))
    out = out.withColumn(f"{p}codes", beside(col("codes"), lambda a, b: F.coalesce(a["w"] == b["w"], F.lit(False))))
    out = out.withColumn(f"{p}codes", F.sort_array(F.transform(col("codes"), lambda c: c["at"])))
    gaps = F.transform(col("codes"), lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(col("codes"), i + 1) - at, F.lit(WINDOW))))
    out = out.withColumn(f"{p}n_repeat_words", F.aggregate(gaps, F.lit(0), lambda total, g: total + g).cast("long"))
    return out.drop(f"{p}codes", f"{p}lines")


def cascade(df: DataFrame, rules: list[Rule], text: str, words: str, alive: Column, verdict: str) -> DataFrame:
    """Adds `verdict`: the first rule, in the order given, that rejects the text; NULL if none does or `alive` is false."""
    out = df.withColumn(verdict, F.when(alive, F.lit(None).cast("string")).otherwise(F.lit("")))
    for rule in rules:
        going = F.col(verdict).isNull()
        now = F.when(going & rule.rejects(F.col(text), F.col(words)), F.lit(rule.name)).otherwise(F.col(verdict))
        out = out.withColumn(verdict, now)
    return out.withColumn(verdict, F.nullif(F.col(verdict), F.lit("")))


def ordered_rules(df: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = 2000, seed: int = 7) -> list[tuple[Rule, float, float]]:
    """(rule, share rejected, seconds per row), most rejections per second first, measured on about `sample_rows` rows.

    The order changes what a run costs, never which texts are kept: a text is kept if no rule rejects it.
    """
    total = df.count()
    share = 1.0 if total <= sample_rows else sample_rows / total
    sample = stored(df.sample(share, seed).select(F.coalesce(F.col(text), F.lit("")).alias("text"), blank_words(F.col(text)).alias("words")), "rules")
    rejects = [F.coalesce(r.rejects(F.col("text"), F.col("words")), F.lit(False)) for r in rules]
    found = sample.agg(F.count("*"), *[F.coalesce(F.sum(c.cast("long")), F.lit(0)) for c in rejects]).first()  # warms the code, too
    rows, measured = max(1, found[0]), []
    for k, (rule, c) in enumerate(zip(rules, rejects)):
        begin = time.perf_counter()
        sample.select(c.alias("rejected")).write.format("noop").mode("overwrite").save()
        measured.append((rule, found[k + 1] / rows, (time.perf_counter() - begin) / rows))
    return sorted(measured, key=lambda m: -m[1] / m[2])


def quality_rules(df: DataFrame, text: str = "text", rules: list[Rule] | None = None, sample_rows: int = 2000, prefix: str = "q_") -> DataFrame:
    """The rows with `<prefix>` n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and rejected_by."""
    p = prefix
    order = [r for r, _, _ in ordered_rules(df, rules or RULES, text, sample_rows)]
    out = counted(df, text, p)
    n, repeated = F.col(f"{p}n_words"), F.col(f"{p}n_repeat_words")
    out = out.withColumn(f"{p}base_failed", (n < MIN_WORDS) | (repeated * 100 > n * MAX_REPEATED_PERCENT))
    out = cascade(out, order, text, f"{p}words", ~F.col(f"{p}base_failed"), f"{p}rejected_by")
    return out.withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & F.col(f"{p}rejected_by").isNull()).drop(f"{p}words")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules(table(spark, folder, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select("doc_id", *[F.col(f"q_{n}").alias(n) for n in names])


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '{BLANKS}'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS c FROM p),
r AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place FROM g WHERE c > 1) GROUP BY rid),
b AS (SELECT doc_id, t, ls, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        len(regexp_extract_all(t, '{SYMBOLS}')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r USING (rid)),
f AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEATED_PERCENT} AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    n_symbols * 4 > n_words
    OR NOT (word_chars / n_words BETWEEN 2 AND 20)
    OR len(regexp_extract_all(t, '\p{{Lu}}')) * 2 > word_chars
    OR len(regexp_extract_all(t, '\p{{L}}')) * 2 < word_chars
    OR len(list_distinct(ls)) * 2 < len(ls)
    OR len(regexp_extract_all(t, '[!?]{{2}}')) * 4 > n_words) AS kept
FROM f
"""

QUERIES = {"op4_quality_rules": op4_quality_rules}
ORACLES = {"op4_quality_rules": ORACLE}
