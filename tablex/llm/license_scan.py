"""License scan by diagonal voting: all word 4-grams of a text meet the 4-grams of license notices in a join.

A match of text place p and notice place t votes for the diagonal p - t. Votes are counted for each text,
notice and diagonal before they are shuffled; diagonals up to `SHIFT` apart are merged, which allows for words put
in or left out; a merged span holds the notice if its 4-grams cover at least `COVER` of the notice's words and
it is not much longer than the notice. Phrases are found exactly beside this, as places where their words
stand consecutively.

NULL and empty texts have no words and no labels. Rows alike in id and text give the same result. Only the id
and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablex.llm.common import letter_words, table

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Customary notices of public licenses, and their labels.
NOTICES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-file": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under a creative commons attribution sharealike 4 0 international license",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
GRAM = 4
SHIFT = 3
COVER = 0.8
STRETCH = 1.25
#: Notices of up to so many words in all (about 2 MB of 4-grams) are broadcast; Spark chooses beyond.
BROADCAST_WORDS = 50_000


def gram_hashes(words: Column) -> Column:
    """Hash of the 4-gram at each word that begins one."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (GRAM - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, GRAM)]))


def notice_grams(spark: SparkSession, notices: dict[str, str]) -> DataFrame:
    """(s_gram, s_notice, s_place, s_length) of every notice."""
    df = spark.createDataFrame([*notices.items()], "s_notice string, text string")
    df = df.select("s_notice", letter_words(F.col("text")).alias("words"))
    grams = df.select("s_notice", F.size("words").alias("s_length"), F.posexplode(gram_hashes(F.col("words"))).alias("s_place", "s_gram"))
    return F.broadcast(grams) if sum(len(t.split()) for t in notices.values()) <= BROADCAST_WORDS else grams


def phrase_places(words: Column, phrases: dict[str, str]) -> Column:
    """(at, label) of each place where a phrase stands."""

    def at(word, i):
        found = F.lit(None).cast("string")
        for phrase, label in phrases.items():
            first, *rest = phrase.split()
            here = word == first
            for k, w in enumerate(rest, 1):
                here = here & (F.get(words, i + k) == w)
            found = F.coalesce(F.when(here, F.lit(label)), found)
        return F.when(found.isNotNull(), F.struct(i.alias("at"), found.alias("label")))

    return F.filter(F.transform(words, at), lambda x: x.isNotNull())


def spans(docs: DataFrame, doc_id: str, text: str, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(s_id, s_text_hash, s_notice, s_first, s_stop, s_cover): the merged spans of every text and notice, verified or not."""
    words = docs.select(F.col(doc_id).alias("s_id"), F.xxhash64(text).alias("s_text_hash"), letter_words(F.col(text)).alias("s_words"))
    grams = words.select("s_id", "s_text_hash", F.posexplode(gram_hashes(F.col("s_words"))).alias("s_at", "s_gram"))
    votes = grams.join(notice_grams(docs.sparkSession, notices), "s_gram").withColumn("s_diagonal", F.col("s_at") - F.col("s_place"))
    key = ["s_id", "s_text_hash", "s_notice"]
    lines = votes.groupBy(*key, "s_length", "s_diagonal").agg(F.min("s_at").alias("s_first"), F.max("s_at").alias("s_last"), F.collect_set("s_place").alias("s_places"))
    order = Window.partitionBy(*key).orderBy("s_diagonal")
    jump = F.coalesce((F.col("s_diagonal") - F.lag("s_diagonal").over(order) > SHIFT).cast("int"), F.lit(0))
    lines = lines.withColumn("s_jump", jump).withColumn("s_run", F.sum("s_jump").over(order))
    runs = lines.groupBy(*key, "s_length", "s_run").agg(
        F.min("s_first").alias("s_first"),
        (F.max("s_last") + GRAM).alias("s_stop"),
        F.array_distinct(F.flatten(F.collect_list("s_places"))).alias("s_places"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("s_places", lambda p: F.sequence(p, p + (GRAM - 1))))))
    return runs.select(*key, "s_length", "s_first", "s_stop", (covered / F.col("s_length")).alias("s_cover"))


def licensed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(doc_id, s_n_words, s_places, s_labels, s_cover): phrase places, labels of verified notices, best cover of any span."""
    words = docs.select(F.col(doc_id), F.xxhash64(text).alias("s_hash"), letter_words(F.col(text)).alias("s_words"))
    base = words.select(doc_id, "s_hash", F.size("s_words").cast("long").alias("s_n_words"), phrase_places(F.col("s_words"), phrases).alias("s_places"))
    holds = (F.col("s_cover") >= COVER) & (F.col("s_stop") - F.col("s_first") <= F.col("s_length") * STRETCH)
    found = spans(docs, doc_id, text, notices).groupBy("s_id", "s_text_hash").agg(F.collect_set(F.when(holds, F.col("s_notice"))).alias("s_labels"), F.max("s_cover").alias("s_cover"))
    joined = base.join(found, F.col(doc_id).eqNullSafe(F.col("s_id")) & (F.col("s_hash") == F.col("s_text_hash")), "left")
    return joined.select(doc_id, "s_n_words", "s_places", F.coalesce("s_labels", F.array().cast("array<string>")).alias("s_labels"), F.coalesce("s_cover", F.lit(0.0)).alias("s_cover"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licensed(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.array_distinct(F.col("s_places.label"))
    return found.select(
        "doc_id",
        F.col("s_n_words").alias("n_words"),
        F.size("s_places").cast("long").alias("n_base"),
        F.array_min("s_places.at").cast("long").alias("first_word"),
        F.array_max("s_places.at").cast("long").alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, "s_labels")), ",").alias("labels"),
        F.when(F.size("s_places") > 0, 1.0).otherwise(F.col("s_cover")).alias("score"),
    )


_FOLD = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_FOLD} AS ws FROM documents),
n AS (SELECT notice, string_split(body, ' ') AS ws FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in NOTICES.items())}) v(notice, body)),
g AS (SELECT notice, len(ws) AS size, place - 1 AS place, array_to_string(ws[place : place + {GRAM - 1}], ' ') AS gram FROM (SELECT notice, ws, unnest(range(1, len(ws) - {GRAM - 2})) AS place FROM n)),
p AS (SELECT rid, pos - 1 AS pos, array_to_string(ws[pos : pos + {GRAM - 1}], ' ') AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - {GRAM - 2})) AS pos FROM d)),
v AS (SELECT rid, notice, size, pos, place, pos - place AS diagonal FROM p JOIN g USING (gram)),
l AS (SELECT DISTINCT rid, notice, diagonal FROM v),
j AS (SELECT *, sum(CASE WHEN diagonal - before > {SHIFT} THEN 1 ELSE 0 END) OVER (PARTITION BY rid, notice ORDER BY diagonal) AS run
  FROM (SELECT *, lag(diagonal) OVER (PARTITION BY rid, notice ORDER BY diagonal) AS before FROM l)),
r AS (SELECT rid, notice, size, run, min(pos) AS first, max(pos) + {GRAM} AS stop FROM v JOIN j USING (rid, notice, diagonal) GROUP BY ALL),
c AS (SELECT rid, notice, run, count(DISTINCT word) AS covered FROM (SELECT rid, notice, run, unnest(range(place, place + {GRAM})) AS word FROM v JOIN j USING (rid, notice, diagonal)) GROUP BY ALL),
s AS (SELECT rid, max(covered / size) AS cover, list(DISTINCT notice) FILTER (covered / size >= {COVER} AND stop - first <= size * {STRETCH}) AS labels FROM r JOIN c USING (rid, notice, run) GROUP BY rid),
f AS (SELECT rid, pos - 1 AS pos, label FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS pos FROM d)
  JOIN (VALUES {", ".join(f"('{k}', '{v}')" for k, v in PHRASES.items())}) h(phrase, label) ON array_to_string(ws[pos : pos + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
b AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM f GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(b.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, s.labels))), ','), '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(cover, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN s USING (rid)
"""

QUERIES = {"op3_license_scan": op3_license_scan}
ORACLES = {"op3_license_scan": ORACLE}
