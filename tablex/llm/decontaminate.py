"""Benchmark decontamination: an FM-index for each shard of documents, searched backward for every benchmark window.

A window is ten consecutive words of an item; an item of fewer words is one window, an item without words
none. Benchmark items are taken in blocks of a bounded number of words, each broadcast by itself; a larger
benchmark means more passes, not a larger broadcast. Documents stay where they are: nothing is shuffled.

A shard is about a million words. Words that no window has can't be part of an occurrence, so they only end
runs; runs shorter than the shortest window are left out. NULL and empty texts have no words and are
clean. Repeated rows are treated alike; a NULL item id is written `null`. The document's columns named in
`keep` come back as they were.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablex.llm.batches import in_arrow
from tablex.llm.common import packed, table, unpacked
from tablex.llm.fmindex import FMIndex

WINDOW = 10
SHARD_WORDS = 1_000_000
#: Words of benchmark items in one broadcast: about 50 MB.
BLOCK_WORDS = 500_000
#: Bytes of text split into Python words at once.
PIECE_BYTES = 4_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Lower-cases A-Z and turns bytes outside words into blanks; all bytes beyond ASCII belong to words.
FOLD = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


@dataclass
class Phrases:
    vocabulary: dict[bytes, int]
    patterns: np.ndarray  # right-aligned word numbers
    lengths: np.ndarray
    item_of: np.ndarray  # items of each pattern, between `first` and the next
    first: np.ndarray
    items: list[str]


def phrases(rows: list[tuple[str, bytes]], window: int = WINDOW) -> Phrases:
    """Distinct windows of (item, text) rows."""
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[int]] = {}
    items: dict[str, int] = {}
    for item, text in rows:
        words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in text.translate(FOLD).split()]
        number = items.setdefault(item, len(items))
        for at in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(tuple(words[at : at + window]), set()).add(number)
    patterns = np.zeros((len(found), window), np.int32)
    for row, words in enumerate(found):
        patterns[row, window - len(words) :] = words
    lengths = np.array([len(w) for w in found], np.int64)
    owners = list(found.values())
    first = np.concatenate(([0], np.cumsum([len(o) for o in owners]))).astype(np.int64)
    return Phrases(vocabulary, patterns, lengths, np.array([i for o in owners for i in sorted(o)], np.int64), first, list(items))


def word_numbers(text: bytes | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    """Number of each word in the vocabulary, 0 for others; a long text is split piece by piece."""
    if not text:
        return np.zeros(0, np.int32)
    text, out, at = text.translate(FOLD), [], 0
    while at < len(text):
        stop = at + PIECE_BYTES
        if stop < len(text):
            stop = text.find(b" ", stop)
            stop = len(text) if stop < 0 else stop
        words = text[at:stop].split()
        out.append(np.fromiter(map(vocabulary.get, words, repeat(0)), np.int32, len(words)))
        at = stop
    return np.concatenate(out)


def search_shard(stream: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the stream, length, pattern) of every occurrence."""
    nothing = np.zeros(0, np.int64)
    if not len(p.lengths):
        return nothing, nothing, nothing
    known = np.concatenate(([0], (stream > 0).astype(np.int8), [0]))
    edges = np.diff(known)
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - begins >= p.lengths.min()
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return nothing, nothing, nothing
    sizes = ends - begins + 1  # one more for the end mark
    stops = np.cumsum(sizes)
    origin = np.arange(stops[-1]) - np.repeat(stops - sizes - begins, sizes)
    text = np.where(np.arange(stops[-1]) == np.repeat(stops - 1, sizes), 0, stream[np.minimum(origin, len(stream) - 1)])
    index = FMIndex(text, len(p.vocabulary))
    low, high = index.search(p.patterns, p.lengths)
    pattern = np.flatnonzero(low < high)
    counts = (high - low)[pattern]
    rows = np.repeat(low[pattern] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    pattern = np.repeat(pattern, counts)
    return origin[index.locate(rows)], p.lengths[pattern], pattern


def occurrences(texts: list[bytes | None], p: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """(words, merged spans of hit words, items) of each text, shard by shard."""
    out: list[tuple[int, list[tuple[int, int]], list[str]]] = []
    shard: list[np.ndarray] = []

    def flush():
        starts = np.cumsum([0] + [len(x) + 1 for x in shard])
        stream = np.zeros(starts[-1], np.int32)
        for at, x in zip(starts, shard):
            stream[at : at + len(x)] = x
        place, length, pattern = search_shard(stream, p)
        change = np.zeros(len(stream) + 1, np.int64)
        np.add.at(change, place, 1)
        np.add.at(change, place + length, -1)
        hit = np.diff(np.concatenate(([0], (np.cumsum(change) > 0).astype(np.int8))))
        begins, ends = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
        spans: dict[int, list[tuple[int, int]]] = {}
        for b, e, doc in zip(begins.tolist(), ends.tolist(), (np.searchsorted(starts, begins, "right") - 1).tolist()):
            spans.setdefault(doc, []).append((b - int(starts[doc]), e - int(starts[doc])))
        pairs = np.unique((np.searchsorted(starts, place, "right") - 1) * max(1, len(p.lengths)) + pattern)
        items: dict[int, set[str]] = {}
        for doc, which in zip((pairs // max(1, len(p.lengths))).tolist(), (pairs % max(1, len(p.lengths))).tolist()):
            items.setdefault(doc, set()).update(p.items[i] for i in p.item_of[p.first[which] : p.first[which + 1]])
        out.extend((len(x), spans.get(k, []), sorted(items.get(k, ()))) for k, x in enumerate(shard))
        shard.clear()

    for text in texts:
        shard.append(word_numbers(text, p.vocabulary))
        if sum(map(len, shard[-1:])) and sum(map(len, shard)) >= SHARD_WORDS:
            flush()
    if shard:
        flush()
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, stop in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((first, stop))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    words = [m.span() for m in WORD.finditer(text.translate({c: c + 32 for c in range(65, 91)}))]
    out, at = [], 0
    for first, stop in spans:
        out.append(text[at : words[first][0]])
        at = words[stop - 1][1]
    return "".join([*out, text[at:]])


FOUND = {
    "d_n_words": T.LongType(),
    "d_spans": T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("stop", T.LongType())])),
    "d_items": T.ArrayType(T.StringType()),
}
ARROW = {"d_n_words": pa.int64(), "d_spans": pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())])), "d_items": pa.list_(pa.string())}


def blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of about `block_words` words."""
    block, words = [], 0
    ids = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")), F.coalesce(F.col(text), F.lit("")))
    for item, body in ids.toLocalIterator():
        block.append((item, body.encode()))
        words += len(block[-1][1].translate(FOLD).split())
        if words >= block_words:
            yield block
            block, words = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, keep: list[str] | None = None, block_words: int = BLOCK_WORDS, cut: str | None = None) -> DataFrame:
    """The rows with d_n_words, d_spans (merged, in words from 0, `stop` behind the last) and d_items (sorted).

    `cut` names a further column: the text without the words of the spans. Input columns of these names are replaced.
    """
    spark = docs.sparkSession
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (*FOUND, "d_text", cut)]
    out = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("binary").alias("d_text"))
    kept = [f for f in docs.select(*[F.col(f"`{c}`") for c in keep]).schema]
    schema = T.StructType([*kept, T.StructField("d_text", T.BinaryType()), *[T.StructField(k, v) for k, v in FOUND.items()]])
    parts = [*blocks(items, item_id, item_text, block_words)] or [[]]
    for number, block in enumerate(parts, 1):
        shared = spark.sparkContext.broadcast(vars(phrases(block, window)))

        def search(batches, shared=shared, cutting=cut is not None and number == len(parts)):
            searched = Phrases(**shared.value)
            for batch in batches:
                found = occurrences(batch.column("d_text").to_pylist(), searched)
                if "d_spans" in batch.schema.names:
                    old = zip(batch.column("d_spans").to_pylist(), batch.column("d_items").to_pylist())
                    found = [(n, merged([*spans, *((s["first"], s["stop"]) for s in before)]), sorted({*items, *was})) for (n, spans, items), (before, was) in zip(found, old)]
                columns = {name: batch.column(name) for name in [f.name for f in kept] + ["d_text"]}
                if cutting and any(spans for _, spans, _ in found):
                    texts = [without(t.decode(), spans).encode() if spans else t for t, (_, spans, _) in zip(columns["d_text"].to_pylist(), found)]
                    columns["d_text"] = pa.array(texts, pa.binary())
                columns["d_n_words"] = pa.array([n for n, _, _ in found], ARROW["d_n_words"])
                columns["d_spans"] = pa.array([[{"first": a, "stop": b} for a, b in spans] for _, spans, _ in found], ARROW["d_spans"])
                columns["d_items"] = pa.array([items for _, _, items in found], ARROW["d_items"])
                yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

        out = in_arrow(out, search, schema)
    return (out if cut is None else out.withColumn(cut, F.col("d_text").cast("string"))).drop("d_text")


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", n_chars: str = "n_chars", **kwargs) -> DataFrame:
    """The documents with hit words cut out; columns as given, rows none the fewer."""

    names = (text, n_chars) if n_chars in docs.columns else (text,)
    found = contaminated(packed(docs, *names), items, text=text, cut=text, **kwargs)
    if n_chars in docs.columns:
        length = F.length(text).cast(docs.schema[n_chars].dataType)
        found = found.withColumn(n_chars, F.when(F.size("d_spans") > 0, length).otherwise(F.col(n_chars)))
    return unpacked(found, docs.columns, names)


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = contaminated(docs.select("doc_id", "text"), items, keep=["doc_id"])
    n_hit = F.aggregate("d_spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    return found.select(
        "doc_id",
        F.col("d_n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("d_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("d_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("d_spans") > 0).alias("contaminated"),
    )


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
i AS (SELECT DISTINCT item_id, least({WINDOW}, len(ws)) AS n, array_to_string(ws[pos : pos + least({WINDOW}, len(ws)) - 1], ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - {WINDOW - 1}) + 1)) AS pos FROM b WHERE len(ws) > 0)),
p AS (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS pos FROM d, (SELECT DISTINCT n FROM i) WHERE len(ws) >= n),
h AS (SELECT rid, pos, i.n, item_id FROM p JOIN i ON p.n = i.n AND array_to_string(ws[pos : pos + p.n - 1], ' ') = phrase),
c AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(pos, pos + n)) AS place FROM h) GROUP BY rid),
k AS (SELECT rid, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT rid, item_id FROM h) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN k USING (rid)
"""

QUERIES = {"op5_decontaminate": op5_decontaminate}
ORACLES = {"op5_decontaminate": ORACLE}
