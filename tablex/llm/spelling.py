"""Spelling variants: words one edit apart, each led to its most frequent neighbour and on to the root of its chain.

Words are counted in the JVM. Two words of one edit agree in a half of their letters: where the edit lies behind the first
half of the shorter word, both begin with it, and else both end with its second half. So every word takes part in blocks
named by a half: those of its own length, where it may be the shorter or an equal partner, and those of the length
below, where it is the longer one. Within a block of two adjacent lengths, a Gram matrix of letter counts, a numpy product,
gives the squared distance of all pairs at once: one edit changes it by two at most (a letter replaced) or one (a letter
more). Pairs that near are held against each other letter by letter. No pair is lost and none is found twice.

Small blocks go through numpy many at a time. A block of more than `TILE` words is cut into tiles by a hash of the word, and
each pair of tiles is a group of its own, dealt out like a block: no task holds more than two tiles at once. Groups
give each word its number of neighbours and its best one, not the pairs; these are merged by Spark.

A word's form has at least twice its count, so chains of forms end after log2 of the largest count; roots are found by
pointer jumping, each round on a stored table.

NULL and empty texts have no words. A NULL id counts as an empty one in the hash that deletes a letter. Rows alike count
each. Ties of counts go to the smaller word in code-point order. An empty table gives an empty one. Columns but the id and the
text are not read, so their names can't clash. A word of any length is compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablex.llm.batches import in_arrow
from tablex.llm.common import LOWER, UPPER, table
from tablex.session import stored

#: A letter is deleted from every run whose hash this divides; the least length and count of a word.
THINNED, LETTERS, TIMES = 97, 5, 3
#: A form has at least so many times its word's occurrences.
AHEAD = 2
#: Words of a block that are compared in one product; larger blocks are cut into tiles.
TILE = 1024
#: Small blocks are put together up to so many words, and to so many letters of padded words.
TOGETHER, PADDED = 256, 1 << 22

# Letters of words are a-z and the code points C0 to FF, one byte each in Latin-1.
LETTER = "a-zÀ-ÿ"
_COLUMN = np.full(256, 0, np.int64)
_COLUMN[ord("a") : ord("z") + 1] = np.arange(26)
_COLUMN[0xC0:] = np.arange(26, 90)
COLUMNS = 90


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", thinned: int = THINNED, letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """(word, n): lower-cased words of enough letters and occurrences; hash-chosen runs of a document lose one letter."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("v_id"), F.explode(F.split(low, f"[^{LETTER}]+")).alias("v_run"))
    runs = runs.where(F.length("v_run") >= letters)
    hashed = F.crc32(F.concat_ws(":", "v_id", "v_run").cast("binary"))
    length = F.length("v_run")
    gone = F.pmod(F.col("v_hash"), length).cast("int")  # code points before the one deleted
    thin = F.concat(F.substr("v_run", F.lit(1), gone), F.substr("v_run", gone + 2, length))
    word = F.when(F.col("v_hash") % thinned == 0, thin).otherwise(F.col("v_run"))
    found = runs.withColumn("v_hash", hashed).select(word.alias("word")).where(F.length("word") >= letters)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def memberships(counted: DataFrame, tile: int = TILE) -> DataFrame:
    """(v_length, v_side, v_half, v_i, v_j, word, n, v_tile): every group of blocks that a word takes part in.

    v_length is the shorter length of the block. A block within one tile has v_i = v_j = 0.
    """
    size = F.length("word")
    # The block of length L cuts its half after L // 2 letters at the start, and before the other L - L // 2 at the end.
    kinds = F.array(*[F.struct(F.lit(longer).alias("longer"), F.lit(side).alias("side")) for longer in (0, 1) for side in (0, 1)])
    rows = counted.withColumn("v_kind", F.explode(kinds)).withColumn("v_length", size - F.col("v_kind.longer"))
    first = F.floor(F.col("v_length") / 2).cast("int")
    half = F.when(F.col("v_kind.side") == 0, F.substr("word", F.lit(1), first)).otherwise(F.substr("word", size - F.col("v_length") + first + 1, size))
    rows = rows.select("word", "n", "v_length", F.col("v_kind.side").alias("v_side"), half.alias("v_half"))
    key = ["v_length", "v_side", "v_half"]
    large = stored(rows.groupBy(*key).agg(F.count("*").alias("v_size")).where(F.col("v_size") > tile), "large_blocks")
    tiles = F.coalesce(F.ceil(F.col("v_size") / tile).cast("int"), F.lit(1))
    placed = rows.join(large, key, "left").withColumn("v_tiles", tiles)
    placed = placed.withColumn("v_tile", F.pmod(F.xxhash64("word"), F.col("v_tiles")).cast("int"))
    placed = placed.withColumn("v_other", F.explode(F.sequence(F.lit(0), F.col("v_tiles") - 1)))
    return placed.select(*key, F.least("v_tile", "v_other").alias("v_i"), F.greatest("v_tile", "v_other").alias("v_j"), "word", "n", "v_tile")


def letter_matrix(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(letters of each word, padded with zeros; letter counts)."""
    sizes = np.array([len(r) for r in raw])
    flat = np.frombuffer(b"".join(raw), np.uint8)
    row = np.repeat(np.arange(len(raw)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text = np.zeros((len(raw), int(sizes.max(initial=0)) + 1), np.uint8)
    text[row, place] = flat
    counts = np.bincount(row * COLUMNS + _COLUMN[flat], minlength=len(raw) * COLUMNS)
    return text, counts.reshape(len(raw), COLUMNS)


def one_edit(x: np.ndarray, y: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Is each word of y that of x with one letter replaced or, where `longer`, with one letter more? Padded letters."""
    same = x == y
    alike = same.sum(axis=1)
    head = np.where(same.all(axis=1), x.shape[1], same.argmin(axis=1))  # letters before the first that differs
    shifted = x[:, :-1] == y[:, 1:]
    tail = np.arange(x.shape[1] - 1)[None, :] >= head[:, None]
    return np.where(longer, (shifted | ~tail).all(axis=1), alike == x.shape[1] - 1)


def neighbours(raw: list[bytes], key: np.ndarray, length: np.ndarray, side: np.ndarray, tile: np.ndarray, crossed: np.ndarray, most: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs (shorter or equal, other) one edit apart within a block. Rows of a block share their key.

    side 1 leaves out pairs that side 0 has. Where `crossed`, a pair of different tiles is wanted.
    """
    sizes = np.array([len(r) for r in raw])
    text, counts = letter_matrix(raw)
    exact = np.float64 if sizes.max(initial=0) > 1000 else np.float32
    vectors = counts.astype(exact)
    norm = (vectors * vectors).sum(axis=1)
    lefts, rights = [], []
    short = np.flatnonzero(sizes == length)
    for at in range(0, len(short), TOGETHER):
        part = short[at : at + TOGETHER]
        distance = norm[part][:, None] + norm[None, :] - 2 * (vectors[part] @ vectors.T)
        near = (distance <= 2) & (key[part][:, None] == key[None, :])
        i, j = np.nonzero(near)
        i = part[i]
        longer = sizes[j] > sizes[i]
        right = (longer | (i < j)) & (~crossed[i] | (tile[i] != tile[j]))
        i, j, longer = i[right], j[right], longer[right]
        for start in range(0, len(i), max(1, most * 64 // text.shape[1])):
            a, b, more = (v[start : start + max(1, most * 64 // text.shape[1])] for v in (i, j, longer))
            keep = one_edit(text[a], text[b], more)
            begin = length[a] // 2
            cover = np.arange(text.shape[1])[None, :] >= begin[:, None]
            keep &= (side[a] == 0) | ~((text[a] == text[b]) | cover).all(axis=1)
            lefts.append(a[keep])
            rights.append(b[keep])
    none = np.zeros(0, np.int64)
    return np.concatenate(lefts or [none]), np.concatenate(rights or [none])


def packs(batches) -> Iterator[pa.Table]:
    """Whole groups of rows, small ones together; rows come sorted by group."""
    rest = None
    for batch in batches:
        got = pa.Table.from_batches([batch])
        rest = got if rest is None else pa.concat_tables([rest, got])
        group = group_numbers(rest)
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        long = rest.column("v_length").to_numpy()
        first = 0
        for k, end in enumerate(starts[1:]):
            after = starts[k + 2] if k + 2 < len(starts) else rest.num_rows
            if after - starts[first] > TOGETHER or (after - starts[first]) * (int(long[after - 1]) + 2) > PADDED:
                yield rest.slice(starts[first], end - starts[first])
                first = k + 1
        rest = rest.slice(starts[first]) if len(starts) else rest
    if rest is not None and rest.num_rows:
        yield rest


def group_numbers(rows: pa.Table) -> np.ndarray:
    """The number of each row's group, from 0; groups are runs of equal keys."""
    change = np.zeros(rows.num_rows, bool)
    for name in ("v_length", "v_side", "v_i", "v_j"):
        values = rows.column(name).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    halves = np.array(rows.column("v_half").to_pylist(), object)
    change[1:] |= halves[1:] != halves[:-1]
    return np.cumsum(change)


def summed(pack: pa.Table) -> pa.RecordBatch:
    """(word, v_near, v_best): of each word with neighbours in the pack, their number and the best of them."""
    names, n = pack.column("word").to_pylist(), pack.column("n").to_numpy()
    i, j = pack.column("v_i").to_numpy(), pack.column("v_j").to_numpy()
    a, b = neighbours([w.encode("latin-1") for w in names], group_numbers(pack), pack.column("v_length").to_numpy(), pack.column("v_side").to_numpy(), pack.column("v_tile").to_numpy(), i != j)
    of, near = np.concatenate((a, b)), np.concatenate((b, a))
    rank = np.empty(len(names), np.int64)
    rank[np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)] = np.arange(len(names))
    order = np.lexsort((rank[near], -n[near], of))
    of, near = of[order], near[order]
    first = np.flatnonzero(np.diff(of, prepend=-1)) if len(of) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(of)))
    best = near[first]
    values = [pa.array([names[k] for k in of[first]], pa.string()), pa.array(count, pa.int64()), pa.array(-n[best], pa.int64()), pa.array([names[k] for k in best], pa.string())]
    return pa.RecordBatch.from_arrays(values, names=["word", "v_near", "v_minus", "v_form"])


def near_words(counted: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, form, form_n) of the words with neighbours: how many, and the one of the largest count."""
    key = ["v_length", "v_side", "v_half", "v_i", "v_j"]
    rows = memberships(counted, tile).repartition(*key).sortWithinPartitions(*key)

    def compare(batches):
        for pack in packs(batches):
            yield summed(pack)

    found = in_arrow(rows, compare, "word string, v_near long, v_minus long, v_form string")
    best = found.groupBy("word").agg(F.sum("v_near").alias("n_near"), F.min(F.struct("v_minus", "v_form")).alias("v_best"))
    return best.select("word", "n_near", F.col("v_best.v_form").alias("form"), (-F.col("v_best.v_minus")).alias("form_n"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ahead: int = AHEAD, tile: int = TILE, **kwargs) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    counted = stored(words(docs, doc_id, text, **kwargs), "words")
    joined = counted.join(near_words(counted, tile), "word", "left")
    led = F.coalesce(F.col("form_n") >= ahead * F.col("n"), F.lit(False))
    found = joined.select("word", F.when(led, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(led, F.col("form_n")).alias("form_n"))
    found = stored(found, "forms")
    # Only words with a form have anywhere to go; each round doubles the steps of the chain behind a root.
    ways = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        hop = ways.select(F.col("word").alias("v_at"), F.col("root").alias("v_next"))
        jumped = stored(ways.join(hop, ways["root"] == hop["v_at"], "left").select("word", F.coalesce("v_next", "root").alias("root"), F.col("v_next").isNotNull().alias("v_moved")), "roots")
        ways = jumped.select("word", "root")
        if not jumped.where("v_moved").head(1):
            break
    return found.join(ways, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES = {"op12_spelling_variants": op12_spelling_variants}
ORACLES: dict[str, str] = {}
