"""Near duplicates by Order MinHash: sketches keep the text order of several smallest occurrence-labelled shingles.

Shingles are runs of five words, marked by their occurrence. Each of `BANDS` sketches of a text takes the `KEPT`
shingles smallest under its own hash and joins them in text order, so texts share a sketch about as likely
as they are close in edits. Equal texts (word for word) are one node from the start. In every bucket of
equal sketches, each text is compared to one leader first; where a bucket still has several classes, its texts meet
a few leaders that have not led yet in each later round, as long as rounds link a tenth of their pairs. Texts of buckets still open then are joined by
their rarest shingles, so every pair of a bucket is in one class, verified, or certain to be below the threshold.

Two texts are linked if a banded alignment of their shingles keeps at least 0.8 of them: aligned in order and
divided by all shingles of both. An alignment of that quality can't leave the band of (n1 + n2) / 9 places, so
the band loses nothing. Occurrence labels serve the sketches; where they overlap enough but don't align, the shingles
without labels are aligned, for an edit in a repeated passage shifts the labels of its later repeats. Classes are the connected components of the links; a class goes by its smallest id.

Texts without words (NULL, empty) are classes of their own kind: each keeps its own id. A NULL id counts as larger
than all others; a class of NULL ids has a NULL id. Rows alike in id and text are copies.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablex.llm.batches import in_arrow
from tablex.llm.common import packed, table, unpacked
from tablex.llm.shingles import SHINGLE, WordHasher, marked, mix, odd, plain_shingles, text_keys
from tablex.session import stored

BANDS = 20
KEPT = 5
SIMILAR = 0.8
#: Texts of so many shingles at most meet surely: sketches alone would lose pairs of 4 and 5.
SHORT = 10
#: Leaders of a bucket in each round after the first, which has one: by then few buckets are open.
LEADERS = 4
#: Most rounds with leaders, and the share of pairs a round must link to be followed by another; what is open then is joined by rare shingles.
ROUNDS, FRUITFUL = 5, 0.1
#: Slots of the counts by which shingles are ordered from rare to frequent; their array is broadcast.
SLOTS = 1 << 20
#: Texts of so many bytes are sketched at once.
TOGETHER = 2_000_000


def sketches(values: np.ndarray, bands: int = BANDS, kept: int = KEPT) -> np.ndarray:
    """One hash per band of the `kept` smallest values, in text order."""
    factors, weights = odd(17, bands), odd(19, kept)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    out, wide = np.empty(bands, np.uint64), max(1, 4_000_000 // n)
    for at in range(0, bands, wide):
        part = factors[at : at + wide, None] * values[None, :]
        if n > kept:
            best = np.sort(np.argpartition(part, kept, axis=1)[:, :kept], axis=1)
        else:
            best = np.broadcast_to(np.arange(n), (len(part), n))
        chosen = values[best]
        out[at : at + wide] = mix((chosen * weights[: chosen.shape[1]]).sum(axis=1, dtype=np.uint64))
    return out


def short_keys(plain: np.ndarray) -> np.ndarray:
    """Hashes of a short text's shingles in order, with all sets left out that a similar text may lack; similar short texts share one."""
    n, weights = len(plain), odd(23, SHORT)
    if n > SHORT:
        return np.zeros(0, np.uint64)
    rests = [np.delete(plain, out) for k in range(int(n * (1 - SIMILAR) + 1e-9) + 1) for out in combinations(range(n), k)]
    return np.unique(mix(np.array([(r * weights[: len(r)]).sum(dtype=np.uint64) + np.uint64(len(r)) for r in rests])))


def aligned(x: np.ndarray, y: np.ndarray, similar: float = SIMILAR, plain: tuple[np.ndarray, np.ndarray] | None = None) -> float:
    """Share of the shingles of both texts that a banded alignment keeps; 0 if they can't reach `similar`.

    x and y are marked by occurrence, `plain` is unmarked. An edit in a repeated passage shifts the marks of its later
    repeats, so where marked shingles overlap enough but don't align, the plain ones are aligned.
    """
    n1, n2 = len(x), len(y)
    if not n1 or not n2 or min(n1, n2) < similar * max(n1, n2):
        return 0.0
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    need = similar * (n1 + n2) / (1 + similar)
    if len(i) < need - 1e-9:  # as many as the plain ones have in common, in any order
        return 0.0
    band = n1 + n2 - 2 * need + 1e-6
    inside = np.abs(i - j) <= band
    i, j = i[inside], j[inside]
    j = j[np.argsort(i)]
    kept = len(j)
    if (np.diff(j) <= 0).any():  # the longest rising part is what can be aligned
        tails: list[int] = []
        for v in j.tolist():
            k = bisect_left(tails, v)
            tails[k : k + 1] = [v]
        kept = len(tails)
    if kept < need - 1e-9 and plain is not None:
        kept = in_band(*plain, int(band))
    return kept / (n1 + n2 - kept)


def in_band(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """Longest common subsequence of elements at most `band` places apart (or a few more), a row of the table at a time as bits."""
    short = min(len(x), len(y))
    differ = x[:short] != y[:short]
    head = int(differ.argmax()) if differ.any() else short
    differ = x[len(x) - short + head :][::-1] != y[len(y) - short + head :][::-1]
    tail = int(differ.argmax()) if differ.any() else short - head
    xs, ys = x[head : len(x) - tail].tolist(), y[head : len(y) - tail].tolist()
    kept, low, high, row, step = head + tail, 0, 0, 0, max(64, band // 2)
    for at in range(0, len(xs), step):
        # Bits are places of y from `low` on; a cleared one is a place where the row's length grows by one.
        after = max(low, min(len(ys), at - band))
        gone = min(after, high) - low
        kept += gone - (row & ((1 << gone) - 1)).bit_count()
        row, low, until = row >> gone, after, max(high, min(len(ys), at + step + band))
        row |= ((1 << (until - max(high, low))) - 1) << (max(high, low) - low)
        high, full = until, (1 << (until - low)) - 1
        places: dict[int, int] = {}
        part = set(xs[at : at + step])
        for k, v in enumerate(ys[low:high]):
            if v in part:
                places[v] = places.get(v, 0) | 1 << k
        for v in xs[at : at + step]:
            if hit := row & places.get(v, 0):
                row = ((row + hit) | (row - hit)) & full
    return kept + (high - low) - row.bit_count()


def groups(texts: list[bytes | None]):
    """Ranges of texts of about TOGETHER bytes."""
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t or b"")
        if size >= TOGETHER:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(n_id, n_raw, n_raw_check, n_words, n_key, n_sketches) of every row; n_key is NULL for a text without words."""
    raw = docs.select(F.col(doc_id).alias("n_id"), F.xxhash64(text).alias("n_raw"), F.hash(text).alias("n_raw_check"), F.col(text).cast("binary").alias("n_text"))

    def sketch(batches):
        hasher = WordHasher()
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = batch.column("n_text").to_pylist()
                sizes, names, marks = [], [], []
                for a, b in groups(texts):
                    words, first = hasher.words(texts[a:b])
                    plain, starts = plain_shingles(words, first)
                    values = marked(plain, starts)
                    keys = text_keys(words, first).view(np.int64).tolist()
                    counts = np.diff(first).tolist()
                    sizes += counts
                    names += [{"a": k[0], "b": k[1]} if n else None for n, k in zip(counts, keys)]
                    parts = [slice(starts[k], starts[k + 1]) for k in range(b - a)]
                    marks += [np.concatenate((sketches(values[p]), short_keys(plain[p]) if counts[k] else plain[p])).view(np.int64) for k, p in enumerate(parts)]
                columns = [batch.column(c) for c in ("n_id", "n_raw", "n_raw_check")]
                key = pa.array(names, pa.struct([("a", pa.int64()), ("b", pa.int64())]))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), key, pa.array(marks, pa.list_(pa.int64()))], names=["n_id", "n_raw", "n_raw_check", "n_words", "n_key", "n_sketches"])

    kind = raw.schema["n_id"].dataType.simpleString()
    return in_arrow(raw, sketch, f"n_id {kind}, n_raw long, n_raw_check int, n_words long, n_key struct<a: long, b: long>, n_sketches array<long>")


def verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """(n_a, n_b) of the pairs whose texts are similar."""
    left = texts.select(F.col("n_key").alias("n_a"), F.col("n_text").alias("n_left"))
    right = texts.select(F.col("n_key").alias("n_b"), F.col("n_text").alias("n_right"))
    both = pairs.join(left, "n_a").join(right, "n_b").select("n_a", "n_b", "n_left", "n_right")

    def compare(batches):
        hasher = WordHasher()
        with np.errstate(over="ignore"):
            for batch in batches:
                left, right, keep = batch.column("n_left").to_pylist(), batch.column("n_right").to_pylist(), []
                for a, b in groups([x + y for x, y in zip(left, right)]):
                    distinct = {t: k for k, t in enumerate(dict.fromkeys([*left[a:b], *right[a:b]]))}
                    plain, starts = plain_shingles(*hasher.words([*distinct]))
                    values = marked(plain, starts)
                    of = lambda t, h: h[starts[distinct[t]] : starts[distinct[t] + 1]]  # noqa: B023, E731
                    keep += [aligned(of(x, values), of(y, values), similar, (of(x, plain), of(y, plain))) >= similar for x, y in zip(left[a:b], right[a:b])]
                yield pa.RecordBatch.from_arrays([batch.column("n_a"), batch.column("n_b")], names=["n_a", "n_b"]).filter(pa.array(keep, pa.bool_()))

    key = "struct<a: long, b: long>"
    return in_arrow(both, compare, f"n_a {key}, n_b {key}")


def rare_pairs(open_texts: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """(n_a, n_b) of texts of different classes that share one of their rarest shingles; all other pairs are below `similar`.

    Of n shingles, a similar text shares at least similar * n, so one of any n - similar * n + 1. The rarest are taken
    here, and a pair is kept where the shingles from the shared one on suffice.
    """

    def mark(batches):
        hasher = WordHasher()
        with np.errstate(over="ignore"):
            for batch in batches:
                texts, marks = batch.column("n_text").to_pylist(), []
                for a, b in groups(texts):
                    plain, starts = plain_shingles(*hasher.words(texts[a:b]))
                    values = marked(plain, starts).view(np.int64)
                    marks += [values[starts[k] : starts[k + 1]] for k in range(b - a)]
                yield pa.RecordBatch.from_arrays([batch.column("n_key"), batch.column("n_class"), pa.array(marks, pa.list_(pa.int64()))], names=["n_key", "n_class", "n_marks"])

    key = "struct<a: long, b: long>"
    found = in_arrow(open_texts.join(texts, "n_key").select("n_key", "n_class", "n_text"), mark, f"n_key {key}, n_class {key}, n_marks array<long>")
    found = stored(found, "marks")
    # Any order of all shingles will do, as long as it is one; counts by slot make it one of rarity, in an array of fixed size.
    slots = found.select(F.explode("n_marks").alias("n_mark")).groupBy(F.pmod("n_mark", F.lit(SLOTS)).alias("n_slot")).count().where("count > 1").toArrow()
    often = np.ones(SLOTS, np.int32)
    often[slots.column("n_slot").to_numpy()] = np.minimum(slots.column("count").to_numpy(), 2**31 - 1)
    counts = open_texts.sparkSession.sparkContext.broadcast(often)

    def rarest(batches):
        for batch in batches:
            sizes, kept = [], []
            for marks in batch.column("n_marks"):
                v = marks.values.to_numpy()
                order = np.lexsort((v, counts.value[v % SLOTS]))
                sizes.append(len(v))
                kept.append(v[order[: len(v) - int(np.ceil(len(v) * similar - 1e-9)) + 1]])
            yield pa.RecordBatch.from_arrays([batch.column("n_key"), batch.column("n_class"), pa.array(sizes, pa.int64()), pa.array(kept, pa.list_(pa.int64()))], names=["n_key", "n_class", "n_size", "n_first"])

    first = in_arrow(found, rarest, f"n_key {key}, n_class {key}, n_size long, n_first array<long>").select("n_key", "n_class", "n_size", F.posexplode("n_first").alias("n_rank", "n_mark"))
    first = stored(first.select("n_mark", "n_key", "n_class", "n_size", (F.col("n_rank") + 1).alias("n_rank")), "prefixes")
    other = first.select("n_mark", *[F.col(f"n_{c}").alias(f"n_{c}_b") for c in ("key", "class", "size", "rank")])
    both = first.join(other, "n_mark").where("n_key < n_key_b and n_class <> n_class_b")
    both = both.where(1 + F.least(F.col("n_size") - F.col("n_rank"), F.col("n_size_b") - F.col("n_rank_b")) >= similar / (1 + similar) * (F.col("n_size") + F.col("n_size_b")) - 1e-6)
    both = both.where(F.least("n_size", "n_size_b") >= similar * F.greatest("n_size", "n_size_b") - 1e-6)
    return both.select(F.col("n_key").alias("n_a"), F.col("n_key_b").alias("n_b")).distinct()


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(n_key, n_class) after the links join classes: smallest labels spread over links, then over labels, until none changes."""
    edges = links.select(F.col("n_a").alias("n_x"), F.col("n_b").alias("n_y"))
    named = labels.select(F.col("n_key").alias("n_x"), F.col("n_class").alias("n_u"))
    # From here on between classes: what a round has joined is one node.
    edges = edges.join(named, "n_x").join(named.select(F.col("n_x").alias("n_y"), F.col("n_u").alias("n_v")), "n_y").where("n_u <> n_v").select("n_u", "n_v").distinct()
    edges = stored(edges.union(edges.select("n_v", "n_u")).toDF("n_u", "n_v"), "edges")
    roots = stored(edges.select(F.col("n_u").alias("n_node")).distinct().withColumn("n_root", F.col("n_node")), "roots")
    while True:
        near = edges.join(roots.toDF("n_v", "n_root"), "n_v").groupBy("n_u").agg(F.min("n_root").alias("n_near"))
        nearer = roots.join(near, roots["n_node"] == near["n_u"]).select("n_node", F.least("n_root", "n_near").alias("n_next"), "n_root")
        hop = nearer.select(F.col("n_node").alias("n_at"), F.col("n_next").alias("n_after"))
        new = nearer.join(hop, nearer["n_next"] == hop["n_at"]).select("n_node", F.least("n_next", "n_after").alias("n_now"), "n_root")
        new = stored(new, "roots")
        changed = new.where("n_now <> n_root").head(1)
        roots = new.select("n_node", F.col("n_now").alias("n_root"))
        if not changed:
            break
    moved = labels.join(roots, labels["n_class"] == roots["n_node"], "left")
    return moved.select("n_key", F.coalesce("n_root", "n_class").alias("n_class"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(n_id, n_raw, n_raw_check, n_class, n_first, n_size): every row with its class, the class's smallest id and its rows."""
    rows = stored(keyed(docs, doc_id, text), "sketches")
    nodes = rows.where("n_words > 0").groupBy("n_key").agg(F.min(F.struct("n_raw", "n_raw_check")).alias("n_raws"), F.first("n_sketches").alias("n_sketches"))
    places = nodes.select("n_key", F.posexplode("n_sketches").alias("n_band", "n_sketch"))
    places = places.withColumn("n_band", F.least("n_band", F.lit(BANDS)))  # the keys of short texts are one band
    shared = places.groupBy("n_band", "n_sketch").agg(F.count("*").alias("n_others")).where("n_others > 1")
    places = stored(places.join(shared, ["n_band", "n_sketch"]), "buckets")
    mates = places.groupBy("n_key").agg(F.sum("n_others").alias("n_mates"))
    places = places.drop("n_others").join(mates, "n_key")
    labels = stored(places.select("n_key").distinct().withColumn("n_class", F.col("n_key")), "labels")
    needed = nodes.select("n_key", "n_raws").join(labels.select("n_key"), "n_key")
    raw = docs.select(F.struct(F.xxhash64(text).alias("n_raw"), F.hash(text).alias("n_raw_check")).alias("n_raws"), F.col(text).cast("binary").alias("n_text"))
    texts = raw.join(needed, "n_raws").groupBy("n_key").agg(F.first("n_text").alias("n_text"))
    texts = stored(texts, "texts")
    tested, places = None, places.withColumn("n_led", F.lit(False))
    # Classes only grow: a bucket of one class stays so and is left behind, and so is one in which all have led.
    opened = ((F.min("n_class") != F.max("n_class")) & (F.sum(F.when(F.col("n_led"), 0).otherwise(1)) > 1)).alias("n_open")
    for turn in range(ROUNDS):
        here = places.join(labels, "n_key")
        several = range(1 if turn == 0 else LEADERS)
        leader = lambda k: F.min(F.when(~F.col("n_led"), F.struct(*([-F.col("n_mates")] if k == 0 else []), F.xxhash64(F.lit(turn), F.lit(k), "n_key"), "n_key", "n_class")))  # noqa: B023, E731
        leaders = here.groupBy("n_band", "n_sketch").agg(F.array(*[F.struct(leader(k)["n_key"].alias("n_key"), leader(k)["n_class"].alias("n_class")) for k in several]).alias("n_leads"), opened)
        here = stored(here.join(leaders.where("n_open").drop("n_open"), ["n_band", "n_sketch"]), "open")
        places = here.select("n_key", "n_band", "n_sketch", "n_mates", (F.col("n_led") | F.exists("n_leads", lambda x: x["n_key"] == F.col("n_key"))).alias("n_led"))
        # Leaders of the text's own class are left out, and those that lead several of its buckets count once, before rows are made of the rest.
        others = F.filter("n_leads", lambda x: x["n_class"] != F.col("n_class"))
        pairs = here.select("n_key", others.alias("n_others")).where(F.size("n_others") > 0).groupBy("n_key").agg(F.array_distinct(F.flatten(F.collect_list("n_others"))).alias("n_others"))
        pairs = pairs.select("n_key", F.explode("n_others").alias("n_lead"))
        pairs = pairs.select(F.least("n_key", "n_lead.n_key").alias("n_a"), F.greatest("n_key", "n_lead.n_key").alias("n_b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["n_a", "n_b"], "left_anti")
        pairs = stored(pairs, "pairs")
        links = stored(verified(pairs, texts, similar), "links")
        tested = pairs if tested is None else tested.union(pairs)
        found = links.count()
        if found:
            labels = stored(components(labels, links), "labels")
        if found < FRUITFUL * pairs.count():
            break
    # A pair of a bucket is now in one class, tested, or of two texts here that have not led.
    here = places.join(labels, "n_key")
    here = here.join(here.groupBy("n_band", "n_sketch").agg(opened).where("n_open"), ["n_band", "n_sketch"]).where(~F.col("n_led"))
    here = stored(here.select("n_key", "n_class").distinct(), "rest")
    if here.head(1):
        pairs = stored(rare_pairs(here, texts, similar).join(tested, ["n_a", "n_b"], "left_anti"), "pairs")
        links = stored(verified(pairs, texts, similar), "links")
        if links.head(1):
            labels = stored(components(labels, links), "labels")
    alone = F.struct(F.col("n_raw").alias("a"), F.col("n_raw_check").cast("long").alias("b"))
    out = rows.drop("n_sketches").join(labels, "n_key", "left").withColumn("n_class", F.coalesce("n_class", "n_key"))
    worded = out.where("n_words > 0")
    named = worded.groupBy("n_class").agg(F.min(F.struct(F.col("n_id").isNull().alias("null"), F.col("n_id").alias("id"), "n_raw", "n_raw_check")).alias("n_first"), F.count("*").alias("n_size"))
    worded = worded.join(named, "n_class").select("n_id", "n_raw", "n_raw_check", "n_class", "n_first", "n_size")
    itself = F.struct(F.col("n_id").isNull().alias("null"), F.col("n_id").alias("id"), "n_raw", "n_raw_check")
    bare = out.where("n_words = 0").select("n_id", "n_raw", "n_raw_check", alone.alias("n_class"), itself.alias("n_first"), F.lit(1).cast("long").alias("n_size"))
    return worded.unionByName(bare)


def is_first():
    return F.col("n_first.id").eqNullSafe(F.col("n_id")) & (F.col("n_first.n_raw") == F.col("n_raw")) & (F.col("n_first.n_raw_check") == F.col("n_raw_check"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kwargs) -> DataFrame:
    """One document of each class, that of the smallest id; columns as given. Texts without words all stay."""
    first = classes(docs, doc_id, text, **kwargs).where(is_first()).groupBy("n_id", "n_raw", "n_raw_check").agg(F.count("*").alias("n_rows"), F.min("n_size").alias("n_size"))
    raw = packed(docs, doc_id, text).withColumns({"d_raw": F.xxhash64(text), "d_raw_check": F.hash(text)})
    kept = raw.join(first, F.col(doc_id).eqNullSafe(F.col("n_id")) & (F.col("d_raw") == F.col("n_raw")) & (F.col("d_raw_check") == F.col("n_raw_check")))
    # Rows alike in id and text: only these are shuffled again, to keep one of each; those without words all stay.
    single = (F.col("n_rows") == 1) | (F.col("n_size") == 1)
    once = kept.where(~single).dropDuplicates(["n_id", "n_raw", "n_raw_check"])
    return unpacked(kept.where(single).unionByName(once), docs.columns, (doc_id, text))


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = classes(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(F.col("n_id").alias("doc_id"), F.col("n_first.id").alias("class_id"), F.col("n_size").alias("class_size"), is_first().alias("kept"))


QUERIES = {"op7_near_dedup": op7_near_dedup}
ORACLES: dict[str, str] = {}
