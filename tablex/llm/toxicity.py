"""Toxicity: lexicon terms found also where they are misspelled, judged by the words around them.

Lexicon. Whole words, and stems that begin longer words, whose share of toxic documents stands out against that of the
others (likelihood ratio), from at most about `per_class` labelled texts of each label. A list of terms may be given instead.

Matching. The terms are a trie. A Levenshtein automaton, whose states are rows of edit distances in a band around
the diagonal, walks the trie for all words new to a task at once: one numpy step per trie node and place of the band, and
only the words that can still end within the edits go on. One edit (a letter changed, missing, added, or two swapped) is
allowed in whole words of five letters or more, and digits and marks within a word are first read as the letters they stand for.
A misspelling that clean texts of the sample use as a word of their own is none.

Context. A hit counts more if other hits, an address (you, du, tu …) or an exclamation mark stand in a window of words
around it, and less if it stands in quotation marks or beside a word of reporting. The sums of these scores, the highest
of them and the numbers of hits of each kind are combined into one probability by a logistic fit.

NULL and empty texts score 0; without any label every other text scores 0.5. A label given twice counts as its higher value.
Rows alike score alike, rows without an id like all others; they count as not held out. An empty table gives an empty one. Texts are
read whole, line by line; a line of any length is held at once. Columns of the caller stay but those named x_score or x_hits.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablex.llm.batches import in_arrow
from tablex.llm.common import remainder, table
from tablex.llm.learning import class_sample

PER_CLASS = 1500
#: Terms of a learned lexicon, the letters of its words and stems, and how many toxic sample texts must have a term.
TERMS, SHORTEST, STEMS, SUPPORT = 96, 4, (4, 5, 6, 7), 4
#: Terms stand out if their share of toxic texts is so many times that of others, with a likelihood ratio beyond chance.
LIFT, CHANCE = 3.0, 20.0
#: Edits in terms of at least so many letters.
EDITS, EDITED = 1, 5
#: Words on each side of a hit that make its context; words a quotation has at most.
WINDOW, QUOTE = 8, 40
#: Share of its term's weight that a misspelling has.
MISSPELT = 0.5
#: New words are matched so many at once; a task remembers so many.
TOGETHER, REMEMBERED = 50_000, 1_000_000

# Marks that stand for letters, words of address, words of reporting, and quotation marks.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
ADDRESS = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre usted ustedes tú vosotros".split())
REPORTING = frozenset("said says say wrote writes written called calls quote quoted quotes quoting word words term terms meaning means definition reported alleged mentioned".split())
QUOTES = {"“": "”", "„": "“”", "«": "»", "‹": "›", '"': '"'}

WORD = r"[^\W_]+(?:[@$!*'’][^\W_]+)*"
TOKEN = re.compile(WORD)
PIECE = re.compile(rf"({WORD})|([{''.join(QUOTES)}{''.join(QUOTES.values())}!])")
LETTERS = str.maketrans(STANDS_FOR)

FEATURES = 12


class Lexicon:
    """Terms as a trie, intersected with the automaton of each word. A term is (text, is a stem, weight)."""

    def __init__(self, terms: list[tuple[str, bool, float]], clean: frozenset[str] = frozenset(), edits: int = EDITS, edited: int = EDITED):
        self.terms, self.clean, self.edits = terms, clean, edits
        self.allowed = [edits if len(text) >= edited and not stem else 0 for text, stem, _ in terms]
        self.width = max([len(t) for t, _, _ in terms], default=0) + edits + 1
        self.root: dict = {"next": {}, "ends": [], "most": -1}
        for number, (text, _, _) in enumerate(terms):
            node = self.root
            node["most"] = max(node["most"], self.allowed[number])
            for c in text:
                node = node["next"].setdefault(c, {"next": {}, "ends": [], "most": -1})
                node["most"] = max(node["most"], self.allowed[number])
            node["ends"].append(number)

    def matches(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(place in `words`, term, edits) of every term that a word is within the term's edits of."""
        k, width = self.edits, self.width
        sizes = np.array([len(w) for w in words], np.int64)
        text = np.array(words, f"<U{width}").view(np.int32).reshape(len(words), width)  # code points, cut or padded to the width
        far = np.int8(k + 2)
        start = np.full((len(words), 2 * k + 1), far, np.int8)
        for b in range(k, 2 * k + 1):
            start[:, b] = np.where(b - k <= sizes, b - k, far)
        found, open_nodes = [], [(self.root, 0, "", np.arange(len(words)), start, np.full_like(start, far))]
        while open_nodes:
            node, depth, before, alive, row, older = open_nodes.pop()
            for number in node["ends"]:
                if self.terms[number][1]:
                    distance = row.min(axis=1)
                else:
                    place = sizes[alive] - depth + k
                    inside = (place >= 0) & (place <= 2 * k)
                    distance = np.where(inside, row[np.arange(len(alive)), np.clip(place, 0, 2 * k)], far)
                hit = np.flatnonzero(distance <= self.allowed[number])
                found += [(int(w), number, int(d)) for w, d in zip(alive[hit], distance[hit])]
            for c, child in node["next"].items():
                new = np.full((len(alive), 2 * k + 1), far, np.int8)
                for b in range(2 * k + 1):
                    at = depth + 1 - k + b  # letters of the word that this place has read
                    if at < 0 or at > width:
                        continue
                    best = row[:, b + 1] + 1 if b < 2 * k else np.full(len(alive), far, np.int8)
                    if at:
                        letter = text[alive, at - 1]
                        best = np.minimum(best, row[:, b] + (letter != ord(c)))
                        if b:
                            best = np.minimum(best, new[:, b - 1] + 1)
                        if at > 1 and before:
                            swapped = (text[alive, at - 2] == ord(c)) & (letter == ord(before))
                            best = np.where(swapped, np.minimum(best, older[:, b] + 1), best)
                    new[:, b] = np.where(at <= sizes[alive], np.minimum(best, far), far)
                on = np.flatnonzero(new.min(axis=1) <= child["most"])
                if len(on):
                    open_nodes.append((child, depth + 1, c, alive[on], new[on], row[on]))
        return found

    def of_words(self, words: list[str]) -> dict[str, tuple[int, int]]:
        """word -> (term, edits) for each word that has a term: the fewest edits, then the largest weight."""
        best: dict[str, tuple] = {}
        for at in range(0, len(words), TOGETHER):
            part = words[at : at + TOGETHER]
            folded = [w.translate(LETTERS) if not w.isalpha() and any(c.isalpha() for c in w) else w for w in part]
            for place, number, edits in self.matches(folded):
                word = part[place]
                edits += folded[place] != word
                if edits and word in self.clean:
                    continue
                key = (edits, -self.terms[number][2], number)
                if word not in best or key < best[word]:
                    best[word] = key
        return {w: (key[2], key[0]) for w, key in best.items()}


class Reader:
    """Hits and features of texts; remembers the words it has matched."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.seen, self.hits = lexicon, set(), {}

    def tokens(self, texts: list[str]) -> list[list[str]]:
        """The words of each text; those new to this reader are matched together."""
        split = [TOKEN.findall(t) for t in texts]
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
            self.hits.clear()
        new = {w for words in split for w in words}.difference(self.seen)
        self.seen |= new
        self.hits.update(self.lexicon.of_words(sorted(new)))
        return split

    def found(self, text: str) -> list[tuple]:
        """(term, word, place in words, edits, quoted, score) of every hit, whose words have been matched."""
        places, out, count = [], [], 0
        marks: list[tuple[int, str]] = []  # exclamations and reporting, address: place in words
        for line in text.split("\n"):
            opened, spans, first = None, [], len(places)
            for m in PIECE.finditer(line):
                word, mark = m[1], m[2]
                if word is not None:
                    if word in self.hits:
                        places.append([count, word, False])
                    if word in ADDRESS:
                        marks.append((count, "address"))
                    elif word in REPORTING:
                        marks.append((count, "report"))
                    count += 1
                elif mark == "!":
                    marks.append((count, "address"))
                elif opened is not None and mark in QUOTES[opened[1]]:
                    if count - opened[0] <= QUOTE:
                        spans.append((opened[0], count))
                    opened = None
                elif mark in QUOTES:
                    opened = count, mark
            for p in places[first:]:
                k = bisect_right(spans, (p[0], 1 << 62)) - 1  # quotations follow one another
                p[2] = k >= 0 and p[0] < spans[k][1]
        at = np.array([p[0] for p in places])
        sides = {kind: np.array([p for p, what in marks if what == kind]) for kind in ("address", "report")}
        low, high = np.searchsorted(at, at - WINDOW), np.searchsorted(at, at + WINDOW, "right")
        near = {kind: np.searchsorted(v, at + WINDOW, "right") - np.searchsorted(v, at - WINDOW) for kind, v in sides.items()}
        for k, (place, word, quoted) in enumerate(places):
            number, edits = self.hits[word]
            score = self.lexicon.terms[number][2] * (1 + 0.5 * min(3, high[k] - low[k] - 1) + 0.5 * (near["address"][k] > 0))
            score *= (0.25 if quoted else 1.0) * (0.5 if near["report"][k] else 1.0) * (MISSPELT if edits else 1.0)
            out.append((self.lexicon.terms[number][0], word, place, edits, quoted, float(score)))
        return out

    def features(self, words: list[str], hits: list[tuple]) -> np.ndarray:
        f = np.zeros(FEATURES)
        f[0] = np.log1p(len(words))
        if hits:
            stem = {text for text, is_stem, _ in self.lexicon.terms if is_stem}
            whole = [h for h in hits if h[0] not in stem]
            begun = [h for h in hits if h[0] in stem]
            share = 100 / max(20, len(words))
            f[1] = np.log1p(sum(h[5] for h in whole))
            f[2] = np.log1p(max([h[5] for h in whole], default=0))
            f[3] = np.log1p(sum(not h[3] for h in whole))
            f[4] = np.log1p(sum(h[3] > 0 for h in whole))
            f[5] = np.log1p(len({h[0] for h in whole}))
            f[6] = np.log1p(share * len(whole))
            f[7] = np.log1p(sum(h[5] for h in begun))
            f[8] = np.log1p(len({h[1] for h in begun}))
            f[9] = np.log1p(share * len(begun))
            f[10] = np.log1p(sum(h[4] for h in hits))
            f[11] = np.log1p(max([h[5] for h in begun], default=0))
        return f


def forms(text: str) -> set[tuple[str, bool]]:
    """Words and stems of a text that may become terms."""
    out = set()
    for word in set(TOKEN.findall(text)):
        if len(word) >= SHORTEST and word.isalpha():
            out.add((word, False))
            out.update((word[:k], True) for k in STEMS if k < len(word))
    return out


def standing_out(counts: list[tuple[str, bool, int, int]], toxic: int, others: int, terms: int = TERMS) -> list[tuple[str, bool, float]]:
    """The terms whose share of toxic texts stands out most, of (text, is a stem, toxic texts, other texts) that have them."""
    ranked = []
    for text, stem, a, b in counts:
        p, q = (a + 0.5) / (toxic + 1), (b + 0.5) / (others + 1)
        if a < SUPPORT or p < LIFT * q:
            continue
        both = (a + b) / (toxic + others)
        parts = [(a, both * toxic), (b, both * others), (toxic - a, (1 - both) * toxic), (others - b, (1 - both) * others)]
        ratio = 2 * sum(o * np.log(o / e) for o, e in parts if o)
        if ratio >= CHANCE:
            ranked.append((-ratio, stem, -len(text), text, a, b, float(np.log(p / q))))
    chosen: list[tuple] = []
    for _, stem, _, text, a, b, weight in sorted(ranked):
        # A stem that occurs in about the texts of a chosen term is that term again, shorter or longer.
        again = any((text.startswith(t) or t.startswith(text)) and abs(a - x) <= 0.1 * x + 1 and abs(b - y) <= 0.1 * y + 1 for t, _, _, x, y in chosen)
        if not again:
            chosen.append((text, stem, weight, a, b))
        if len(chosen) == terms:
            break
    return [c[:3] for c in chosen]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, pull: float = 1.0, steps: int = 40) -> dict:
    """Weights of standardised features, by damped Newton steps."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.diag([pull] * x.shape[1] + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge @ w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge
        move = np.linalg.solve(curve + 1e-9 * np.eye(len(w)), slope)
        w = w - move * min(1.0, 4.0 / (np.abs(move).max() + 1e-9))
    return {"mean": mean, "spread": spread, "w": w}


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = PER_CLASS, terms: list[tuple[str, bool, float]] | None = None) -> dict:
    """Lexicon and weights, from documents whose id is labelled."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.max(label).cast("int").alias("x_label"))
    totals = {r["x_label"]: r["count"] for r in known.groupBy("x_label").count().collect()}
    _, picked = class_sample(known, "x_label", doc_id, per_class)
    # The sample is bounded by `per_class`: it is broadcast, and no text is shuffled.
    rows = docs.select(F.col(doc_id), F.lower(text).alias("x_text")).join(F.broadcast(picked), doc_id).select(F.col(doc_id).cast("string").alias("x_id"), "x_label", "x_text").where("x_text IS NOT NULL")

    def count(batches):
        n: dict[tuple, list[int]] = {}
        size = [0, 0]
        for batch in batches:
            for y, t in zip(batch.column("x_label").to_pylist(), batch.column("x_text").to_pylist()):
                size[y] += 1
                for form in forms(t):
                    n.setdefault(form, [0, 0])[y] += 1
        n[("", False)] = size
        values = [pa.array([f[0] for f in n], pa.string()), pa.array([f[1] for f in n], pa.bool_()), *[pa.array([v[y] for v in n.values()], pa.int64()) for y in (1, 0)]]
        yield pa.RecordBatch.from_arrays(values, names=["term", "stem", "toxic", "others"])

    if terms is None:
        found = in_arrow(rows, count, "term string, stem boolean, toxic long, others long").groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("others").alias("others"))
        # Fewer than the sample's toxic texts have words: what has too few of them, or none too many, stays with the executors.
        found = found.where(f"term = '' OR toxic >= {SUPPORT} AND toxic >= 0.05 * others").collect()
        toxic, others = next(((r.toxic, r.others) for r in found if not r.term), (0, 0))
        terms = standing_out([tuple(r) for r in found if r.term], toxic, others) if toxic and others else []
    plain = Lexicon(terms)

    def near(batches):
        """Words of texts that aren't toxic which are near a term."""
        words: Counter = Counter()
        reader = Reader(plain)
        for batch in batches:
            texts = [t for y, t in zip(batch.column("x_label").to_pylist(), batch.column("x_text").to_pylist()) if not y]
            for split in reader.tokens(texts):
                words.update({w for w in split if w in reader.hits and reader.hits[w][1]})
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string())], names=["word"])

    clean = frozenset(r.word for r in in_arrow(rows, near, "word string").distinct().collect()) if terms else frozenset()
    lexicon = Lexicon(terms, clean)

    def measure(batches):
        reader = Reader(lexicon)
        for batch in batches:
            texts = batch.column("x_text").to_pylist()
            split = reader.tokens(texts)
            values = [reader.features(words, reader.found(t) if any(w in reader.hits for w in words) else []) for words, t in zip(split, texts)]
            yield pa.RecordBatch.from_arrays([batch.column("x_id"), batch.column("x_label"), pa.array(values, pa.list_(pa.float64()))], names=["x_id", "x_label", "x_features"])

    taken = sorted(in_arrow(rows, measure, "x_id string, x_label int, x_features array<double>").collect())
    if not taken:
        return {"lexicon": lexicon, "fit": None}
    x, y = np.array([r[2] for r in taken]), np.array([r[1] for r in taken])
    # The sample takes more of the rarer label; weights undo that.
    weight = np.array([totals.get(v, 0) / max(1, (y == v).sum()) for v in (0, 1)])
    weight = weight / weight[y].mean()
    return {"lexicon": lexicon, "fit": logistic(x, y.astype(float), weight[y])}


HITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("term", T.StringType()),
            T.StructField("word", T.StringType()),
            T.StructField("place", T.LongType()),
            T.StructField("edits", T.IntegerType()),
            T.StructField("quoted", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)


def scored(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None, hits: bool = True) -> DataFrame:
    """The columns `keep` (all by default) with x_score and, if wanted, x_hits: term, word, place in words, edits, quoted, score."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("x_score", "x_hits", "x_text")]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.lower(text).alias("x_text"))
    lexicon, fit = model["lexicon"], model["fit"]
    names = ("term", "word", "place", "edits", "quoted", "score")

    def score(batches):
        reader = Reader(lexicon)
        for batch in batches:
            texts = [t or "" for t in batch.column("x_text").to_pylist()]
            split = reader.tokens(texts)
            found = [reader.found(t) if any(map(reader.hits.__contains__, words)) else [] for words, t in zip(split, texts)]
            if fit is None:
                p = np.full(len(texts), 0.5)
            else:
                x = np.array([reader.features(words, f) for words, f in zip(split, found)]).reshape(-1, FEATURES)
                z = (x - fit["mean"]) / fit["spread"] @ fit["w"][:-1] + fit["w"][-1]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            p = np.where([bool(t) for t in texts], p, 0.0)
            columns = [*[batch.column(c) for c in keep], pa.array(p, pa.float64())]
            if hits:
                columns.append(pa.array([[dict(zip(names, h)) for h in f] for f in found], pa.list_(pa.struct([("term", pa.string()), ("word", pa.string()), ("place", pa.int64()), ("edits", pa.int32()), ("quoted", pa.bool_()), ("score", pa.float64())]))))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "x_score", *["x_hits"] * hits])

    return in_arrow(kept, score, T.StructType([*kept.schema.fields[: len(keep)], T.StructField("x_score", T.DoubleType()), *[T.StructField("x_hits", HITS)] * hits]))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(remainder(doc_id, 4) == 2, F.lit(False))


#: A score of so much or more is a prediction of toxicity.
THRESHOLD = 0.3


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, folder, "labels").where(~held_out()))
    found = scored(docs, model, keep=["doc_id"], hits=False)
    return found.select("doc_id", held_out().alias("held_out"), F.col("x_score").alias("score"), (F.col("x_score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op13_toxicity": op13_toxicity}
ORACLES: dict[str, str] = {}
