"""Spelling variants against all pairs compared one by one."""

import random
import re
import zlib
from collections import Counter

import pytest

from tablex.llm import spelling

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, letters=5, times=3):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= times}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_force(rows):
    n = counted(rows)
    form, out = {}, []
    for w in n:
        around = [v for v in n if near(w, v)]
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out.append([w, form[w], None, n[w], len(around), n.get(form[w])])
    for row in out:
        root = row[0]
        while form[root]:
            root = form[root]
        row[2] = root
    return sorted(tuple(r) for r in out)


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def made(seed, letters="abé", words=400, length=(5, 8)):
    rng = random.Random(seed)
    base = ["".join(rng.choices(letters, k=rng.randint(*length))) for _ in range(words)]
    rows = []
    for k in range(200):
        some = rng.choices(base, weights=[1 / (i + 1) for i in range(len(base))], k=90)
        rows.append((k, rng.choice([" ", ", ", "\n", "-1"]).join(w.upper() if w.isascii() and rng.random() < 0.1 else w for w in some)))
    return rows


@pytest.mark.parametrize("tile", [spelling.TILE, 7])
def test_equals_all_pairs(spark, tile):
    """Few letters: words repeat letters, so a pair may share both halves. With small tiles most blocks are cut."""
    rows = made(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_force(rows)
    assert result(spelling.variants(docs, tile=tile)) == want
    assert sum(w[4] for w in want) > 200 and any(w[1] and w[2] != w[1] for w in want)


def test_edges(spark):
    long = "verylongword" * 500
    rows = [
        (1, None), (2, ""), (3, "1234 !? five"), (None, "colour colour colour"), (None, "color color color color color color"),
        (4, "Ärger ärger Ärger ÄRGER ärger ärger"), (5, f"{long} {long} {long} {long}x {long}x {long}x {long}x {long}x {long}x"), (5, "ÿÿÿÿÿ ÿÿÿÿÿ ÿÿÿÿÿ ÿÿÿÿÿÿ"),
        (6, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaaaaa aaaaaaa aaaaaaa"), (6, "anger anger anger"), (7, "tie" * 3 + " tiE" * 9 + " abĀcde straße straße straße strasse strasse strasse"),
    ]
    docs = spark.createDataFrame([(*r, "x", 9, "w") for r in rows], "doc_id long, text string, word string, n int, form string")
    assert result(spelling.variants(docs)) == brute_force(rows)
    assert spelling.variants(docs.where("false")).count() == 0


def test_chains_lead_to_their_root(spark):
    chain = ["abcdefgh"[:k] + "x" * (8 - k) for k in range(9)]  # neighbours one replaced letter apart
    rows = [(1, " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2**k)))]
    found = {r.word: r for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), thinned=1 << 40).collect()}
    assert all(found[w].root == chain[-1] for w in chain)
    assert found[chain[3]].form == chain[4] and found[chain[-1]].form is None


def test_the_query_on_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    n = counted(rows)
    got = result(spelling.QUERIES["op12_spelling_variants"](spark, small))
    assert {r[0]: r[3] for r in got} == n
    assert got == brute_force(rows)
