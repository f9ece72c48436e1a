"""Fill-in-middle against a plain version, and the sparse index against Python's own strings."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablex.llm import fim


def plain_version(doc_id, text, unit="line", rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    h = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXT = st.text(st.sampled_from(["a", "b", "\n", "é", "漢", "😀", "<", "P", "S", "M", ">", "\r", " ", "\x00"]), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_the_index_counts_as_python_does(text):
    raw = text.encode()
    index = fim.SparseIndex(raw)
    for k in range(len(text) + 1):
        at = len(text[:k].encode())
        assert index.bytes(k) == at and index.chars(at) == k
    assert len(index.at) == sum(ord(c) > 127 for c in text)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(0, 10**6), st.sampled_from(["line", "char"]), st.sampled_from([0, 40, 100]), st.sampled_from([0, 50, 100]))
def test_one_text(text, doc_id, unit, rate, spm):
    got = fim.transform(text.encode(), doc_id, unit, rate=rate, spm=spm)
    assert (*got[:4], got[4].decode()) == plain_version(doc_id, text, unit, rate, spm)


ROWS = [
    (1, "a\nb\nc\n", "x"),
    (1, "a\nb\nc\n", "x"),
    (2, None, "x"),
    (3, "", "y"),
    (None, "nur eine Zeile mit ü", "y"),
    (4, "ä\n\n\nö no end", None),
    (5, "holds <M> already\nand more", None),
    (6, "<\n<S\n>P>\n<<\n", None),
    (7, "x<" * 3 + "\n" + "P>S>M>\n" * 5, None),
    (8, "wörter und\n" * 200_000, None),
]


def test_rows_of_every_kind(spark):
    random.seed(3)
    rows = ROWS + [(100 + k, "".join(random.choices("ab\né漢<SPM>", k=random.randrange(60))), "z") for k in range(300)]
    docs = spark.createDataFrame([(*r, 1, "gone", 2) for r in rows], "doc_id long, text string, source string, `a.b` int, f_form string, n int")
    found = fim.fill_in_middle(docs)
    out = found.withColumn("back", fim.restored(F.col("f_output").cast("string"), F.col("f_form"))).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    want = sorted(((r[0], r[1], *plain_version(r[0], r[1])) for r in rows), key=key)
    got = sorted(((r.doc_id, r.text, r.f_n, r.f_form, r.f_prefix_chars, r.f_middle_chars, bytes(r.f_output).decode()) for r in out), key=key)
    assert got == want
    assert all(r.back == (r.text or "") and r["a.b"] == 1 and r.n == 2 for r in out)
    assert {"plain", "psm", "spm"} == {r.f_form for r in out}
    assert fim.fill_in_middle(docs.where("false")).count() == 0
