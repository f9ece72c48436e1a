"""Operators that SQL can't express, against plain versions over whole small tables."""

import collections
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablex.llm import bytecnn, fmindex, near_dedup, rangecoder, shingles, token_files
from tablex.llm.language_id import op8_language_id
from tablex.llm.quality_classifier import op1_quality_classifier

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def texts(folder):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def labelled(text):
    words, seen, out = WORD.findall((text or "").translate(LOWER)), collections.Counter(), []
    for k in range(max(1, len(words) - 4) if words else 0):
        gram = tuple(words[k : k + 5])
        seen[gram] += 1
        out.append((gram, seen[gram]))
    return out


def common_in_order(x, y):
    """Longest common subsequence, cell by cell."""
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def brute_classes(docs):
    """Smallest id of each document's class: every pair that shares a shingle is aligned in full."""
    marks = {i: labelled(t) for i, t in docs}
    places, parent = collections.defaultdict(list), {i: i for i, _ in docs}
    shared = collections.Counter()
    for i, m in marks.items():
        for g in m:
            places[g].append(i)
    for owners in places.values():
        shared.update((a, b) for k, b in enumerate(owners) for a in owners[:k])

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        x, y = marks[a], marks[b]
        if n / (len(x) + len(y) - n) >= 0.8:
            kept = common_in_order(x, y)
            if kept / (len(x) + len(y) - kept) >= 0.8:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i, _ in docs}


def test_near_duplicate_classes(spark):
    want = brute_classes(texts(MIDDLE))
    got = {r.doc_id: r for r in near_dedup.op7_near_dedup(spark, MIDDLE).collect()}
    assert {i: r.class_id for i, r in got.items()} == want
    assert all(r.kept == (i == want[i]) for i, r in got.items())


def test_a_chain_of_edits_is_one_class(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in rng.integers(0, 10**6, 300)]
    chain = []
    for step in range(120):  # each differs from the one before by one word
        words = list(words)
        words[int(rng.integers(0, 300))] = f"new{step}"
        chain.append((step, " ".join(words)))
    docs = spark.createDataFrame(chain + [(500 + k, " ".join(f"x{v}" for v in rng.integers(0, 10**6, 200))) for k in range(20)], "doc_id long, text string")
    got = near_dedup.classes(docs).collect()
    assert {r.n_id: r.n_first.id for r in got} == {i: 0 if i < 500 else i for i in [*range(120), *range(500, 520)]}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 25), max_size=40), st.lists(st.integers(0, 25), max_size=40))
def test_alignment(a, b):
    def values(x):
        seen, out = collections.Counter(), []
        for v in x:
            seen[v] += 1
            out.append(v * 1000 + seen[v])
        return np.array(out, np.uint64)

    x, y = values(a), values(b)
    kept = common_in_order(x.tolist(), y.tolist())
    want = kept / max(1, len(x) + len(y) - kept)
    got = near_dedup.aligned(x, y)
    assert got == pytest.approx(want) if want >= 0.8 else got < 0.8


def test_word_hashes_do_not_depend_on_pieces():
    data = [b"Some words, here", None, b"", b"some WORDS here and " * 300, "é à 漢字 ß".encode(), b"z" * 700]
    with np.errstate(over="ignore"):
        wide, first = shingles.WordHasher().words(data)
        narrow, also = shingles.WordHasher(size=64).words(data)
    assert first.tolist() == also.tolist() == np.cumsum([0] + [len(WORD.findall((t or b"").decode().translate(LOWER))) for t in data]).tolist()
    assert (wide[:-1] == narrow[:-1]).all() and wide[0] == wide[first[3]]
    assert len(np.unique(wide)) == len({w for t in data for w in WORD.findall((t or b"").decode().translate(LOWER))})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=30), min_size=1, max_size=6), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=5), min_size=1, max_size=8))
def test_fm_index(runs, patterns):
    text = np.array([v for run in runs for v in [*run, 0]])
    index = fmindex.FMIndex(text, 4, sample=4)
    padded = np.array([[0] * (5 - len(p)) + p for p in patterns])
    low, high = index.search(padded, np.array([len(p) for p in patterns]))
    for p, a, b in zip(patterns, low, high):
        want = [k for k in range(len(text)) if text[k : k + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 5), st.integers(1, 80), st.integers(1, 65536), st.integers(0, 2**32))
def test_range_coder_round_trip(lanes, steps, ids, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, ids, (lanes, steps))
    x[:, : steps // 2] = x[:, :1]
    assert (rangecoder.decode(rangecoder.encode(x), steps) == x).all()


def test_range_coder_gains_from_context():
    x = np.tile(np.arange(40) * 977, (4, 25))
    assert sum(map(len, rangecoder.encode(x))) < x.size * 2 / 4


def test_a_damaged_block_is_found():
    content = bytearray(token_files.frame([(1, np.arange(3000, dtype="<u2").tobytes()), (None, b"\2\0")]) + b"\n")
    (docs, ids), = token_files.frames(bytes(content))
    assert docs == [(1, 3000), (None, 1)] and ids.tolist() == [*range(3000), 2]
    content[-900] ^= 1
    with pytest.raises(ValueError):
        list(token_files.frames(bytes(content)))


def test_token_ids_of_every_document(spark):
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.op6_token_files(spark, SMALL).collect()}
    for doc, text in texts(SMALL):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert got[doc] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_chunks_are_encoded_like_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read())
    odd = ["It's DON'T we'll o'clock's 'S", "a.b,c!!", "<|endoftext|> x<|startoftext|>", "é é İSTANBUL ǅ ß", " x y\u0085z\x1cq", "12ab3 ½ ٣", "  \t\n\r\v\f ", "", "日本語 テキスト", "x́ ́y", "A#$%.'b", "ﬁ ＡＢＣ"]
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder.texts([t.encode() for t in odd])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in odd]


def test_quality_of_documents_held_out(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = op1_quality_classifier(spark, MIDDLE).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert right >= 0.95 * len(rows)
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_language_of_documents_held_out(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = op8_language_id(spark, MIDDLE).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_gradients():
    shape = bytecnn.Shape(length=16, step=16, stride=2, widths=(1, 2), filters=3, classes=2, dims=4)
    rng = np.random.default_rng(5)
    x, y = rng.integers(1, 256, (6, 16)).astype(np.uint8), rng.integers(0, 2, 6)
    net = {k: v.astype(np.float64) for k, v in bytecnn.new(shape).items()}
    loss = lambda n: -np.log(bytecnn.softmax(bytecnn.scores(n, x, shape))[np.arange(6), y]).mean()
    for name, grad in bytecnn._gradient(net, x, y, shape).items():
        flat = net[name].reshape(-1)
        for k in rng.choice(len(flat), 4):
            if name == "bytes" and k < shape.dims:
                continue
            old, step = flat[k], 1e-5
            flat[k] = old + step
            up = loss(net)
            flat[k] = old - step
            down = loss(net)
            flat[k] = old
            assert grad.reshape(-1)[k] == pytest.approx((up - down) / (2 * step), abs=1e-5)


def test_windows_cover_every_byte():
    shape = bytecnn.Shape(length=8, step=6, stride=2, widths=(1,), filters=1, classes=2)
    for n in range(40):
        data = bytes(range(1, n + 1))
        cut = bytecnn.windows(data, shape)
        assert set(cut.reshape(-1).tolist()) - {0} == set(data)
        assert len(cut) == 1 or any(cut[-1])


def test_the_pipeline_keeps_what_each_stage_should(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {name: None for name, _ in p.STAGES}
    before = docs
    for name, stage in p.STAGES:
        after = stage(spark, before, SMALL)
        kept[name] = [tuple(r) for r in after.collect()]
        if name == "quality classifier":
            scores = {r.doc_id: r.predicted for r in op1_quality_classifier(spark, SMALL).collect()}
            assert sorted(r[0] for r in kept[name]) == sorted(i for i, good in scores.items() if good)
        if name == "near duplicates":
            want = brute_classes([(r.doc_id, r.text) for r in before.collect()])
            assert sorted(r[0] for r in kept[name]) == sorted(set(want.values()))
        if name != p.STAGES[-1][0]:
            assert after.columns == docs.columns
            before = spark.createDataFrame(kept[name], after.schema)
    grams = set()
    for (text,) in duckdb.sql(f"SELECT text FROM '{SMALL}/benchmark.parquet'").fetchall():
        words = WORD.findall(text.translate(LOWER))
        grams |= {tuple(words[k : k + 10]) for k in range(max(1, len(words) - 9))}
    found = {i for i, text, *_ in kept["near duplicates"] for words in [WORD.findall(text.translate(LOWER))] for k in range(len(words)) if tuple(words[k : k + 10]) in grams}
    changed = {a[0] for a, b in zip(sorted(kept["near duplicates"]), sorted(kept["decontamination"])) if a[1] != b[1]}
    assert changed == found and len(kept["near duplicates"]) == len(kept["decontamination"])
    copies = collections.Counter(r[0] for r in kept["mixing"])
    assert max(copies.values()) <= 3 and copies.keys() <= {r[0] for r in kept["decontamination"]}
    assert collections.Counter(r[0] for r in kept["token ids"]) == copies
