"""Near duplicates: pairs that earlier versions of the operator lost."""

import collections
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from test_brute_force import common_in_order

from tablex.llm import near_dedup, shingles


def hashed(*texts):
    """(plain shingles, marked shingles) of each text."""
    with np.errstate(over="ignore"):
        plain, starts = shingles.plain_shingles(*shingles.WordHasher().words([t.encode() for t in texts]))
        values = shingles.marked(plain, starts)
    return [(plain[a:b], values[a:b]) for a, b in zip(starts[:-1], starts[1:])]


def repeating(seed):
    """A text of a passage eight times over, and the same with a word of an early repeat replaced."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(40)] * 8
    edited = list(words)
    edited[rng.randrange(5, 35)] = "edited"
    return " ".join(words), " ".join(edited)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60), st.lists(st.tuples(st.integers(0, 59), st.integers(0, 5)), max_size=6))
def test_alignment_of_repeated_shingles(a, edits):
    b = list(a)
    for at, v in edits:
        b[at : at + (v < 5)] = [v] if v < 5 else []
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    with np.errstate(over="ignore"):
        marked = [shingles.marked(v, np.array([0, len(v)])) for v in (x, y)]
    kept = common_in_order(a, b)
    want = kept / max(1, len(a) + len(b) - kept)
    got = near_dedup.aligned(*marked, plain=(x, y))
    assert (got >= 0.8 - 1e-9) == (want >= 0.8 - 1e-9 and kept > 0)


def test_an_edit_in_an_early_repeat_keeps_the_later_ones():
    for seed in range(20):
        (x, mx), (y, my) = hashed(*repeating(seed))
        kept = common_in_order(x.tolist(), y.tolist())
        want = kept / (len(x) + len(y) - kept)
        assert want >= 0.95 and abs(near_dedup.aligned(mx, my, plain=(x, y)) - want) < 1e-9


def test_self_repeating_copies_are_one_class(spark):
    docs = [(2 * k + side, text) for k in range(20) for side, text in enumerate(repeating(k))]
    got = near_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.n_id: r.n_first.id for r in got} == {i: i - i % 2 for i, _ in docs}


def test_short_texts_with_a_word_more_always_meet(spark):
    docs = []
    for k in range(120):
        n = 8 + k % 6
        words = [f"s{k}x{j}" for j in range(n)]
        longer = [*words, "end"] if k % 2 else ["start", *words]
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(longer))]
    got = near_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.n_id: r.n_first.id for r in got} == {i: i - i % 2 for i, _ in docs}


def test_similar_short_texts_share_a_key():
    rng = random.Random(7)
    for _ in range(3000):
        a = [rng.randrange(30) for _ in range(rng.randint(1, 10))]
        b = list(a)
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = [rng.randrange(30)] * rng.randint(0, 1)
        kept = common_in_order(a, b)
        if b and len(b) <= 10 and kept / (len(a) + len(b) - kept) >= 0.8:
            with np.errstate(over="ignore"):
                assert np.intersect1d(near_dedup.short_keys(np.array(a, np.uint64)), near_dedup.short_keys(np.array(b, np.uint64))).size


def test_pairs_within_a_family_of_unlike_texts(spark):
    rng = random.Random(11)
    base, new, docs = [f"t{k}" for k in range(204)], iter(range(10**6)), []

    def replaced(words, places):
        out = list(words)
        for at in places:
            out[at] = f"n{next(new)}"
        return out

    for k in range(400):
        words = replaced(base, [i * 25 + rng.randrange(5, 20) for i in range(8)])
        docs.append((2 * k, " ".join(words)))
        if k < 100:  # about 0.86 to its original
            docs.append((2 * k + 1, " ".join(replaced(words, rng.sample(range(5, 200), 3)))))
    got = near_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    marks = {i: hashed(t)[0] for i, t in docs}
    of = lambda a, b: near_dedup.aligned(marks[a][1], marks[b][1], plain=(marks[a][0], marks[b][0]))
    assert all(of(2 * k, 2 * k + 1) >= 0.8 for k in range(100)) and all(of(2 * k, 2 * k + 2) < 0.8 for k in range(399))
    assert {r.n_id: r.n_first.id for r in got} == {i: i - i % 2 for i, _ in docs}


def test_a_lone_pair_within_large_buckets(spark):
    """One pair that meets only in buckets of many unlike texts: a first round mostly finds no link there."""
    rng = random.Random(7)
    base, new = [f"t{k}" for k in range(204)], iter(range(10**6))

    def replaced(words, places):
        out = list(words)
        for at in places:
            out[at] = f"n{next(new)}"
        return out

    family = [replaced(base, [i * 25 + rng.randrange(5, 20) for i in range(8)]) for _ in range(400)]
    copies = [replaced(words, [60, 110, 160]) for words in family]
    with np.errstate(over="ignore"):
        marks = [near_dedup.sketches(values).tolist() for _, values in hashed(*[" ".join(w) for w in family + copies])]
    sizes = collections.Counter((band, v) for m in marks[:400] for band, v in enumerate(m))
    meets = {k: [sizes[band, v] for band, v in enumerate(marks[k]) if marks[400 + k][band] == v] for k in range(400)}
    chosen = max((k for k in range(400) if meets[k]), key=lambda k: (min(meets[k]), -len(meets[k])))
    assert min(meets[chosen]) >= 10
    docs = [(k, " ".join(w)) for k, w in enumerate(family)] + [(400, " ".join(copies[chosen]))]
    got = near_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.n_id: r.n_first.id for r in got} == {i: chosen if i == 400 else i for i in range(401)}
