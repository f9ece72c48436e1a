"""Lexicon matches against edit distances computed one by one; context, edges and held-out accuracy."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablex.llm import toxicity
from tablex.llm.toxicity import Lexicon, Reader


def edits(a, b):
    """Letters changed, missing, added or two neighbours swapped once."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


WORD = st.text(st.sampled_from("abcé"), min_size=1, max_size=8)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(WORD, st.booleans()), min_size=1, max_size=6, unique=True), st.lists(WORD, min_size=1, max_size=12), st.sampled_from([0, 1, 2]), st.sampled_from([1, 4]))
def test_the_automaton_finds_what_edit_distances_say(terms, words, most, edited):
    lexicon = Lexicon([(t, stem, 1.0) for t, stem in terms], edits=most, edited=edited)
    want = set()
    for k, word in enumerate(words):
        for n, (term, stem) in enumerate(terms):
            if stem:
                if word.startswith(term):
                    want.add((k, n, 0))
            elif edits(term, word) <= (most if len(term) >= edited else 0):
                want.add((k, n, edits(term, word)))
    assert sorted(lexicon.matches(words)) == sorted(want)


LEXICON = Lexicon([("idiot", False, 4.0), ("worthless", False, 4.0), ("dumb", False, 3.0), ("schwach", True, 2.0)], clean=frozenset({"idiom"}))


def hits(text):
    reader = Reader(LEXICON)
    reader.tokens([text.lower()])
    return reader.found(text.lower())


def test_misspellings():
    found = hits("You 1d10t, an idoit, idi0t$$$ and wortless! an idiom, dum, dumb; Schwachsinnig idi*ot x")
    assert [(h[0], h[1], h[3] > 0) for h in found] == [
        ("idiot", "1d10t", True), ("idiot", "idoit", True), ("idiot", "idi0t", True), ("worthless", "wortless", True), ("dumb", "dumb", False), ("schwach", "schwachsinnig", False), ("idiot", "idi*ot", True),
    ]


def test_context_tells_quotation_from_abuse():
    score = lambda text: sum(h[5] for h in hits(text))
    plain = score("it was an idiot there")
    assert score("you are an idiot there") > plain > score('he saw "an idiot" there') > score('the word "idiot" was written there')
    assert score("an idiot , worthless here") > 2 * plain
    assert score("x " * 30 + "he wrote that some weeks ago " + "x " * 30 + "an idiot") == plain
    assert [h[4] for h in hits('„idiot“ idiot "a idiot\nidiot" «idiot» idiot')] == [True, False, False, False, True, False]


ROWS = [(k, f"some plain words of number {k} and more of them", 0) for k in range(60)] + [(100 + k, f"you blockhead of number {k} are a nitwit and more", 1) for k in range(30)]


def learned(spark, **kwargs):
    docs = spark.createDataFrame([(k, t) for k, t, _ in ROWS], "doc_id long, text string")
    return toxicity.learn(docs, spark.createDataFrame([(k, y) for k, _, y in ROWS], "doc_id long, toxic int"), **kwargs)


def test_edges(spark):
    model = learned(spark)
    assert {"blockhead", "nitwit"} <= {t for t, stem, _ in model["lexicon"].terms if not stem}
    rows = [(1, None, "s"), (2, "", "s"), (None, "you blockhead", None), (None, "you blockhead", None), (3, "x " * 300_000 + "you nitwti " * 9, "q"), (4, "harmless words", "q"), (5, "!!!\n\n\"“", "q")]
    docs = spark.createDataFrame([(*r, 0.1, "h", 4) for r in rows], "doc_id long, text string, source string, x_score double, x_hits string, `a.b` int")
    out = toxicity.scored(docs, model).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows) and all(r["a.b"] == 4 for r in out)
    by = {r.doc_id: r for r in out}
    assert by[1].x_score == by[2].x_score == 0.0 and by[4].x_score < 0.3 and by[5].x_score < 0.3
    assert by[None].x_score > 0.5 and len(by[3].x_hits) == 9 and by[3].x_hits[0].term == "nitwit" and by[3].x_hits[0].place == 300_001
    assert toxicity.scored(docs.where("false"), model).count() == 0
    none = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.x_score for r in toxicity.scored(docs, none).collect()} == {0.0, 0.5}
    one = toxicity.learn(docs, spark.createDataFrame([(4, 1), (5, 1), (None, 0), (4, None)], "doc_id long, toxic int"))
    assert toxicity.scored(docs, one).count() == len(rows)


def test_a_given_lexicon(spark):
    model = learned(spark, terms=[("nitwit", False, 3.0)])
    docs = spark.createDataFrame([(1, "you nitwit"), (2, "you blockhead")], "doc_id long, text string")
    scores = {r.doc_id: r.x_score for r in toxicity.scored(docs, model, hits=False).collect()}
    assert scores[1] > 0.5 > scores[2]


@pytest.fixture(scope="module")
def found(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.QUERIES["op13_toxicity"](spark, folder).join(labels, "doc_id", "left").collect()


def test_held_out_accuracy(found):
    rows = [r for r in found if r.held_out and r.toxic is not None]
    right = sum(r.predicted == r.toxic for r in rows)
    caught = [r.predicted for r in rows if r.toxic]
    assert right >= 0.93 * len(rows) and sum(caught) >= 0.6 * len(caught)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
