"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tablex.llm import decontaminate, language_id, license_scan, line_dedup, mixing, near_dedup, quality_classifier, quality_rules, token_files, warc
from tablex.llm.common import BLANKS

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa\n" * 20_000
PROSE = "the quick brown fox jumps over the lazy dog and then it runs away from here to there while we look on\n" * 4
ROWS = [
    (1, PROSE, "en", "a"),
    (1, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, LONG, "en", "b"),
    (None, "licensed under cc by nc 4 0", "en", "b"),
    (None, None, None, "a"),
    (6, " \n\t\n ", "de", "c"),
    (7, "einzig und allein ein deutscher Satz mit Wörtern darin", "de", "c"),
]
CLASH = "doc_id long, text string, lang string, source string, score double, n_words long, kept string, m_size string, q_score string, count long, d_spans int, n_id string, packed long, l_pred int, x_gone string, q_words int, t_id int, s_words int, `a.b` int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0.5, 1, "x", "y", "z", 9, 3, "n", 4, 5, "g", 6, 7, 8, 11) for r in ROWS], CLASH).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def ids(df):
    return sorted((str(r.doc_id) for r in df.select("doc_id").collect()))


ALL = sorted(str(r[0]) for r in ROWS)


def test_quality_rules(docs, none):
    found = quality_rules.quality_rules(docs)
    assert ids(found) == ALL
    rows = {r.doc_id: r for r in found.where("doc_id is not null").collect()}
    assert rows[3].q_n_words == rows[4].q_n_words == rows[6].q_n_words == 0
    assert rows[3].q_base_failed and not rows[3].q_kept
    assert rows[5].q_n_words == 200_000 and rows[5].q_n_repeat_words == 200_000 and rows[5].q_n_dup_lines == 19_999
    assert rows[1].q_n_dup_lines == 3 and rows[1].kept == "x"
    assert quality_rules.quality_rules(none).count() == 0


def test_mixing(spark, docs, none):
    found = mixing.mixed(docs)
    assert ids(found) == ALL
    rows = found.collect()
    assert all(0 <= r.m_taken <= 3 * r.m_size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r.m_taken for r in own) == int(own[0].m_target)
    assert sum(r.m_taken for r in rows) <= sum(r.m_size for r in rows)
    assert sorted(map(tuple, mixing.mixed(docs).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert mixing.mixed(none).count() == 0 and mixing.mix(none).columns == docs.columns


def test_stages_keep_every_column_as_it_was(spark, docs):
    items = spark.createDataFrame([(1, "nothing like that")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    want = {tuple(r) for r in docs.collect()}
    for out in (mixing.mix(docs), near_dedup.deduplicated(docs), decontaminate.decontaminated(docs, items), quality_classifier.good(docs, labels, threshold=0.0)):
        rows = [tuple(r) for r in out.collect()]
        assert out.dtypes == docs.dtypes and rows
        assert {r[0:1] + r[2:] for r in rows} <= {r[0:1] + r[2:] for r in want}
        assert out.where("m_size = 'y' and q_score = 'z' and `a.b` = 11").count() == len(rows)


def test_the_mix_has_the_words_it_counts(spark):
    docs = spark.createDataFrame([(i, " a  b\tc " * (i % 5), "s", i) for i in range(50)] + [(i, "w " * 400, "t", 800) for i in range(50, 90)], "doc_id long, text string, source string, n_chars int")
    taken = {r.doc_id: r.m_taken for r in mixing.mixed(docs).collect()}
    mix = mixing.mix(docs)
    assert mix.columns == docs.columns
    words = {}
    for r in mix.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {k: v for k, v in taken.items() if v}


def test_targets_are_shared_again(spark):
    sources = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 1000), (None, 0)], "m_source string, m_total long")
    got = {r.m_source: r.m_target for r in mixing.targets(sources).collect()}
    assert got["a"] == 3 and got[None] == 0
    assert got["b"] == pytest.approx(1998 * 2 / 5) and got["c"] == pytest.approx(1998 * 3 / 5)


def test_license_scan(docs, none):
    found = license_scan.licensed(docs)
    assert ids(found) == ALL
    rows = found.where("doc_id is null").collect()
    assert sorted((r.s_n_words, len(r.s_places), tuple(r.s_labels)) for r in rows) == [(0, 0, ()), (7, 1, ("cc-by-nc",))]
    assert license_scan.licensed(none).count() == 0


def test_license_with_words_put_in_is_still_found(spark):
    words = license_scan.NOTICES["mit"].split()
    near = " ".join([*words[:10], "really", *words[10:20], *words[21:]])
    cut = " ".join(words[:12])
    docs = spark.createDataFrame([(1, f"x {near} y"), (2, cut)], "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan.licensed(docs).collect()}
    assert rows[1].s_labels == ["mit"] and rows[2].s_labels == [] and 0 < rows[2].s_cover < 0.8


def test_line_dedup(docs, none):
    found = line_dedup.deduplicated(docs, min_words=20)
    assert ids(found) == ALL
    rows = {r.doc_id: r for r in found.where("doc_id is not null").collect()}
    line = LONG.split("\n")[0]
    # every place but the first of a two-line window goes, those that overlap it too
    assert rows[5].x_kept == f"{line}\n" and rows[5].x_n_lines == 20_000
    assert rows[2].x_kept == "" and rows[1].x_kept == PROSE.split("\n")[0] + "\n"
    assert rows[3].x_kept is None and rows[4].x_kept == "" and rows[6].x_kept == " \n\t\n "
    assert line_dedup.deduplicated(none).count() == 0


def test_runs_of_several_lines(spark):
    run = "one two three\nfour five six\n\nseven eight nine"
    docs = spark.createDataFrame([(1, f"head a\n{run}\ntail a"), (2, f"head b\n{run}\ntail b"), (3, "one two three\nsomething else\nseven eight nine")], "doc_id long, text string")
    rows = {r.doc_id: r.x_kept for r in line_dedup.deduplicated(docs, min_words=9).collect()}
    assert rows == {1: f"head a\n{run}\ntail a", 2: "head b\n\ntail b", 3: "one two three\nsomething else\nseven eight nine"}


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(1, "quick brown FOX"), (1, "kappa, alpha"), (2, None), (3, ""), (None, "und allein")], "item_id long, text string")
    for size in (1, 10**6):
        found = decontaminate.contaminated(docs, items, block_words=size)
        assert ids(found) == ALL
        rows = {r.doc_id: r for r in found.where("doc_id is not null").collect()}
        assert rows[5].d_items == ["1"] and len(rows[5].d_spans) == 19_999 and rows[5].d_n_words == 200_000
        assert rows[7].d_items == ["null"] and rows[3].d_n_words == rows[4].d_n_words == 0
        assert [tuple(s) for s in rows[1].d_spans][:1] == [(1, 4)] and rows[1].score == 0.5
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(docs, items.where("false")).where("size(d_spans) > 0").count() == 0
    clean = decontaminate.decontaminated(docs, items)
    assert clean.columns == docs.columns and ids(clean) == ALL
    assert "fox" not in {r.doc_id: r.text for r in clean.collect()}[2]


def test_near_dedup(docs, none):
    found = near_dedup.classes(docs)
    rows = {(r.n_id, r.n_raw): (r.n_first.id, r.n_size) for r in found.collect()}
    assert {k[0]: v for k, v in rows.items() if k[0] is not None} == {1: (1, 3), 2: (1, 3), 3: (3, 1), 4: (4, 1), 5: (5, 1), 6: (6, 1), 7: (7, 1)}
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted(["1", "3", "4", "5", "6", "7", "None", "None"])
    assert near_dedup.classes(none).count() == 0


def test_classifiers(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (5, 0, 0), (5, 1, 1), (7, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality_classifier.learn(docs, labels, epochs=2)
    found = quality_classifier.scored(docs, model)
    assert ids(found) == ALL and found.where("q_score < 0 or q_score > 1 or q_score is null").count() == 0
    assert {r.q_score for r in found.where("coalesce(text, '') = ''").collect()} == {0.0}
    assert quality_classifier.scored(none, model).count() == 0
    blank = quality_classifier.learn(docs, labels.where("false"))
    assert {r.q_score for r in quality_classifier.scored(docs, blank).where("text > ''").collect()} == {0.5}
    speech = language_id.learn(docs, epochs=2)
    assert speech["classes"] == ["de", "en"]
    said = language_id.identified(docs, speech)
    assert ids(said) == ALL
    assert {r.l_pred for r in said.where("text is null or text = '' or doc_id = 6").collect()} == {"und"}
    assert language_id.identified(none, speech).count() == 0
    mute = language_id.learn(none)
    assert {r.l_pred for r in language_id.identified(docs, mute).collect()} == {"und"}


def test_token_files(spark, docs, none):
    rows = token_files.tokenised(spark, docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ALL
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == [sum(q.n_tokens for q in rows[:k]) for k in range(len(rows))]
    assert [r.doc_id for r in rows] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7]
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 6)} == {1}
    assert token_files.tokenised(spark, none).count() == 0


def test_warc(spark, tmp_path):
    pages = [(1, "http://a/ b", "x" * 3), (1, "http://a/ b", "x" * 3), (2, None, "xxx"), (3, "http://c", None), (4, "http://d", ""), (None, "http://e", "xxx"), (None, None, "only é\r\n\r\nWARC/1.1\r\n\r\n"), (5, "u", LONG)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    target = str(tmp_path / "w")
    warc.write_warc(df.withColumn("w_digest", F.lit("clash")), target)
    got = warc.captures(warc.read_records(spark, target)).collect()
    assert len(got) == len(pages)
    kinds = sorted((str(g.metadata.text).strip(), g.response.record_type, g.response.payload_bytes) for g in got)
    size = len("only é\r\n\r\nWARC/1.1\r\n\r\n".encode())
    assert kinds == sorted([("page-id: 1", "response", 3), ("page-id: 1", "response", 3), ("page-id: 2", "revisit", 3), ("page-id: 3", "response", 0), ("page-id: 4", "revisit", 0), ("page-id:", "revisit", 3), ("page-id:", "response", size), ("page-id: 5", "response", len(LONG))])
    assert all(g.request.text.startswith("GET ") for g in got)
    whole = next(g for g in got if g.response.payload_bytes == len(LONG))
    assert bytes(whole.response.payload) == LONG.encode() and whole.response.intact
    assert hashlib.sha1(LONG.encode()).hexdigest()
    empty = str(tmp_path / "e")
    warc.write_warc(df.where("false"), empty)
    assert warc.captures(warc.read_records(spark, empty)).count() == 0


def test_a_line_is_split_at_white_space_once(spark):
    rows = line_dedup.line_rows(spark.createDataFrame([(1, "a b\nc")], "doc_id long, text string"), "doc_id", "text", 2)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(BLANKS) == 1
    assert [(r.x_at, r.x_lines) for r in rows.orderBy("x_at").collect()] == [(0, 1), (1, None)]
