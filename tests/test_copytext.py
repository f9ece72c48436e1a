import re
from pathlib import Path

import pytest

from tablex import normalize, read_copy, read_types, scan, write_copy
from tablex.plans.profiles import TABLES
from tablex.sinks.copytext import dump_types

SIMPLE = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}


def decoded(field):
    """The rule, character by character."""
    if field == "\\N":
        return None
    token = re.compile(r"\\([0-7]{1,3})|\\(.)|([^\\]+|\\$)", re.S)
    out = []
    for octal, letter, plain in token.findall(field):
        out.append(chr(int(octal, 8)) if octal else SIMPLE.get(letter, letter) if letter else plain)
    return "".join(out)


FIELDS = [
    "", "plain", r"\N", r"\\N", r"a\tb\nc", r"\\", r"\\\\", r"\\\n", r"\\n", r"a\\\\tb", r"\b\f\v\r",
    r"\101", r"\1018", r"\7z", r"\134n", r"\134", r"\q\z", r"tail\\", "é\\\\漢字 🎉", r"\303", r"\777x",
    r"\x41", r"a\Nb", r"\0115", "lone\\",
]


def test_unescape_matches_the_rule(spark, tmp_path):
    file = tmp_path / "dump"
    file.write_text("".join(f"{i}\t{f}\n" for i, f in enumerate(FIELDS)), encoding="utf-8")
    df = read_copy(spark, str(file), [("i", "integer"), ("s", "text")])
    got = [r.s for r in sorted(df.collect(), key=lambda r: int(r.i))]
    assert got == [decoded(f) for f in FIELDS]


def test_types_file_and_repeated_names(spark, tmp_path):
    (tmp_path / "t.desc").write_text("id\tinteger\nid\tnumeric(10,2)\ns\tcharacter(4)\n")
    (tmp_path / "t.copy").write_text("1\t2.50\tAB  \n\\N\t\\N\t\\N\n")
    types = read_types(spark, str(tmp_path / "t.desc"))
    assert types == [("id", "integer"), ("id", "numeric(10,2)"), ("s", "character(4)")]
    out = normalize(read_copy(spark, str(tmp_path / "t.copy"), types), types)
    assert out.columns == ["id", "id_1", "s"]
    assert [tuple(r) for r in out.collect()] == [(1, 2.5, "AB"), (None, None, None)]


@pytest.mark.parametrize("line", ["1", "1\t2\t3"])
def test_wrong_number_of_fields_fails(spark, tmp_path, line):
    (tmp_path / "d").write_text(line + "\n")
    with pytest.raises(Exception, match="want 2 fields"):
        read_copy(spark, str(tmp_path / "d"), [("a", "text"), ("b", "text")]).collect()


def test_written_dump_has_the_documented_form(spark, tmp_path):
    df = spark.sql(
        "SELECT true AS b, 'tab\there\nline \\\\ back' AS s, CAST(NULL AS INT) AS n, '' AS e, "
        "array(1, NULL) AS a, timestamp'2020-01-02 03:04:05' AS tz, '\\\\N' AS t"
    )
    assert write_copy(df, str(tmp_path / "d")) == 1
    text = "".join(p.read_text() for p in Path(tmp_path / "d").glob("part-*"))
    assert text == "t\ttab\\there\\nline \\\\ back\t\\N\t\t{1,NULL}\t2020-01-02 03:04:05+00\t\\\\N\n"


@pytest.mark.parametrize("table", TABLES)
def test_every_table_survives_the_dump(spark, small, tmp_path, table):
    df = scan(spark, small, table)
    write_copy(df, str(tmp_path / "d"))
    types = dump_types(df)
    back = normalize(read_copy(spark, str(tmp_path / "d"), types), types)
    want = normalize(df)
    assert back.dtypes == want.dtypes
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()
