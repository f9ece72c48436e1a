"""Maps are equal if their entries are, whatever order they print in, also within arrays, structs and maps."""

import pytest

from tablex import diff_cells, fingerprint

CASES = [
    ("map('a', 1, 'b', 2)", "map('b', 2, 'a', 1)", "map('b', 2, 'a', 3)"),
    ("map(1, map('x', array(1), 'y', NULL))", "map(1, map('y', NULL, 'x', array(1)))", "map(1, map('y', array(2), 'x', array(1)))"),
    ("array(map('a', 1.5D, 'b', 2D), NULL)", "array(map('b', 2D, 'a', 1.5D), NULL)", "array(map('b', 2D, 'a', 1.5D))"),
    ("named_struct('m', map('a', 1, 'b', 2), 'x', NULL)", "named_struct('m', map('b', 2, 'a', 1), 'x', NULL)", "named_struct('m', map('b', 2), 'x', NULL)"),
    ("map('a', named_struct('n', map(1, 2, 3, 4)))", "map('a', named_struct('n', map(3, 4, 1, 2)))", "map('a', named_struct('n', map(3, 4, 1, 5)))"),
]


@pytest.mark.parametrize("value, moved, other", CASES)
def test_entries_count(spark, value, moved, other):
    rows = lambda *texts: spark.sql(" UNION ALL ".join(f"SELECT {k} AS k, {t} AS m" for k, t in enumerate(texts)))
    want = rows(value, value, "NULL")
    assert diff_cells(want, rows(moved, moved, "NULL"), ["k"]).count() == 0
    assert fingerprint(want).first() == fingerprint(rows(moved, moved, "NULL")).first()
    found = diff_cells(want, rows(moved, other, value), ["k"]).collect()
    assert sorted((r.k, r.column) for r in found) == [(1, "m"), (2, "m")]
