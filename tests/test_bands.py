"""Matching within a tolerance where keys repeat, against the largest matching found by trying."""

import random

import pytest

from tablex import diff_cells
from tablex.operators import bands

TYPES = "g1 bigint, g2 bigint, t bigint, side int, copies bigint, h1 bigint, h2 bigint"
HUGE = 2**63 - 1


def largest(want, got, tolerance):
    """Augmenting paths: the size of the largest one-to-one matching."""
    partner = {}

    def place(i, seen):
        for j, t in enumerate(got):
            near = t is None and want[i] is None or None not in (t, want[i]) and abs(t - want[i]) <= tolerance
            if near and j not in seen:
                seen.add(j)
                if j not in partner or place(partner[j], seen):
                    partner[j] = i
                    return True
        return False

    return sum(place(i, set()) for i in range(len(want)))


@pytest.mark.parametrize("tolerance, spread, block", [(1, 8, 8), (3, 20, 4), (10, 60, 1024)])
def test_largest_matching(spark, monkeypatch, tolerance, spread, block):
    monkeypatch.setattr(bands, "BLOCK", block)
    rng, rows, sides = random.Random(tolerance * spread), [], {}
    for group in range(40):
        for side in (1, -1):
            for t in {rng.randint(-spread, spread) for _ in range(rng.randint(0, 14))} | ({None} if rng.random() < 0.2 else set()):
                copies = rng.choice([1, 1, 1, 2, 5])
                rows.append((group, 0, t, side, copies, len(rows), 0))
                sides.setdefault((group, side), []).extend([t] * copies)
    df = spark.createDataFrame(rows, TYPES)
    left = bands.without_partner(df, tolerance).collect()
    by_id = {row[5]: row for row in rows}
    assert all(0 < r.copies <= by_id[r.h1][4] for r in left)
    for group in range(40):
        want, got = sides.get((group, 1), []), sides.get((group, -1), [])
        matched = largest(want, got, tolerance)
        mine = {s: [by_id[r.h1][2] for r in left if by_id[r.h1][0] == group and r.side == s for _ in range(r.copies)] for s in (1, -1)}
        assert [len(mine[1]), len(mine[-1])] == [len(want) - matched, len(got) - matched]
        # What is left out can be left out: the others still match completely.
        for s, ts in mine.items():
            for t in ts:
                (want if s == 1 else got).remove(t)
        assert largest(want, got, tolerance) == matched


def test_a_dense_run_crosses_blocks(spark):
    """One group, an instant in every cell: each row of one side meets the next cell's; only the last is left."""
    rows = spark.sql(
        "SELECT 1L AS g1, 1L AS g2, id * 10 + CASE WHEN side = 1 THEN 0 ELSE 9 END AS t, side, 1L AS copies, id AS h1, CAST(side AS BIGINT) AS h2"
        " FROM range(5000), (SELECT explode(array(1, -1)) AS side) WHERE NOT (id = 0 AND side = -1)"
    )
    left = bands.without_partner(rows, 10).collect()
    assert [r.side for r in left] == [1]


def test_repeated_keys(spark):
    a = spark.sql("SELECT k, timestamp_micros(t) AS at, v FROM VALUES (1, 0L, 'x'), (1, 100L, 'x'), (1, 200L, 'x'), (2, 5L, 'y'), (2, 5L, 'y'), (3, NULL, 'z'), (3, NULL, 'z') AS t(k, t, v)")
    b = spark.sql("SELECT k, timestamp_micros(t) AS at, v FROM VALUES (1, 1L, 'x'), (1, 99L, 'x'), (1, 900L, 'x'), (2, 6L, 'y'), (2, 4L, 'w'), (3, NULL, 'z') AS t(k, t, v)")
    found = sorted((r.k, r.status, r.column or "", r.want or "", r.got or "", r.copies) for r in diff_cells(a, b, ["k"], tolerance_us=1).collect())
    assert found == [
        (1, "changed", "at", "200", "900", 1),
        (2, "changed", "v", "y", "w", 1),
        (3, "missing", "", '["3",null,"z"]', "", 1),
    ]


def test_extremes_agree_by_sign(spark):
    rows = [(1, 0, HUGE, 1, 2, 1, 0), (1, 0, HUGE - 5, -1, 1, 2, 0), (1, 0, -HUGE, -1, 1, 3, 0), (1, 0, 0, 1, 1, 4, 0)]
    left = bands.without_partner(spark.createDataFrame(rows, TYPES), 3).collect()
    assert sorted((r.h1, r.copies) for r in left) == [(1, 1), (3, 1), (4, 1)]


def test_no_rows(spark):
    assert bands.without_partner(spark.createDataFrame([], TYPES), 3).count() == 0
