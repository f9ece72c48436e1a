"""One dump with every declared type through reading, normalising, writing and reading back."""

import math
from decimal import Decimal

import pytest

from tablex import (
    actual_kinds,
    encode_temporal,
    expected_kinds,
    normalize,
    read_copy,
    read_export,
    reconcile,
    verdict,
    write,
)

DAYS, MICROS = 2**31 - 1, 2**63 - 1

# (name, declared type, texts of an ordinary row, of one at the upper and one at the lower end, of a
# row without numbers, and of one without values). The limits of types are fixed values.
COLUMNS = [
    ("row", "integer", "10", "20", "30", "40", "50"),
    ("paid", "boolean", "f", "t", "f", "t", None),
    ("floor", "smallint", "12", "32767", "-32768", None, None),
    ("visits", "bigint", "417", "9223372036854775807", "-9223372036854775808", None, None),
    ("slope", "real", "0.375", "Infinity", "-2.5e-10", "NaN", None),
    ("mass", "double precision", "-7.25", "-0", "-Infinity", "NaN", None),
    ("quote", "numeric", "88.125", "Infinity", "-Infinity", "NaN", None),
    ("toll", "numeric(6,1)", "305.5", "99999.9", "-99999.9", "NaN", None),
    ("index", "numeric(16,6)", "4096.000244", "9999999999.999999", "-0.000001", None, None),
    ("total", "numeric(20,3)", "31415926535.897", "1e12", "-2.000", None, None),
    ("opened", "date", "1987-11-23", "infinity", "0333-03-03", None, None),
    ("logged", "timestamp without time zone", "1987-11-23 18:30:15.25", "2525-05-25 05:05:05", "-infinity", None, None),
    ("posted", "timestamp with time zone", "1987-11-23 18:30:15.25+03", "infinity", "0333-03-03 00:00:00-07:30", None, None),
    ("shift", "time without time zone", "18:30:15.25", "23:59:59.999999", "00:00:00", None, None),
    ("motto", "text", "Čest – práci", r"one\ttwo\nthree \\ four", "", "   ", None),
    ("grade", "character(5)", "B+   ", "AAAAA", "     ", "  C  ", None),
    ("extra", "jsonb", '{"paths": ["/x", "/y"]}', "3", '""', "null", None),
    ("hops", "integer[]", "{7,NULL,9}", "{{0},{1}}", "{}", None, None),
    ("unused", "integer", None, None, None, None, None),
    ("Two Words", "text", "left right", "q", "", "r", None),
    ("dot.ted", "integer", "5", "-5", "0", None, None),
    ("naïve", "text", "ï", "ñ", "ü", "", None),
]
TYPES = [(name, type_name) for name, type_name, *_ in COLUMNS]


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    file = tmp_path_factory.mktemp("types") / "types.copy"
    rows = zip(*[values for _, _, *values in COLUMNS])
    lines = ["\t".join("\\N" if v is None else v for v in row) for row in rows]
    file.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(file)


@pytest.fixture(params=[False, True], ids=["double", "decimal"])
def decimal(request):
    return request.param


def test_values(spark, dump, decimal):
    out = encode_temporal(normalize(read_copy(spark, dump, TYPES), TYPES, decimal))
    rows = {r["row"]: r.asDict() for r in out.collect()}
    column = {name: [rows[i][name] for i in range(10, 60, 10)] for name in out.columns}
    assert column["visits"] == [417, 2**63 - 1, -(2**63), None, None]
    assert column["mass"][:3] == [-7.25, 0.0, -math.inf] and math.copysign(1, column["mass"][1]) == -1
    assert math.isnan(column["mass"][3]) and math.isnan(column["slope"][3]) and column["slope"][:2] == [0.375, math.inf]
    assert column["quote"][:3] == [88.125, math.inf, -math.inf]
    if decimal:
        assert column["index"][:3] == [Decimal("4096.000244"), Decimal("9999999999.999999"), Decimal("-0.000001")]
        assert column["toll"] == [Decimal("305.5"), Decimal("99999.9"), Decimal("-99999.9"), None, None]
    else:
        assert column["index"][:3] == [4096.000244, 9999999999.999999, -0.000001]
        assert math.isnan(column["toll"][3])
    assert column["total"] == [31415926535.897, 1e12, -2.0, None, None]
    day = 6535
    assert column["opened"][:2] == [day, DAYS] and column["opened"][3:] == [None, None]
    moment = (day * 86400 + 66615) * 10**6 + 250000
    assert column["logged"][0] == moment and column["logged"][2:] == [-MICROS, None, None]
    assert column["posted"] == [moment - 3 * 3600 * 10**6, MICROS, column["opened"][2] * 86400 * 10**6 + 27000 * 10**6, None, None]
    assert column["shift"] == [66615250000, 86399999999, 0, None, None]
    assert column["motto"] == ["Čest – práci", "one\ttwo\nthree \\ four", "", "   ", None]
    assert column["grade"] == ["B+", "AAAAA", "", "  C", None]
    assert column["hops"] == ["{7,NULL,9}", "{{0},{1}}", "{}", None, None]
    assert column["unused"] == [None] * 5
    assert column["naïve"] == ["ï", "ñ", "ü", "", None]


def test_kinds_are_as_declared(spark, dump, decimal):
    out = normalize(read_copy(spark, dump, TYPES), TYPES, decimal)
    declared = spark.createDataFrame(TYPES, "name string, type string")
    want = {r.name: r.kind for r in expected_kinds(declared, decimal).collect()}
    assert {r.name: r.kind for r in actual_kinds(out).collect()} == want


def test_export_equals_source(spark, dump, decimal, tmp_path):
    source = normalize(read_copy(spark, dump, TYPES), TYPES, decimal)
    path = str(tmp_path / "types.parquet")
    assert write(source, path) == 5
    assert verdict(reconcile(spark, {"types": (source, read_export(spark, path), ["row"])})).first().equal


def test_infinities_sort_at_the_ends(spark, dump):
    source = normalize(read_copy(spark, dump, TYPES), TYPES)
    ends = source.selectExpr("max(opened) AS opened", "min(logged) AS logged", "max(posted) AS posted", "max(logged) AS late")
    assert tuple(encode_temporal(ends).first())[:3] == (DAYS, -MICROS, MICROS)
