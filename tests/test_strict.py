"""`refused` names exactly the texts that `normalize` fails on."""

import random
from datetime import date, datetime

import pytest

from tablex import encode_temporal, normalize
from tablex.functions.normalize import refused

GOOD = {
    "double precision": ["1.5", "-0", "+.5", "5.", "1e300", "-1.25E-7", "NaN", "Infinity", "-infinity"],
    "numeric": ["1.5", "NaN", "-Infinity", "123456789012345678901234567890"],
    "numeric(10,2)": ["99999999.99", "-12.345", "1e3", "NaN", "0.009"],
    "integer": ["5", "-2147483648", "+7"],
    "date": ["2020-01-01", "0001-01-01", "9999-12-31", "12345-06-07", "infinity", "-infinity", "0044-03-15 BC", "0001-12-31 BC"],
    "timestamp without time zone": ["2020-01-01 10:00:00", "2020-01-01T10:00:00.5", "1999-12-31 23:59:59.999999", "12345-01-02 03:04:05", "infinity", "0044-03-15 10:00:00 BC"],
    "timestamp with time zone": ["2020-01-01 10:00:00+00", "2020-01-01 10:00:00.25-05", "2020-01-01 10:00:00+05:30", "1883-01-01 00:00:00-04:56:02", "2020-01-01T10:00:00Z", "-infinity", "0044-03-15 10:00:00+00 BC"],
    "time without time zone": ["00:00:00", "23:59:59.999999", "09:30:00"],
    "boolean": ["t", "false"],
}
BAD = {
    "double precision": [" 1.5 ", "0x1p3", "1.5d", "1.5F", "", "1e", "--1", "one", "1,5", "1.5\n"],
    "numeric": [" 1.5", "0x10", "1.5f", "nought"],
    "numeric(10,2)": ["99999999999.5", "1e9", " 1.5", "Inf", "1.2.3"],
    "integer": ["2147483648", "1.5", "x", ""],
    "date": [" 2020-01-01", "2020-01-01 10:00:00", "2020-1-1", "2020-02-30", "20200101", "2020", "today", "2020-01-01 AD", "044-03-15 BC", "2020-13-01 BC"],
    "timestamp without time zone": [
        "2020-01-01 10:00:00 UTC", "2020-01-01 10:00:00 Europe/Berlin", "2020-01-01 10:00:00EST", "2020-01-01 10:00:00+00", "2020-01-01 10:00:00-05", "2020-01-01T10:00:00Z",
        "2020", "2020-01-01", "10:00:00", "2020-01-01 10:00", "2020-01-01 25:00:00", "2020-01-01 10:00:00.", "2020-01-01 10:00:00.1234567", " 2020-01-01 10:00:00", "12345-01-02 03:04:05+00",
    ],
    "timestamp with time zone": ["2020-01-01 10:00:00", "10:00:00", "10:00:00+00", "2020", "2020-01-01", "2020-01-01 10:00:00 UTC", "2020-01-01 10:00:00EST", "2020-01-01 10:00:00+", "2020-01-01 10:00:00+99", "12345-01-02 03:04:05"],
    "time without time zone": ["24:00:00", "9:30:00", "09:30", "10:00:00+00", "10:00:00 ", "now", "29:00:00", "10:61:00"],
    "boolean": ["maybe", ""],
}


def listed(spark, kind, texts, decimal=False):
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    return {r.c for r in refused(df, {"c": kind}, decimal).collect()}


def fails(spark, kind, text, decimal=False):
    try:
        encode_temporal(normalize(spark.createDataFrame([(text,)], "c string"), {"c": kind}, decimal)).collect()
    except Exception:
        return True
    return False


@pytest.mark.parametrize("kind", GOOD)
def test_good_and_bad_texts(spark, kind):
    decimal = kind == "numeric(10,2)"
    assert listed(spark, kind, GOOD[kind] + BAD[kind], decimal) == set(BAD[kind])
    df = spark.createDataFrame([(t,) for t in [*GOOD[kind], None]], "c string")
    assert encode_temporal(normalize(df, {"c": kind}, decimal)).count() == len(GOOD[kind]) + 1
    for text in BAD[kind]:
        assert fails(spark, kind, text, decimal), text


@pytest.mark.parametrize("kind", GOOD)
def test_random_texts(spark, kind):
    """Good texts with a character changed, left out or put in."""
    rng, texts, decimal = random.Random(kind), set(), kind.startswith("numeric(")
    while len(texts) < 60:
        t = list(rng.choice(GOOD[kind]))
        at = rng.randrange(len(t))
        t[at : at + rng.randrange(2)] = rng.choice(["", rng.choice("0159 -+:.eETZxd")])
        texts.add("".join(t))
    bad = listed(spark, kind, sorted(texts), decimal)
    df = spark.createDataFrame([(t,) for t in sorted(texts - bad)], "c string")
    assert len(encode_temporal(normalize(df, {"c": kind}, decimal)).collect()) == len(texts - bad)
    for text in sorted(bad)[:15]:
        assert fails(spark, kind, text, decimal), text


def test_values(spark):
    one = lambda kind, text: encode_temporal(normalize(spark.createDataFrame([(text,)], "c string"), {"c": kind})).first().c
    days = lambda y, m, d: (date(y, m, d) - date(1970, 1, 1)).days
    # 400 years have 146,097 days, and 44 BC is the year -43: 357 eight years before 2000 less five cycles.
    assert one("date", "0044-03-15 BC") == days(1957, 3, 15) - 5 * 146_097
    assert one("date", "0001-03-01 BC") == days(2000, 3, 1) - 5 * 146_097
    micros = lambda t: int((t - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    assert one("timestamp without time zone", "0044-03-15 10:00:00.000001 BC") == micros(datetime(1957, 3, 15, 10)) - 5 * 146_097 * 86_400_000_000 + 1
    assert one("timestamp with time zone", "2020-01-01 10:00:00-05:30") == micros(datetime(2020, 1, 1, 15, 30))
