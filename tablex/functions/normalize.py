"""Source values to portable Spark types: one projection, built from the declared types.

Casts are ANSI casts: a value its column's type cannot hold fails the job, and so does a text without the shape
the source database prints for its type. `refused` finds those texts by the same shapes and casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from tablex.functions.declared import Declared, Types, declared_columns, is_text, with_types
from tablex.functions.names import quoted, unique_columns
from tablex.functions.sourcetext import source_text, without_trailing_zeros
from tablex.functions.temporal import infinite_date, infinite_timestamp

# Fixed value: plain or scientific notation of a number.
NUMBER_TEXT = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
#: Exponents beyond this, far outside any database's numeric, fail.
MOST_POWER = 200_000

# Native input types a declared kind accepts besides text.
NATIVE = {
    "bool": (T.BooleanType,),
    "int32": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "int64": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float32": (T.FloatType,),
    "float64": (T.FloatType, T.DoubleType),
    "numeric": (T.DecimalType, T.IntegralType, T.FloatType, T.DoubleType),
    "date": (T.DateType,),
    "time": (T.TimeType,),
    "timestamp": (T.TimestampNTZType,),
    "timestamptz": (T.TimestampType,),
}


def malformed(what: str, c: str) -> str:
    return f"raise_error(concat('not a {what}: ', {c}))"


def strict(c: str, ok: str, value: str, to: str, what: str) -> str:
    """`value` for texts of the right shape; any other fails the job, and NULL stays."""
    return f"CASE WHEN {ok} THEN {value} WHEN {c} IS NOT NULL THEN CAST({malformed(what, c)} AS {to}) END"


def digits_of(c: str) -> str:
    """SQL condition: only digits, if any."""
    return f"translate({c}, '0123456789', '') = ''"


def number_shape(c: str) -> str:
    """The characters of a plain or scientific number, or a word: without blanks, hexadecimals and the suffixes the JVM parses."""
    return f"(translate({c}, '0123456789+-.eE', '') = '' OR lower({c}) IN ('nan', 'infinity', '-infinity'))"


def year_of_era(c: str) -> str:
    """`0044-03-15 BC` with the year as the number that the cast takes, -0043; other texts as they are."""
    before = f"CAST(CAST(substr({c}, 1, 4) AS INT) - 1 AS STRING)"
    moved = f"concat(CASE {before} WHEN '0' THEN '' ELSE '-' END, lpad({before}, 4, '0'), substr({c}, 5, length({c}) - 7))"
    return f"CASE WHEN endswith({c}, ' BC') AND {digits_of(f'substr({c}, 1, 4)')} THEN {moved} ELSE {c} END"


def date_shape(c: str) -> str:
    """Place of the dashes and length; the cast judges the digits. Years beyond 9999 have more of them."""
    starts = f"substr({c}, 1, 1) BETWEEN '0' AND '9'"
    iso = f"length({c}) BETWEEN 10 AND 13 AND substr({c}, -3, 1) = '-' AND substr({c}, -6, 1) = '-' AND substr({c}, -1) BETWEEN '0' AND '9'"
    era = f"endswith({c}, ' BC') AND length({c}) = 13 AND substr({c}, 5, 1) = '-' AND substr({c}, 8, 1) = '-'"
    return f"({starts} AND ({iso} OR {era}))"


def date_of(c: str) -> str:
    """Text to a date; a text that also carries a time of day is not a date."""
    words = f"WHEN {c} = 'infinity' THEN {infinite_date(1)} WHEN {c} = '-infinity' THEN {infinite_date(-1)}"
    return (
        f"CASE WHEN {date_shape(c)} THEN CAST({year_of_era(c)} AS DATE) {words}"
        f" WHEN {c} IS NOT NULL THEN CAST({malformed('date', c)} AS DATE) END"
    )


# Fixed value: date and clock of a moment whose year has more than four digits.
LONG_MOMENT = "^[0-9]{5,6}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}"


def moment_shape(c: str, zoned: bool) -> str:
    """Date, separator and clock in their places, and an offset behind them if, and only if, the type has a time zone."""
    text = f"CASE WHEN endswith({c}, ' BC') THEN substr({c}, 1, length({c}) - 3) ELSE {c} END"
    marks = [(5, "('-')"), (8, "('-')"), (11, "(' ', 'T')"), (14, "(':')"), (17, "(':')")]
    places = " AND ".join(f"substr({c}, {at}, 1) IN {mark}" for at, mark in marks)
    rest = f"substr({text}, 20)"
    if zoned:
        tail = f"{rest} <> '' AND translate({rest}, '0123456789.:+-Zz', '') = '' AND (contains({rest}, '+') OR contains({rest}, '-') OR substr({rest}, -1) IN ('Z', 'z'))"
        long_tail = "([.][0-9]{1,6})?([+-][0-9:]+|[zZ])$"
    else:
        tail = f"({rest} = '' OR startswith({rest}, '.') AND length({rest}) BETWEEN 2 AND 7 AND {digits_of(f'substr({rest}, 2)')})"
        long_tail = "([.][0-9]{1,6})?$"
    starts = f"length({text}) >= 19 AND substr({c}, 1, 1) BETWEEN '0' AND '9'"
    return f"({starts} AND {places} AND {tail} OR {c} RLIKE '{LONG_MOMENT}{long_tail}')"


def timestamp_of(c: str, to: str) -> str:
    """Text to a moment: a bare date or clock, or a zone where there should be none, is refused, and so is a missing one."""
    zoned = to == "timestamp"
    what = "timestamp with time zone" if zoned else "timestamp without time zone"
    value = strict(c, moment_shape(c, zoned), f"CAST({year_of_era(c)} AS {to})", to, what)
    return (
        f"CASE {c} WHEN 'infinity' THEN {infinite_timestamp(1, to)}"
        f" WHEN '-infinity' THEN {infinite_timestamp(-1, to)} ELSE {value} END"
    )


def time_shape(c: str) -> str:
    """Hours, minutes and seconds; 24:00:00, the end of a day, is no time of a day."""
    return f"(length({c}) BETWEEN 8 AND 15 AND substr({c}, 3, 1) = ':' AND substr({c}, 6, 1) = ':' AND substr({c}, 1, 1) BETWEEN '0' AND '2' AND substr({c}, -1) BETWEEN '0' AND '9' AND {c} < '24')"


def cut_decimal(c: str, scale: int, to: str) -> str:
    """Digits beyond the declared scale are dropped, toward zero."""
    return f"CAST(CASE WHEN {c} >= 0 THEN floor({c}, {scale}) ELSE ceil({c}, {scale}) END AS {to})"


def exact_numeric(c: str, dtype: T.DataType, kind: Declared) -> str:
    """numeric(p,s) as decimal(p,s); a decimal holds no NaN or infinity, they become NULL."""
    to, scale = kind.spark_type(decimal=True).simpleString(), kind.scale
    wide = cut_decimal(f"CAST({c} AS DECIMAL(38,18))", scale, to)
    if is_text(dtype):
        point = f"instr({c}, '.')"
        cut = f"CASE WHEN {point} > 0 THEN substr({c}, 1, {point} + {scale}) ELSE {c} END"
        return (
            f"CASE WHEN {c} IN ('NaN', 'Infinity', '-Infinity') THEN NULL"
            f" WHEN NOT {c} RLIKE '{NUMBER_TEXT}' THEN CAST({malformed('number', c)} AS {to})"
            f" WHEN contains(lower({c}), 'e') THEN {wide} ELSE CAST({cut} AS {to}) END"
        )
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"CASE WHEN NOT isnan({c}) AND abs({c}) < double('Infinity') THEN {wide} END"
    if isinstance(dtype, T.DecimalType) and dtype.scale > scale:
        return cut_decimal(c, scale, to)
    return f"CAST({c} AS {to})"


def plain_numeric(c: str, dtype: T.DataType) -> str:
    """A numeric as plain digits without trailing zeros; NaN and the infinities as words."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"CAST({c} AS DOUBLE)"  # the text of floats is the sink's
    if not is_text(dtype):
        return without_trailing_zeros(f"CAST({c} AS STRING)")
    return (
        f"CASE WHEN {c} IN ('NaN', 'Infinity', '-Infinity') THEN {c}"
        f" WHEN NOT {c} RLIKE '{NUMBER_TEXT}' THEN {malformed('number', c)}"
        f" WHEN contains(lower({c}), 'e') THEN {shifted(c)} ELSE {without_trailing_zeros(c)} END"
    )


def shifted(c: str) -> str:
    """A number text in scientific notation as plain digits, none lost: the point is moved by the exponent."""
    mantissa, power = f"ltrim('+-', substring_index(lower({c}), 'e', 1))", f"CAST(substring_index(lower({c}), 'e', -1) AS INT)"
    digits, place = f"replace({mantissa}, '.', '')", f"(length(substring_index({mantissa}, '.', 1)) + {power})"
    moved = (
        f"CASE WHEN {place} <= 0 THEN concat('.', repeat('0', -{place}), {digits})"
        f" WHEN {place} >= length({digits}) THEN concat({digits}, repeat('0', {place} - length({digits})))"
        f" ELSE concat(substr({digits}, 1, {place}), '.', substr({digits}, {place} + 1)) END"
    )
    bare = f"ltrim('0', {without_trailing_zeros(f'({moved})')})"
    sign = f"CASE WHEN startswith({c}, '-') THEN '-' ELSE '' END"
    return (
        f"CASE WHEN abs({power}) > {MOST_POWER} THEN {malformed('number', c)} WHEN {digits} RLIKE '^0*$' THEN '0'"
        f" ELSE concat({sign}, CASE WHEN startswith({bare}, '.') THEN '0' ELSE '' END, {bare}) END"
    )


def portable(c: str, dtype: T.DataType, kind: Declared, decimal: bool = False, plain: bool = False) -> str:
    """One column in its portable type."""
    if kind.kind == "char":
        return f"rtrim({source_text(c, dtype)})"
    if kind.kind == "text":
        return source_text(c, dtype)
    text = is_text(dtype)
    if not text and not isinstance(dtype, NATIVE[kind.kind]):
        raise TypeError(f"column {c}: {dtype.simpleString()} values, declared {kind.name}")
    if plain and kind.kind == "numeric":
        return plain_numeric(c, dtype)
    if decimal and kind.exact:
        return exact_numeric(c, dtype, kind)
    target = kind.spark_type()
    to = target.simpleString()
    if text and kind.kind in ("float32", "float64", "numeric"):
        return strict(c, number_shape(c), f"CAST({c} AS {to})", to, "number")
    if text and kind.kind == "date":
        return date_of(c)
    if text and kind.kind in ("timestamp", "timestamptz"):
        return timestamp_of(c, to)
    if text and kind.kind == "time":
        return strict(c, time_shape(c), f"CAST({c} AS {to})", to, "time of day")
    return c if dtype == target else f"CAST({c} AS {to})"


def normalize(df: DataFrame, types: Types = None, decimal: bool = False, plain: bool = False) -> DataFrame:
    """Every column in its portable type, repeated names told apart.

    types   declared types by name (mapping) or by position (pairs); a column without one
            keeps the type its Spark type stands for
    decimal numeric(p,s) up to 16 digits as exact decimals instead of doubles
    plain   every numeric as text of plain digits, for sinks of text; digits are never rounded
    """
    df = unique_columns(df)
    kinds = declared_columns(df, types)
    columns = []
    for field, kind in zip(df.schema, kinds):
        name = quoted(field.name)
        columns.append(f"{portable(name, field.dataType, kind, decimal, plain)} AS {name}")
    return with_types(df.selectExpr(*columns), [kind.name for kind in kinds])


def refusal(c: str, kind: Declared, decimal: bool = False, plain: bool = False) -> str:
    """SQL condition, never NULL: would `normalize` refuse this text for its declared type?

    The shapes are those `normalize` asks for, and the casts its own, tried.
    """
    to = kind.spark_type(decimal=decimal).simpleString()
    tried, words = f"try_cast({c} AS {to}) IS NOT NULL", f"{c} IN ('infinity', '-infinity')"
    if kind.kind in ("char", "text"):
        return "false"
    if kind.kind == "numeric" and (plain or decimal and kind.exact):
        ok = f"{c} RLIKE '{NUMBER_TEXT}'"
        if plain:
            power = f"try_cast(substring_index(lower({c}), 'e', -1) AS INT)"
            ok = f"{ok} AND (NOT contains(lower({c}), 'e') OR coalesce(abs({power}) <= {MOST_POWER}, false))"
        else:
            ok = f"CASE WHEN {ok} THEN ({exact_numeric(c, T.StringType(), kind).replace('CAST(', 'try_cast(')}) IS NOT NULL END"
        ok = f"{c} IN ('NaN', 'Infinity', '-Infinity') OR {ok}"
    elif kind.kind in ("float32", "float64", "numeric"):
        ok = f"{number_shape(c)} AND {tried}"
    elif kind.kind == "date":
        ok = f"{words} OR {date_shape(c)} AND try_cast({year_of_era(c)} AS {to}) IS NOT NULL"
    elif kind.kind in ("timestamp", "timestamptz"):
        ok = f"{words} OR {moment_shape(c, kind.kind == 'timestamptz')} AND try_cast({year_of_era(c)} AS {to}) IS NOT NULL"
    elif kind.kind == "time":
        ok = f"{time_shape(c)} AND {tried}"
    else:
        ok = tried
    return f"({c} IS NOT NULL AND NOT coalesce({ok}, false))"


def refused(df: DataFrame, types: Types, decimal: bool = False, plain: bool = False) -> DataFrame:
    """The rows of text columns that `normalize` with these options would fail on, with the names of the columns in `refused`.

    For a look at a dump that does not load; an integer is also tried against the range of its type.
    """
    df = unique_columns(df)
    kinds = declared_columns(df, types)
    names = [
        f"CASE WHEN {refusal(quoted(f.name), kind, decimal, plain)} THEN '{f.name}' END".replace("\\", "\\\\")
        for f, kind in zip(df.schema, kinds)
        if is_text(f.dataType)
    ]
    return df.selectExpr("*", f"array_compact(array({', '.join(names)})) AS refused").where("size(refused) > 0")
