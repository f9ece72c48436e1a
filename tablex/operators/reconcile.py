"""Does an export equal its source? Schema, counts, cells, and content fingerprints."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tablex.functions.declared import actual_kinds, reader_label
from tablex.functions.equality import MOMENT, comparable, comparable_text, near, row_hash, row_text
from tablex.functions.names import quoted, unique_columns
from tablex.operators.bands import without_partner
from tablex.operators.sketch import surplus_by_sketch
from tablex.session import configure, stored


def diff_schema(
    expected: DataFrame, actual: DataFrame, accepted: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """Dictionary rows (ordinal, name, kind) that differ, paired by ordinal; a missing side is NULL.

    accepted    (expected, actual) kinds that pass as equal, for a reader that cannot tell them
                apart, such as ("timestamptz", "timestamp")
    """
    want = expected.selectExpr("ordinal", "name AS want_name", "kind AS want_kind")
    got = actual.selectExpr("ordinal", "name AS got_name", "kind AS got_kind")
    kinds = "want_kind <=> got_kind"
    for a, b in accepted:
        kinds += f" OR want_kind <=> '{a}' AND got_kind <=> '{b}'"
    return want.join(got, "ordinal", "full").where(f"NOT (want_name <=> got_name AND ({kinds}))")


def diff_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: both row counts, and whether they agree."""
    tagged = a.select(F.lit(1).alias("want")).unionAll(b.select(F.lit(0).alias("want")))
    counts = tagged.agg(
        F.coalesce(F.sum("want"), F.lit(0)).alias("want_rows"),
        F.coalesce(F.sum(1 - F.col("want")), F.lit(0)).alias("got_rows"),
    )
    return counts.withColumn("equal", F.col("want_rows") == F.col("got_rows"))


def hash_pair(fields: Iterable[T.StructField], name: str) -> list[str]:
    """128 bits of a row, as two bigints."""
    fields = list(fields)
    return [f"{row_hash(fields, seed)} AS {name}{seed}" for seed in (1, 2)]


def unmatched_hashes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row hashes that one side holds more often than the other, with the surplus of a.

    Only 20 bytes per row are shuffled, and copies of a row are counted before that.
    """

    def hashed(df: DataFrame, weight: int) -> DataFrame:
        return df.selectExpr(*hash_pair(df.schema, "h"), f"{weight} AS weight")

    both = hashed(a, 1).unionAll(hashed(b, -1))
    surplus = both.groupBy("h1", "h2").agg(F.sum("weight").alias("surplus"))
    return surplus.where(F.col("surplus") != 0)


# A frequent row is spread over so many tasks when it meets its hash.
SALTS = 8


def text_rows(df: DataFrame, keys: Sequence[str], more: Sequence[str] = ()) -> DataFrame:
    """Row hash, key hash, keys and cells as text."""
    cells = [comparable_text(quoted(f.name), f.dataType) for f in df.schema]
    return df.selectExpr(
        *hash_pair(df.schema, "h"),
        *hash_pair([df.schema[k] for k in keys], "k"),
        f"struct({', '.join(map(quoted, keys))}) AS key",
        f"array({', '.join(cells)}) AS cells",
        *more,
    )


def surplus_rows(df: DataFrame, hashes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per distinct unmatched row: keys, key hash, cells as text, copies.

    The hashes are a stored table: Spark broadcasts it if its size allows, else shuffles. Copies of a
    row meet its hash in several tasks, and are reduced to one before they are shuffled again.
    """
    salted = hashes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    found = text_rows(df, keys).withColumn("salt", salt).join(salted, ["h1", "h2", "salt"]).drop("salt")
    return found.dropDuplicates(["h1", "h2"]).withColumnRenamed("surplus", "copies")


def far_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance_us: int) -> DataFrame:
    """Key hashes whose rows differ by more than the tolerance.

    Moments are left out of the row hash and compared by themselves: rows a microsecond apart cost a key
    hash, a row hash and their moments each, not their whole text. A key with several rows on a side is far.
    """
    moments = [f.name for f in a.schema if isinstance(f.dataType, MOMENT)]

    def side(df: DataFrame, name: str) -> DataFrame:
        rest = [f for f in df.schema if f.name not in moments]
        instants = ", ".join(comparable(quoted(m), df.schema[m].dataType) for m in moments)
        rows = df.selectExpr(*hash_pair([df.schema[k] for k in keys], "k"), f"struct({row_hash(rest, 1)}, {row_hash(rest, 2)}, array({instants})) AS row")
        return rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias(f"{name}_rows"), F.max("row").alias(name))

    both = side(a, "want").join(side(b, "got"), ["k1", "k2"], "full")
    close = [
        f"coalesce({near(f'want.col3[{i}]', f'got.col3[{i}]', tolerance_us)}, want.col3[{i}] IS NULL AND got.col3[{i}] IS NULL)"
        for i in range(len(moments))
    ]
    alike = " AND ".join(["want_rows = 1", "got_rows = 1", "want.col1 = got.col1", "want.col2 = got.col2", *close])
    return both.where(f"NOT coalesce({alike}, false)").select("k1", "k2")


def key_rows(df: DataFrame, far: DataFrame, keys: Sequence[str], beside: Callable[[DataFrame, Sequence[str]], list[str]] | None = None) -> DataFrame:
    """The distinct rows of some keys, with their number of copies and, if given, what `beside` adds to each."""
    more = beside(df, keys) if beside else []
    found = text_rows(df, keys, more).join(far, ["k1", "k2"], "left_semi")
    kept = ("k1", "k2", "key", "cells", *(("g1", "g2", "t") if more else ()))
    return found.groupBy("h1", "h2").agg(*[F.first(c).alias(c) for c in kept], F.count(F.lit(1)).alias("copies"))


def within_tolerance(rows: DataFrame, tolerance_us: int) -> DataFrame:
    """Rows of `key_rows` less those that have a partner within the tolerance, one to one."""
    return without_partner(rows.withColumn("side", F.when(F.col("side") == "want", 1).otherwise(-1)), tolerance_us).withColumn(
        "side", F.when(F.col("side") == 1, "want").otherwise("got")
    )


def free_moments(schema: T.StructType, keys: Sequence[str]) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, MOMENT) and f.name not in keys]


def grouped(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """What rows within a tolerance must have in common, as g1 and g2, and their one instant t."""
    moment = df.schema[free_moments(df.schema, keys)[0]]
    rest = [f for f in df.schema if f.name != moment.name]
    return [*hash_pair(rest, "g"), f"CAST({comparable(quoted(moment.name), moment.dataType)} AS BIGINT) AS t"]


def diff_cells(
    a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance_us: int = 0, sketch: bool = False
) -> DataFrame:
    """Differences of b (got) from a (want): key columns, status, column, want, got, copies.

    changed     the cell of `column` differs between the two rows of a key
    missing     a row only a has; extra: a row only b has. `want` or `got` is the whole row

    Rows equal on both sides cancel out first, by hash, copy by copy. What is left is paired by
    key; where a key still has several rows on a side, its rows are reported whole, for there is
    no telling which became which. Values print in their comparable form: temporal ones as
    integers. What is left is stored twice on the way, first its hashes and then its rows, so
    each table is read twice and only hashes of it are shuffled as a rule.

    tolerance_us    timestamps this close are the same. Where a key has several rows and rows have one timestamp (keys
                    apart), they are matched one to one, as many as possible; with several, keys must identify rows
    sketch          find the unequal hashes from sketches as large as the difference (see `sketch`): for large
                    tables that hardly differ. Each table is read once more, and no hash of it is shuffled;
                    where the difference turns out too large, hashes are shuffled after all
    """
    a, b = unique_columns(a), unique_columns(b)
    if a.columns != b.columns:
        raise ValueError(f"columns differ: {a.columns} and {b.columns}")
    configure(a.sparkSession)
    if tolerance_us and any(isinstance(f.dataType, MOMENT) for f in a.schema):
        far = stored(far_keys(a, b, keys, tolerance_us), "keys")
        beside = grouped if len(free_moments(a.schema, keys)) == 1 else None
        want, got = key_rows(a, far, keys, beside), key_rows(b, far, keys, beside)
    else:
        found = surplus_by_sketch(a, b) if sketch else None
        hashes = stored(unmatched_hashes(a, b) if found is None else found, "hashes")
        want = surplus_rows(a, hashes.where("surplus > 0"), keys)
        got = surplus_rows(b, hashes.where("surplus < 0").withColumn("surplus", -F.col("surplus")), keys)
    want, got = want.withColumn("side", F.lit("want")), got.withColumn("side", F.lit("got"))
    rows = want.unionByName(got)
    rest = stored(within_tolerance(rows, tolerance_us) if "t" in rows.columns else rows, "rest")

    def side(name: str, value: Column) -> Column:
        return F.when(F.col("side") == name, value)

    per_key = rest.groupBy("k1", "k2").agg(
        F.coalesce(F.sum(side("want", F.col("copies"))), F.lit(0)).alias("want_copies"),
        F.coalesce(F.sum(side("got", F.col("copies"))), F.lit(0)).alias("got_copies"),
        F.max("key").alias("key"),
        F.max(side("want", F.col("cells"))).alias("want_cells"),
        F.max(side("got", F.col("cells"))).alias("got_cells"),
    )
    paired = (F.col("want_copies") == 1) & (F.col("got_copies") == 1)
    return changed_cells(per_key.where(paired), a.schema, tolerance_us, keys).unionAll(
        whole_rows(rest.join(per_key.where(~paired).select("k1", "k2"), ["k1", "k2"]), keys)
    )


def changed_cells(
    pairs: DataFrame, schema: T.StructType, tolerance_us: int, keys: Sequence[str]
) -> DataFrame:
    """The cells in which the two rows of a key differ."""
    close = ""
    if tolerance_us:
        moments = [str(i) for i, f in enumerate(schema) if isinstance(f.dataType, MOMENT)]
        instants = [f"CAST(pair.{side} AS BIGINT)" for side in ("want", "got")]
        if moments:
            close = (
                f" AND NOT (CASE WHEN pair.i IN ({', '.join(moments)})"
                f" THEN coalesce({near(*instants, tolerance_us)}, false) ELSE false END)"
            )
    names = F.array(*[F.lit(name) for name in schema.names])
    return (
        pairs.withColumn("names", names)
        .selectExpr(
            "key",
            "explode(transform(arrays_zip(names, want_cells, got_cells), (cell, i) ->"
            " struct(cell.names AS column, cell.want_cells AS want, cell.got_cells AS got, i)))"
            " AS pair",
        )
        .where("NOT (pair.want <=> pair.got)" + close)
        .select(
            *key_columns(keys),
            F.lit("changed").alias("status"),
            "pair.column",
            "pair.want",
            "pair.got",
            F.lit(1).cast("bigint").alias("copies"),
        )
    )


def whole_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    text = F.to_json("cells")
    wanted = F.col("side") == "want"
    return rows.select(
        *key_columns(keys),
        F.when(wanted, "missing").otherwise("extra").alias("status"),
        F.lit(None).cast("string").alias("column"),
        F.when(wanted, text).alias("want"),
        F.when(~wanted, text).alias("got"),
        "copies",
    )


def key_columns(keys: Sequence[str]) -> list[Column]:
    return [F.col("key")[k].alias(k) for k in keys]


def diff_report(diffs: DataFrame, keys: Sequence[str], per_column: int = 3) -> DataFrame:
    """At most `per_column` differences per status and column, and how many more there are.

    Counting is map-side; for the ranking Spark keeps only `per_column` rows of a group in each
    task before it shuffles.
    """
    group = ["status", "column"]
    order = [F.col(quoted(k)).asc_nulls_last() for k in keys]
    order += [F.col("want").asc_nulls_last(), F.col("got").asc_nulls_last()]
    ranked = diffs.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    first = ranked.where(F.col("rank") <= per_column)
    totals = diffs.groupBy(*group).agg(F.count(F.lit(1)).alias("total"))
    return (
        first.alias("f")
        .join(
            totals.alias("t"),
            (F.col("f.status") == F.col("t.status")) & F.col("f.column").eqNullSafe(F.col("t.column")),
        )
        .select("f.*", F.greatest(F.col("t.total") - per_column, F.lit(0)).alias("more"))
    )


# Digest words are added up in pieces of 20 bits: a bigint then holds the sum of 2^43 rows.
PIECE = 0xFFFFF


def digest_sums(df: DataFrame, part: str = "") -> DataFrame:
    """Rows and the sums of 120 bits of each row's SHA-256, of all rows or for each value of a column that is left out.

    Sums depend on content, not on the order of rows or columns; nothing is sorted.
    """
    beside = [quoted(part)] if part else []
    digests = df.selectExpr(f"sha2({row_text([f for f in df.schema if f.name != part])}, 256) AS d", *beside)
    words = digests.selectExpr(
        *[f"CAST(conv(substr(d, {1 + 15 * i}, 15), 16, 10) AS BIGINT) AS w{i}" for i in range(2)], *beside
    )
    pieces = [f"shiftright(w{i}, {bits}) & {PIECE}" for i in range(2) for bits in (40, 20, 0)]
    sums = [F.expr(e) for e in ("count(1) AS rows", *[f"coalesce(sum({p}), 0) AS s{i}" for i, p in enumerate(pieces)])]
    return words.groupBy(*beside).agg(*sums)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows, columns and a digest that depends on content, not on row or column order.

    A task passes on one row of sums.
    """
    df = unique_columns(df)
    total = digest_sums(df)
    names = F.lit(",".join(sorted(df.columns)))
    sums = [F.col(f"s{i}").cast("string") for i in range(6)]
    text = F.concat_ws("|", names, F.col("rows").cast("string"), *sums)
    return total.select("rows", names.alias("columns"), F.sha2(text, 256).alias("fingerprint"))


CHECKS = "case string, check string, subject string, want string, got string"


def reconcile(
    spark: SparkSession,
    cases: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]],
    tolerance_us: int = 0,
    accepted: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Every problem of every case: case, check, subject, want, got. No row means all is equal.

    cases       name -> (expected, actual, key columns), one per table and reader
    tolerance_us, accepted  what passes as equal, see `diff_cells` and `diff_schema`

    Cells are compared in the columns both sides have with the same kind. A key of another kind is a
    schema problem, and its rows are then paired by its canonical text.
    """
    parts = []
    for name, (a, b, keys) in cases.items():
        a, b = unique_columns(a), unique_columns(b)
        schema = diff_schema(actual_kinds(a), actual_kinds(b), accepted)
        parts.append(
            schema.select(
                F.lit(name).alias("case"),
                F.lit("schema").alias("check"),
                F.concat(F.lit("column "), F.col("ordinal")).alias("subject"),
                F.concat_ws(" ", "want_name", "want_kind").alias("want"),
                F.concat_ws(" ", "got_name", "got_kind").alias("got"),
            )
        )
        counts = diff_counts(a, b).where(~F.col("equal"))
        parts.append(
            counts.select(
                F.lit(name).alias("case"),
                F.lit("rows").alias("check"),
                F.lit("row count").alias("subject"),
                F.col("want_rows").cast("string").alias("want"),
                F.col("got_rows").cast("string").alias("got"),
            )
        )
        shared = shared_columns(a, b, accepted)
        if set(keys) <= set(a.columns) & set(b.columns):
            left, right = (compared(df, shared, keys) for df in (a, b))
            cells = diff_cells(left, right, keys, tolerance_us)
            key = F.concat_ws(",", *[F.col(quoted(k)).cast("string") for k in keys])
            parts.append(
                cells.select(
                    F.lit(name).alias("case"),
                    F.col("status").alias("check"),
                    F.concat_ws(" ", key, F.col("column")).alias("subject"),
                    "want",
                    "got",
                )
            )
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], CHECKS)


def compared(df: DataFrame, shared: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The shared columns, and the keys that are not among them as text."""
    texts = [k for k in keys if k not in shared]
    keyed = [f"{comparable_text(quoted(k), df.schema[k].dataType)} AS {quoted(k)}" for k in texts]
    return df.selectExpr(*keyed, *map(quoted, shared))


def shared_columns(
    a: DataFrame, b: DataFrame, accepted: Sequence[tuple[str, str]]
) -> list[str]:
    got = {f.name: reader_label(f.dataType) for f in b.schema}
    want = {f.name: reader_label(f.dataType) for f in a.schema}
    return [
        name
        for name, kind in want.items()
        if got.get(name) == kind or (kind, got.get(name)) in accepted
    ]


def verdict(problems: DataFrame) -> DataFrame:
    """One row: the number of problems, and whether there are none.

    Rows cancel out by 128 bits of hash, which can't tell two different rows with one hash apart.
    """
    return problems.agg(F.count(F.lit(1)).alias("problems")).withColumn(
        "equal", F.col("problems") == 0
    )
