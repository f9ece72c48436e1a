"""Exports in versions: every write adds files of its own, and one small file, created once, makes them the table.

    data/<id>/part-….parquet        the files of one write; never moved, never changed
    _manifests/<number>.json        a version: a header, then a line for each data file with its rows and bytes

A version is published by creating the manifest of the next number, which fails if another writer was faster: nothing is
renamed or copied, whatever the size. A reader takes the newest complete manifest and reads the files it names, so it sees a
version whole, before, during and after any write. Files that no manifest names are not part of the table.

Two writers may work at once. An append is put on top of whatever was published meanwhile. An overwrite replaces the
version it started from; if that is no longer the newest, it fails and removes what it wrote.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablex.functions.names import unique_columns
from tablex.session import configure, create_once, file_names, path_exists, read_text, remove_path
from tablex.sinks.files import optional_fields

MANIFESTS = "_manifests"
LIST = "file string, rows bigint, bytes bigint"


class Conflict(RuntimeError):
    """Another writer published a version in between."""


@dataclass(frozen=True)
class Version:
    number: int
    rows: int
    schema: T.StructType
    files: tuple[tuple[str, int, int], ...]  # (path below the export, rows, bytes)


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests, complete or not, from old to new."""
    folder = f"{path.rstrip('/')}/{MANIFESTS}"
    names = file_names(spark, folder) if path_exists(spark, folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, path: str, number: int) -> Version | None:
    """A version, or None if it has no manifest or one that was not written to the end."""
    file = manifest_path(path, number)
    lines = read_text(spark, file).splitlines() if path_exists(spark, file) else []
    if not lines:
        return None
    try:
        head = json.loads(lines[0])
        if len(lines) != head["files"] + 1:
            return None
        files = tuple((f["file"], f["rows"], f["bytes"]) for f in map(json.loads, lines[1:]))
    except ValueError:
        return None
    return Version(number, head["rows"], T.StructType.fromJson(head["schema"]), files)


def manifest_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/{number:012d}.json"


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest complete version."""
    found = (manifest(spark, path, number) for number in reversed(numbers(spark, path)))
    return next((version for version in found if version), None)


def publish(spark: SparkSession, path: str, version: Version) -> bool:
    """Whether the manifest could be created; False if its number is taken."""
    head = {"version": version.number, "rows": version.rows, "files": len(version.files), "schema": version.schema.jsonValue(), "written": time.time()}
    lines = [json.dumps(head), *[json.dumps({"file": f, "rows": r, "bytes": b}) for f, r, b in version.files]]
    return create_once(spark, manifest_path(path, version.number), "\n".join(lines) + "\n")


def write_version(df: DataFrame, path: str, mode: str = "overwrite", base: int | None = None, row_group_rows: int = 0) -> Version:
    """Write and publish the next version of an export.

    mode    overwrite: these rows replace the version `base`, by default the newest as the write begins;
            append: these rows join the newest version; errorifexists: there must be no version yet

    Row counts come from the footers of the files written, so a repeated task counts once.
    """
    spark = configure(df.sparkSession)
    if mode not in ("overwrite", "append", "errorifexists"):
        raise ValueError(f"mode {mode!r}: overwrite, append or errorifexists")
    begun = current(spark, path)
    if mode == "errorifexists" and begun:
        raise FileExistsError(path)
    if base is not None and (begun.number if begun else 0) != base:
        raise Conflict(f"{path} is no longer at version {base}")
    place = f"data/{uuid.uuid4().hex}"
    df = optional_fields(unique_columns(df))
    folder = f"{path.rstrip('/')}/{place}"
    try:
        writer = df.write.format("parquet").option("compression", "zstd")
        if row_group_rows:
            writer = writer.option("parquet.block.row.count.limit", row_group_rows)
        writer.mode("errorifexists").save(folder)
        written = spark.read.schema(df.schema).parquet(folder)
        counts = written.groupBy("_metadata.file_name", "_metadata.file_size").count().collect()
        files = tuple(sorted((f"{place}/{r[0]}", r[2], r[1]) for r in counts))  # one line per file
        taken = max(numbers(spark, path), default=0)
        while True:
            now = current(spark, path)
            if mode != "append" and (now.number if now else 0) != (begun.number if begun else 0):
                raise Conflict(f"{path}: version {now.number} was published meanwhile")
            if mode == "append" and now and [(f.name, f.dataType) for f in now.schema] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError(f"columns differ from those of {path}")
            every = (now.files if mode == "append" and now else ()) + files
            # A number whose manifest is incomplete stays taken.
            version = Version(taken + 1, sum(r for _, r, _ in every), df.schema, every)
            if publish(spark, path, version):
                return version
            taken += 1
    except BaseException:
        remove_path(spark, folder)
        raise


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a version, by default the newest."""
    configure(spark)
    version = current(spark, path) if number is None else manifest(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"{path} has no {'version' if number is None else f'version {number}'}")
    if not version.files:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*[f"{path.rstrip('/')}/{f}" for f, _, _ in version.files])


def versions(spark: SparkSession, path: str) -> DataFrame:
    """version, files, rows and bytes of every complete version."""
    found = [v for v in (manifest(spark, path, n) for n in numbers(spark, path)) if v]
    rows = [(v.number, len(v.files), v.rows, sum(b for _, _, b in v.files)) for v in found]
    return spark.createDataFrame(rows, "version bigint, files bigint, rows bigint, bytes bigint")


def damaged(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Files of a version that are missing or hold another number of rows: file, rows (wanted), found."""
    version = current(spark, path) if number is None else manifest(spark, path, number)
    if version is None:
        raise FileNotFoundError(path)
    root = path.rstrip("/")
    there = {f for folder in {f.rpartition("/")[0] for f, _, _ in version.files} if path_exists(spark, f"{root}/{folder}") for f in (f"{folder}/{n}" for n in file_names(spark, f"{root}/{folder}"))}
    wanted = spark.createDataFrame([*version.files], LIST)
    present = [f"{root}/{f}" for f, _, _ in version.files if f in there]
    empty = spark.createDataFrame([], "file string, found bigint")
    counts = spark.read.schema(version.schema).parquet(*present).groupBy(F.element_at(F.split("_metadata.file_path", "/data/"), -1).alias("file")).agg(F.count(F.lit(1)).alias("found")) if present else empty
    both = wanted.join(counts.select(F.concat(F.lit("data/"), "file").alias("file"), "found"), "file", "left")
    return both.where("NOT (found <=> rows)").select("file", "rows", "found")


def vacuum(spark: SparkSession, path: str, keep: int = 1, older_than: float = 7 * 24 * 3600) -> int:
    """Remove all but the newest `keep` versions, and files none of those name; returns the folders removed.

    older_than  seconds: younger folders stay, for a writer that has not published yet may own them. A reader of a
                removed version loses its files.
    """
    every = numbers(spark, path)
    complete = [v for v in (manifest(spark, path, n) for n in every) if v]
    kept = complete[-max(1, keep) :]
    named = {f.split("/")[1] for v in kept for f, _, _ in v.files}
    root, gone = path.rstrip("/"), 0
    for version in complete[: -max(1, keep)]:
        remove_path(spark, manifest_path(path, version.number))
    for name, changed in file_names(spark, f"{root}/data", times=True):
        if name not in named and changed / 1000 < time.time() - older_than:
            remove_path(spark, f"{root}/data/{name}")
            gone += 1
    return gone
