"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.timeType.enabled": "true",
    # The JVM never compiles a method above 8000 bytes of code; a projection of many columns
    # fused into one method would be interpreted. Beyond this size Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A top-n holds n rows per task; a larger one is sorted, which can spill.
    "spark.sql.execution.topKSortFallbackThreshold": "1000000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every operator assumes; safe to call repeatedly."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir` of the session.

    Only a local session that names none gets a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tablex-"))
    return context.getCheckpointDir()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared root, removed when the application ends."""
    path = f"{shared_root(spark)}/tablex/{label}-{uuid.uuid4().hex}"
    fs, target = file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The relation written to the shared folder and read back.

    Cuts the lineage, survives lost executors, and gives Spark the true size of the result, by
    which it chooses the joins that follow.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark, label)}/data"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a location."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    fs, source = file_system(spark, path)
    if not fs.rename(source, file_system(spark, to)[1]):
        raise OSError(f"can't move {path} to {to}")


def file_names(spark: SparkSession, path: str, times: bool = False) -> list:
    """Names in a folder; with `times`, (name, milliseconds of its last change)."""
    fs, target = file_system(spark, path)
    found = [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(target)]
    return found if times else [name for name, _ in found]


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_stream(stream, text: str) -> None:
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not exist yet; False if it does. Of several writers exactly one succeeds.

    HDFS gives a finished draft its name once, by a rename that never overwrites, and a local disk by a hard
    link. Other stores create without overwriting; readers may see the file before its end there.
    """
    fs, target = file_system(spark, path)
    jvm = spark._jvm
    fs.mkdirs(target.getParent())
    exists = ("FileAlreadyExistsException", "already exists")
    try:
        if fs.getScheme() == "file":
            final = jvm.java.io.File(target.toUri().getPath()).toPath()
            draft = final.resolveSibling(f".{uuid.uuid4().hex}.draft")
            try:
                jvm.java.nio.file.Files.write(draft, bytearray(text, "utf-8"), jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("java.nio.file.OpenOption"), 0))
                jvm.java.nio.file.Files.createLink(final, draft)
            finally:
                jvm.java.nio.file.Files.deleteIfExists(draft)
        elif fs.getScheme() in ("hdfs", "viewfs", "webhdfs"):
            draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.draft")
            write_stream(fs.create(draft, False), text)
            try:
                return not fs.exists(target) and fs.rename(draft, target)
            finally:
                fs.delete(draft, False)
        else:
            write_stream(fs.create(target, False), text)
    except Py4JJavaError as failed:
        if any(word in str(failed.java_exception) for word in exists):
            return False
        raise
    return True


def release(df: DataFrame) -> None:
    """Remove what `stored` wrote for a relation that is no longer needed."""
    for folder in {file.rsplit("/", 2)[0] for file in df.inputFiles() if "/tablex/" in file}:
        remove_path(df.sparkSession, folder)
