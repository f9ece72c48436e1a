"""Exports in versions: snapshots, races, failed and half-published writes."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablex.session import create_once, read_text
from tablex.sinks import versions as V


def numbers(spark, first, n):
    return spark.range(first, first + n, 1, 4).withColumn("s", F.concat(F.lit("row "), F.col("id").cast("string")))


def total(df):
    return tuple(df.agg(F.count("*"), F.sum("id")).first())


def test_versions_stay_readable(spark, tmp_path):
    path = str(tmp_path / "export")
    assert V.current(spark, path) is None
    first = V.write_version(numbers(spark, 0, 1000), path, "errorifexists")
    second = V.write_version(numbers(spark, 5000, 10), path)
    third = V.write_version(numbers(spark, 100, 5), path, "append")
    assert [v.number for v in (first, second, third)] == [1, 2, 3] and [v.rows for v in (first, second, third)] == [1000, 10, 15]
    assert total(V.read_version(spark, path, 1)) == (1000, 499500)
    assert V.read_version(spark, path, 2).count() == 10
    assert V.read_version(spark, path).count() == 15
    assert [tuple(r)[:3:2] for r in V.versions(spark, path).orderBy("version").collect()] == [(1, 1000), (2, 10), (3, 15)]
    assert sum(r for _, r, _ in third.files) == 15 and all((tmp_path / "export" / f).stat().st_size == b for f, _, b in third.files)
    with pytest.raises(FileExistsError):
        V.write_version(numbers(spark, 0, 1), path, "errorifexists")
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, path, 9)
    with pytest.raises(ValueError):
        V.write_version(spark.range(3), path, "append")
    assert V.read_version(spark, path).count() == 15


def test_an_empty_version_keeps_its_schema(spark, tmp_path):
    path = str(tmp_path / "e")
    assert V.write_version(numbers(spark, 0, 5).where("false"), path).rows == 0
    back = V.read_version(spark, path)
    assert back.count() == 0 and back.columns == ["id", "s"]


def race(*writes):
    """Runs the writes at once; (versions, conflicts)."""
    won, lost = [], []
    gate = threading.Barrier(len(writes))

    def work(write):
        gate.wait()
        try:
            won.append(write())
        except V.Conflict as conflict:
            lost.append(conflict)

    threads = [threading.Thread(target=work, args=(w,)) for w in writes]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return won, lost


def test_of_two_overwrites_one_wins(spark, tmp_path):
    path = str(tmp_path / "race")
    V.write_version(numbers(spark, 0, 10), path)
    won, lost = race(*[lambda k=k: V.write_version(numbers(spark, 1000 * k, 10 + k), path, base=1) for k in range(1, 5)])
    assert len(won) == 1 and len(lost) == 3
    assert V.read_version(spark, path).count() == won[0].rows
    assert {f.name for f in (tmp_path / "race/data").iterdir()} == {f.split("/")[1] for v in (1, 2) for f, _, _ in V.manifest(spark, path, v).files}


def test_appends_all_arrive(spark, tmp_path):
    path = str(tmp_path / "appends")
    won, lost = race(*[lambda k=k: V.write_version(numbers(spark, 1000 * k, 10), path, "append") for k in range(5)])
    assert len(won) == 5 and not lost and sorted(v.number for v in won) == [1, 2, 3, 4, 5]
    assert V.read_version(spark, path).count() == 50


def test_a_reader_sees_old_or_new(spark, tmp_path):
    path = str(tmp_path / "reader")
    V.write_version(numbers(spark, 0, 100), path)
    seen, done = set(), threading.Event()

    def read():
        while not done.is_set():
            seen.add(total(V.read_version(spark, path)))

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 4):
        V.write_version(numbers(spark, 1000 * k, 100 + k), path)
    done.set()
    reader.join()
    assert seen <= {(100 + k, sum(range(1000 * k, 1000 * k + 100 + k))) for k in range(4)} and seen


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "failed")
    V.write_version(numbers(spark, 0, 10), path)
    with pytest.raises(Exception, match="broken"):
        V.write_version(numbers(spark, 0, 10).withColumn("s", F.expr("if(id = 7, raise_error('broken'), s)")), path)
    assert len(list((tmp_path / "failed/data").iterdir())) == 1 and V.read_version(spark, path).count() == 10


def test_half_a_manifest_is_none(spark, tmp_path):
    """A writer died while it published: its number is passed over."""
    path = str(tmp_path / "half")
    V.write_version(numbers(spark, 0, 10), path)
    text = read_text(spark, V.manifest_path(path, 1))
    for number, part in ((2, ""), (3, text[:40]), (4, text.splitlines()[0] + "\n")):
        assert create_once(spark, V.manifest_path(path, number), part)
    assert V.current(spark, path).number == 1 and V.read_version(spark, path).count() == 10
    assert V.write_version(numbers(spark, 0, 3), path).number == 5
    assert V.read_version(spark, path).count() == 3


def test_create_once(spark, tmp_path):
    path = str(tmp_path / "x/once")
    assert create_once(spark, path, "é\n") and not create_once(spark, path, "other")
    assert read_text(spark, path) == "é\n" and [f.name for f in Path(path).parent.iterdir()] == ["once"]


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "damaged")
    version = V.write_version(numbers(spark, 0, 100), path)
    assert V.damaged(spark, path).count() == 0
    lost, short = version.files[0], version.files[1]
    folder = tmp_path / "damaged"
    (folder / lost[0]).unlink()
    (folder / short[0]).write_bytes((folder / version.files[2][0]).read_bytes())
    (folder / short[0]).with_name(f".{Path(short[0]).name}.crc").unlink(missing_ok=True)
    numbers(spark, 0, 3).coalesce(1).write.parquet(str(tmp_path / "other"))
    (folder / short[0]).write_bytes(next((tmp_path / "other").glob("part-*.parquet")).read_bytes())
    assert {tuple(r) for r in V.damaged(spark, path).collect()} == {(lost[0], lost[1], None), (short[0], short[1], 3)}


def test_vacuum(spark, tmp_path):
    path = str(tmp_path / "vacuum")
    for k in range(3):
        V.write_version(numbers(spark, 0, 10 + k), path)
    assert V.vacuum(spark, path) == 0  # all are too young
    assert len(list((tmp_path / "vacuum/data").iterdir())) == 3
    assert V.vacuum(spark, path, keep=1, older_than=-10) == 2
    assert V.read_version(spark, path).count() == 12
