from tablex import export_stream, normalize, read_copy_stream, read_export

TYPES = [("id", "integer"), ("x", "numeric(10,2)"), ("s", "text")]


def put(folder, name, ids):
    lines = "".join(f"{i}\t{i}.50\ttext\\t{i}\n" for i in ids)
    (folder / name).write_text(lines)


def test_batches_progress_and_restart(spark, tmp_path):
    dump = tmp_path / "dump"
    dump.mkdir()
    for part in range(4):
        put(dump, f"part-{part}", range(part * 10, part * 10 + 10))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(seen):
        stream = read_copy_stream(spark, str(dump), TYPES, files_per_batch=1)
        return export_stream(normalize(stream, TYPES, decimal=True), out, checkpoint, seen.append)

    seen = []
    assert run(seen) == 40
    assert seen == [10, 20, 30, 40]
    put(dump, "part-late", [99])
    assert run(seen) == 1
    assert run([]) == 0
    rows = read_export(spark, out)
    assert rows.count() == 41 and rows.dtypes == [("id", "int"), ("x", "decimal(10,2)"), ("s", "string")]
    assert rows.where("id = 99").first().s == "text\t99"
