"""Packing landed text files."""

import math
import pathlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog import storage
from tidelog.sinks import packing
from tidelog.sources import feeds
from tidelog.sinks.files import start_rolling_text


def land(spark, folder, rows, tasks):
    """Rows of (hour, text) through the streaming sink, in as many files an hour as tasks."""
    df = spark.createDataFrame(rows, "hour int, text string").repartition(tasks)
    df.write.mode("append").parquet(f"{folder}/feed")
    stream = feeds.file_feed(spark, f"{folder}/feed", df.schema)
    ts = F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), F.col("hour"), F.lit(0), F.lit(0))
    start_rolling_text(stream, F.col("text"), f"{folder}/landed", f"{folder}/cp", ts, None).awaitTermination()


def state(spark, folder):
    landed, path = f"{folder}/landed", f"{folder}/files"
    files, sizes = Counter(), Counter()
    for r in packing.live_files(spark, landed, path).collect():
        files[r.bucket] += 1
        sizes[r.bucket] += r.bytes
    return files, sizes, Counter(tuple(r) for r in packing.read_packed(spark, landed, path).collect())


def bucket(hour):
    return f"2024-01-01--{hour:02d}"


@pytest.mark.parametrize("cap", [200, 1_000, 100_000])
def test_folders_hold_as_many_files_as_their_bytes_need(spark, folder, cap):
    rows = [(i % 3, f"{i:04d}" + "x" * (i % 29)) for i in range(300)] + [(5, "one line")]
    land(spark, folder, rows, 6)
    before = state(spark, folder)
    want = Counter((text, bucket(hour)) for hour, text in rows)
    assert before[2] == want and before[0][bucket(0)] == 6
    made = packing.pack(spark, f"{folder}/landed", f"{folder}/files", cap)
    files, sizes, lines = state(spark, folder)
    assert lines == want and sizes == before[1] and made > 0
    assert files == {b: math.ceil(n / cap) for b, n in sizes.items()}
    # nothing is left to do
    assert packing.pack(spark, f"{folder}/landed", f"{folder}/files", cap) == 0
    assert storage.list_names(spark, f"{folder}/files/packed") == ["run=000000000"]


def test_sizes_are_near_equal(spark, folder):
    land(spark, folder, [(1, f"{i:05d}") for i in range(2_000)], 3)
    packing.pack(spark, f"{folder}/landed", f"{folder}/files", 1_500)
    sizes = [r.bytes for r in packing.live_files(spark, f"{folder}/landed", f"{folder}/files").collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 12


def test_lines_that_land_meanwhile(spark, folder, monkeypatch):
    """The stream lands a batch between the packer's listing and its rename, and a late line after."""
    landed, path = f"{folder}/landed", f"{folder}/files"
    land(spark, folder, [(1, f"a{i}") for i in range(50)], 4)
    rename = storage.rename

    def rename_late(*args):
        land(spark, folder, [(1, f"b{i}") for i in range(7)] + [(2, "c")], 2)
        rename(*args)

    monkeypatch.setattr(storage, "rename", rename_late)
    packing.pack(spark, landed, path, 10_000)
    monkeypatch.undo()
    want = Counter([(f"a{i}", bucket(1)) for i in range(50)] + [(f"b{i}", bucket(1)) for i in range(7)] + [("c", bucket(2))])
    assert state(spark, folder)[2] == want
    packing.pack(spark, landed, path, 10_000)
    files, _, lines = state(spark, folder)
    assert lines == want and files == {bucket(1): 1, bucket(2): 1}
    assert packing.remove_covered(spark, landed, path) == 1
    assert state(spark, folder)[0] == files and state(spark, folder)[2] == want


def test_a_packer_that_dies_or_races_changes_nothing(spark, folder, monkeypatch):
    landed, path = f"{folder}/landed", f"{folder}/files"
    land(spark, folder, [(1, f"a{i}") for i in range(30)], 4)
    before = state(spark, folder)
    rename = storage.rename

    def die(*args):
        raise OSError("gone")

    monkeypatch.setattr(storage, "rename", die)
    with pytest.raises(OSError, match="gone"):
        packing.pack(spark, landed, path)
    monkeypatch.undo()
    assert state(spark, folder) == before

    def another_first(spark_, source, target):
        monkeypatch.undo()
        packing.pack(spark, landed, path)
        rename(spark_, source, target)

    monkeypatch.setattr(storage, "rename", another_first)
    with pytest.raises(OSError, match="could not publish"):
        packing.pack(spark, landed, path)
    files, sizes, lines = state(spark, folder)
    assert files == {bucket(1): 1} and lines == before[2] and sizes == before[1]


def test_nothing_landed(spark, folder):
    assert packing.pack(spark, f"{folder}/landed", f"{folder}/files") == 0
    assert packing.read_packed(spark, f"{folder}/landed", f"{folder}/files").collect() == []


def test_a_task_writes_many_files(spark, folder):
    """Tasks of the rewrite follow what they are given, not how many files come of it."""
    land(spark, folder, [(i % 3, f"{i:05d}") for i in range(6_000)], 3)
    made = packing.pack(spark, f"{folder}/landed", f"{folder}/files", 60)
    path = f"{folder}/files/packed/run=000000000/data".removeprefix("file://")
    written = list(pathlib.Path(path).rglob("part-*.txt"))
    tasks = {file.name.split("-")[1] for file in written}
    assert made == len(written) == 600 and len(tasks) <= spark.sparkContext.defaultParallelism
    assert state(spark, folder)[2] == Counter((f"{i:05d}", bucket(i % 3)) for i in range(6_000))


def test_packed_files_lie_side_by_side(spark, folder):
    """On a mounted folder a packed file costs one file: no folder, no checksum file of its own."""
    land(spark, folder, [(i % 2, f"{i:05d}") for i in range(400)], 2)
    made = packing.pack(spark, f"{folder}/landed", f"{folder}/files", 100)
    data = pathlib.Path(f"{folder}/files/packed/run=000000000/data".removeprefix("file://"))
    found = list(data.rglob("*"))
    assert {p.name for p in found if p.is_dir()} == {f"bucket={bucket(0)}", f"bucket={bucket(1)}"}
    assert len([p for p in found if p.is_file()]) == made == 24


def test_files_count_by_what_their_run_tells(spark, folder):
    """What a failed task left among the packed files is not live; a packed file cut short fails its readers."""
    rows = [(1, f"line {i}") for i in range(60)]
    land(spark, folder, rows, 5)
    assert packing.pack(spark, f"{folder}/landed", f"{folder}/files", 200) == 3
    before = state(spark, folder)
    data = pathlib.Path(f"{folder}/files/packed/run=000000000/data/bucket={bucket(1)}".removeprefix("file://"))
    packed = sorted(data.iterdir())
    (data / "part-00000-left-000001.txt").write_text("line 1\nli")
    assert state(spark, folder) == before and before[2] == Counter((text, bucket(hour)) for hour, text in rows)
    packed[0].write_bytes(packed[0].read_bytes()[:-3])
    with pytest.raises(Exception, match="instead of"):
        packing.read_packed(spark, f"{folder}/landed", f"{folder}/files").collect()


@pytest.mark.parametrize("spark_first", [True, False])
def test_runs_that_spark_wrote(spark, folder, monkeypatch, spark_first):
    """Away from mounted folders Spark writes the packed files; either kind of run goes on from the other."""
    landed, path = f"{folder}/landed", f"{folder}/files"
    want, mounted = Counter(), packing._mounted
    for turn in range(2):
        rows = [(i % 2, f"{turn} {i:03d}") for i in range(100)]
        land(spark, folder, rows, 3)
        want += Counter((text, bucket(hour)) for hour, text in rows)
        monkeypatch.setattr(packing, "_mounted", (lambda *_: False) if (turn == 0) == spark_first else mounted)
        packing.pack(spark, landed, path, 150)
        files, sizes, lines = state(spark, folder)
        assert lines == want and files == {b: math.ceil(n / 150) for b, n in sizes.items()}
        assert storage.exists(spark, f"{path}/packed/run={turn:09d}/files") == ((turn == 0) != spark_first)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1_000])
def test_pieces_hold_every_line_once(tmp_path, piece):
    """Lines that begin in a piece are its own, to their end, however many pieces that lies in."""
    for n, text in enumerate(["", "\n", "\n\n", "ab\n\ncdefghij\nk\n", "one line without an end", "ä\nöü", "\n" * 9 + "z" * 30 + "\n"]):
        (tmp_path / f"{n} a.txt").write_text(text, "utf-8")
        size = len(text.encode())
        starts = list(range(0, size, piece))
        rows = pa.RecordBatch.from_pydict(
            {
                "file": [f"file://{tmp_path}/{n}%20a.txt"] * len(starts),
                "start": starts,
                "stop": [min(s + piece, size) for s in starts],
                "bytes": [size] * len(starts),
            }
        )
        out = pa.Table.from_batches(packing._reader(f"file://{tmp_path}")([rows])) if starts else None
        got = out.sort_by("place").column("value").to_pylist() if out else []
        assert got == text.removesuffix("\n").split("\n")[: None if text else 0]
        assert not out or len(set(out.column("place").to_pylist())) == len(got)
