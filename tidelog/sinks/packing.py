"""Packing landed text files to a target size, beside a running stream.

A stream lands an hour of lines in as many files as it had tasks and batches. ``pack``
rewrites the lines of every folder into ``ceil(bytes / cap)`` files of near equal size: files,
in order of their names, are laid end to end and cut into that many ranges; a file goes where
its middle lies, and a file longer than a range is cut between lines. Each range is written as one
file; a task writes as many as ``SHARE`` bytes or ``FILES`` files hold. Contents are read once, by the rewrite.

A run writes into a folder of its own and publishes it by one rename; what it covers, the
files it read, is listed in it. Live files are those that no published run covers, so readers
(``read_packed``) see every line once: before the rename the landed files, after it the packed
ones, and files that the stream lands meanwhile in either case. A run that dies leaves a folder
without a name that counts. Late lines make their folder worth another run, which covers the
packed files of the earlier one. Covered files stay until ``remove_covered``.

On a mounted file system (``file:``) Spark's own writer starts a process or two for every file and
folder it makes, and a folder of many files is planned by the driver. There the tasks write packed files
through Arrow and tell their names and sizes, which the run keeps beside its data (``files``): no
listing follows, and packed lines are read by those names. A file that a failed task left is in no such list.
Elsewhere Spark writes and reads packed files, and their sizes come from listings.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import storage
from tidelog.session import empty_frame

#: Bytes of a packed file; a range of lines ends at the line that passes its share.
CAP = 1 << 30

#: What a task is given, about: files to read or write, and bytes of lines.
FILES, SHARE = 4_000, 128 << 20

#: Bytes of a packed file that a task reads at once, and lines it hands on at once.
PIECE, ROWS = 16 << 20, 50_000

_FILES = "file string, bytes long, root string, bucket string"
_WRITTEN = "file string, bytes long, bucket string"
_LINE = "value string, place long"

_Batches = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _runs(spark: SparkSession, path: str) -> list[str]:
    """The folders of published runs."""
    names = storage.list_names(spark, f"{path}/packed")
    return [f"{path}/packed/{n}" for n in names if n.startswith("run=")]


def _mounted(spark: SparkSession, path: str) -> bool:
    """Whether tasks reach a path as a folder of their machine."""
    return storage.uri(spark, path).startswith("file:")


def _bucket(file: Column) -> Column:
    return F.regexp_extract(file, "/bucket=([^/]*)/", 1)


def _list(spark: SparkSession, folder: str) -> DataFrame:
    """The files below a folder: name, length, bucket; their contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt")
    listed = reader.option("recursiveFileLookup", "true").load(folder)
    file = F.col("_metadata.file_path")
    names = listed.select(
        file.alias("file"), F.col("_metadata.file_size").alias("bytes"), F.lit(folder).alias("root"), _bucket(file).alias("bucket")
    )
    # Spark gives a task a handful of files, as if it read them
    return names.coalesce(spark.sparkContext.defaultParallelism)


def _written(spark: SparkSession, run: str) -> DataFrame:
    """The files of a published run."""
    data = f"{run}/data"
    if not storage.exists(spark, f"{run}/files"):
        return _list(spark, data)
    told = spark.read.schema(_WRITTEN).parquet(f"{run}/files")
    file = F.concat(F.lit(f"{storage.uri(spark, data)}/"), "file")
    return told.select(file.alias("file"), "bytes", F.lit(data).alias("root"), "bucket")


def _live(spark: SparkSession, landed: str, path: str) -> tuple[DataFrame, DataFrame]:
    """The landed and the packed files that hold every line once."""
    nothing = empty_frame(spark, T.StructType.fromDDL(_FILES))
    files = _list(spark, landed) if storage.exists(spark, landed) else nothing
    runs = _runs(spark, path)
    if not runs:
        return files, nothing
    packed = nothing
    for run in runs:
        packed = packed.unionByName(_written(spark, run))
    covered = spark.read.schema("file string").parquet(*[f"{run}/covers" for run in runs])
    return files.join(covered, "file", "left_anti"), packed.join(covered, "file", "left_anti")


def live_files(spark: SparkSession, landed: str, path: str) -> DataFrame:
    """``file, bytes, bucket`` of the files that hold every line once."""
    files, packed = _live(spark, landed, path)
    return files.unionByName(packed)


def _tasks(spark: SparkSession, files: int, held: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-files // FILES), -(-held // SHARE))


def _whole_lines(fs: FileSystem, name: str, start: int, stop: int, size: int) -> bytes:
    """The lines of a file that begin from ``start`` to before ``stop``."""
    with fs.open_input_file(name) as file:
        if file.size() != size:
            raise ValueError(f"{name} has {file.size()} bytes instead of {size}")
        low = max(start - 1, 0)
        data = file.read_at(stop - low, low)
        if start:
            end = data.find(b"\n") + 1
            data = data[end:] if end else b""
        rest, at = [], stop
        # the last line may end in a later piece
        while data and at < size and not (rest or [data])[-1].endswith(b"\n"):
            more = file.read_at(1 << 16, at)
            at += len(more)
            rest.append(more[: more.find(b"\n") + 1] or more)
    data = b"".join([data, *rest])
    return data if not data or data.endswith(b"\n") else data + b"\n"


def _reader(base: str) -> _Batches:
    """Pieces of files below ``base`` to their lines: ``value`` and ``place`` beside each piece's columns."""

    def lines(rows: pa.RecordBatch, starts: list[int], parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        counts = [part.count(b"\n") for part in parts]
        values = b"".join(parts).split(b"\n")[:-1]
        row = np.repeat(np.arange(len(parts)), counts)
        place = np.concatenate([start + np.arange(n) for start, n in zip(starts, counts)])
        for i in range(0, len(values), ROWS):
            out = rows.take(pa.array(row[i : i + ROWS]))
            binary = pa.array(values[i : i + ROWS], pa.binary())
            value = pa.StringArray.from_buffers(len(binary), binary.buffers()[1], binary.buffers()[2])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, value, pa.array(place[i : i + ROWS], pa.int64())], [*out.schema.names, "value", "place"]
            )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = FileSystem.from_uri(base)
        for batch in batches:
            pieces = zip(*(batch.column(c).to_pylist() for c in ("file", "start", "stop", "bytes")))
            first, starts, parts, held = 0, [], [], 0
            for i, (file, start, stop, size) in enumerate(pieces, 1):
                starts.append(start)
                parts.append(_whole_lines(fs, top + unquote(file.removeprefix(base)), start, stop, size))
                held += len(parts[-1])
                if held >= PIECE or i == len(batch):
                    yield from lines(batch.slice(first, i - first), starts, parts)
                    first, starts, parts, held = i, [], [], 0

    return read


def _writer(base: str) -> _Batches:
    """Lines in order of ``bucket`` and ``bin`` to a file each below ``base``: name, bytes and bucket of those."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = FileSystem.from_uri(base)
        label = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        now, file, made, told = None, None, 0, []
        for batch in batches:
            if not len(batch):
                continue
            text = batch.column("text").cast(pa.large_binary())
            ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1].tolist()
            keys = [batch.column(c) for c in ("bucket", "bin")]
            other = pc.or_(*[pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)) for key in keys])
            cuts = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                key = keys[0][a].as_py(), keys[1][a].as_py()
                if key != now:
                    if file:
                        file.close()
                    if now is None or key[0] != now[0]:
                        fs.create_dir(f"{top}/bucket={unquote(key[0])}")
                    now, made = key, made + 1
                    told.append([f"bucket={key[0]}/{label}-{made:06d}.txt", 0, key[0]])
                    file = fs.open_output_stream(f"{top}/{unquote(told[-1][0])}")
                file.write(text.buffers()[2].slice(ends[a], ends[b] - ends[a]))
                told[-1][1] += ends[b] - ends[a]
            # the last file may go on with the next batch
            yield _told(told[:-1])
            told = told[-1:]
        if file:
            file.close()
        yield _told(told)

    return write


def _told(files: list[list]) -> pa.RecordBatch:
    names, sizes, buckets = zip(*files) if files else ((), (), ())
    columns = [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(buckets, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["file", "bytes", "bucket"])


def _lines_by_folder(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """The lines of some files as Spark reads them, if there are any."""
    places = files.groupBy("root", "bucket").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")).collect()
    if not places:
        return None
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
    found = text.schema("value string").text(sorted({r["root"] for r in places}))
    file = F.col("_metadata.file_path")
    # only the folders that hold such files are read
    found = found.where(_bucket(file).isin(sorted({r["bucket"] for r in places})))
    lines = found.select("value", file.alias("file"), F.monotonically_increasing_id().alias("place"))
    tasks = _tasks(spark, sum(r["files"] for r in places), sum(r["bytes"] for r in places))
    return lines.coalesce(tasks).join(files, "file")


def _lines_by_name(spark: SparkSession, files: DataFrame, path: str) -> DataFrame | None:
    """The lines of some files below ``path``, if there are any."""
    files = files.where("bytes > 0")
    number, held = files.agg(F.count("*"), F.sum("bytes")).first()
    if not number:
        return None
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(PIECE).cast("long"))
    pieces = files.withColumn("start", F.explode(starts)).withColumn("stop", F.least(F.col("start") + PIECE, "bytes"))
    schema = T.StructType([*pieces.schema.fields, *T.StructType.fromDDL(_LINE).fields])
    dealt = pieces.repartition(_tasks(spark, number, held), "file", "start")
    return dealt.mapInArrow(_reader(storage.uri(spark, path)), schema).drop("start", "stop")


def _lines(spark: SparkSession, files: DataFrame, packed: DataFrame, path: str) -> DataFrame:
    """The lines of some landed and packed files with their columns; ``place`` orders them inside a file."""
    if _mounted(spark, path):
        found = [_lines_by_folder(spark, files), _lines_by_name(spark, packed, path)]
    else:
        found = [_lines_by_folder(spark, files.unionByName(packed))]
    found = [lines for lines in found if lines is not None]
    if not found:
        return empty_frame(spark, T.StructType([*files.schema.fields, *T.StructType.fromDDL(_LINE).fields]))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def read_packed(spark: SparkSession, landed: str, path: str) -> DataFrame:
    """``value, bucket``: every line that has been landed, once, packed or not."""
    return _lines(spark, *_live(spark, landed, path), path).select("value", "bucket")


def pack(spark: SparkSession, landed: str, path: str, cap: int = CAP) -> int:
    """Rewrite the folders that hold more or fewer files than their bytes need; how many files came of it.

    ``landed`` is where a stream lands (folders ``bucket=...``), ``path`` where packed files go.
    One packer at a time; of two, one fails at the rename.
    """
    number = len(_runs(spark, path))
    whole = Window.partitionBy("bucket")
    before = whole.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    planned = live_files(spark, landed, path).where("bytes > 0").select(
        "*",
        F.sum("bytes").over(whole).alias("total"),
        F.count("*").over(whole).alias("files"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"),
    )
    bins = F.ceil(F.col("total") / F.lit(cap))
    folder = f"{path}/packed/part-{uuid.uuid4().hex}"
    plan = planned.withColumn("bins", bins).where(F.col("files") != F.col("bins"))
    plan.write.parquet(f"{folder}/plan")
    plan = spark.read.schema(plan.schema).parquet(f"{folder}/plan")
    folders = plan.groupBy("bucket").agg(F.first("bins").alias("bins"), F.first("total").alias("total"))
    made, held = folders.agg(F.sum("bins"), F.sum("total")).first()
    if not made:
        storage.delete_folder(spark, folder)
        return 0
    plan.select("file").write.parquet(f"{folder}/covers")
    share = F.col("total") / F.col("bins")

    def lines(of: Column) -> DataFrame:
        by_stream = F.col("root") == landed
        return _lines(spark, plan.where(of & by_stream), plan.where(of & ~by_stream), path)

    # only files longer than a share are laid out line by line
    small = lines(F.col("bytes") <= share).withColumn("middle", F.col("offset") + F.col("bytes") / 2)
    size = F.octet_length("value") + 1
    upto = F.sum(size).over(Window.partitionBy("file").orderBy("place")) - size / 2
    large = lines(F.col("bytes") > share).withColumn("middle", F.col("offset") + upto)
    cut = small.unionByName(large)
    part = F.least(F.floor(F.col("middle") / share), F.col("bins") - 1).cast("int")
    cut = cut.select("value", "bucket", part.alias("bin"), "file", "place")
    tasks = int(min(made, _tasks(spark, made, held)))
    dealt = cut.repartition(tasks, "bucket", "bin").sortWithinPartitions("bucket", "bin", "file", "place")
    if _mounted(spark, path):
        text = F.concat("value", F.lit("\n")).alias("text")
        write = _writer(storage.uri(spark, f"{folder}/data"))
        dealt.select(text, "bucket", "bin").mapInArrow(write, _WRITTEN).write.parquet(f"{folder}/files")
    else:
        dealt.select("value", "bucket", "bin").write.partitionBy("bucket", "bin").text(f"{folder}/data")
    storage.rename(spark, folder, f"{path}/packed/run={number:09d}")
    return int(made)


def remove_covered(spark: SparkSession, landed: str, path: str) -> int:
    """Delete packed files that a later run covers; how many. Landed files are their stream's.

    For readers that began before the later run, call it some time after that.
    """
    runs = _runs(spark, path)
    if len(runs) < 2:
        return 0
    packed = _list(spark, f"{path}/packed").where(F.col("file").contains("/run="))
    covered = spark.read.schema("file string").parquet(*[f"{run}/covers" for run in runs])
    gone = [r["file"] for r in packed.join(covered, "file", "left_semi").select("file").toLocalIterator()]
    for file in gone:
        storage.delete_folder(spark, file)
    return len(gone)
