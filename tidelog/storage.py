"""Small-file helpers on the Hadoop file system the session is configured for.

Used for metadata only (manifests, markers, folder names), never for table data.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return jvm, fs, hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    _, fs, p = _fs(spark, path)
    return fs.exists(p)


def uri(spark: SparkSession, path: str) -> str:
    """A path as file listings write it: with its scheme, special characters escaped."""
    _, fs, p = _fs(spark, path)
    whole = fs.makeQualified(p).toUri()
    authority = whole.getRawAuthority()
    return f"{whole.getScheme()}:{f'//{authority}' if authority else ''}{whole.getRawPath()}"


def list_names(spark: SparkSession, path: str) -> list[str]:
    _, fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def read_text(spark: SparkSession, path: str) -> str:
    jvm, fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def feed_of(spark: SparkSession, checkpoint: str) -> str:
    """A streaming query's identity lives in its checkpoint; a new checkpoint is a new feed."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target and rename, so readers never see half a file.

    The rename itself refuses to replace a file, so of two writers one fails.
    """
    jvm, fs, p = _fs(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    try:
        rename(spark, part.toString(), path)
    except OSError:
        fs.delete(part, False)
        raise


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a name that must not exist."""
    jvm, fs, p = _fs(spark, target)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(source), p, options)
    except Py4JJavaError as error:
        raise OSError(f"could not publish {target}") from error


def touch(spark: SparkSession, path: str) -> None:
    _, fs, p = _fs(spark, path)
    fs.create(p, True).close()


def delete_folder(spark: SparkSession, path: str) -> None:
    _, fs, p = _fs(spark, path)
    fs.delete(p, True)
