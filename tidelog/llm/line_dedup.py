"""Deleting runs of lines that the corpus already holds, by winnowing over line hashes.

The lines of a document that hold a word, without surrounding blanks, form a sequence of
hashes. Windows are the runs of ``window`` lines, the shorter ones that hold ``words``
words or more, and a whole text of fewer lines. Of every window the smallest hash (the
last one on ties) is a fingerprint. Equal windows select the same fingerprint, so a
repeated run of ``window`` lines or of ``words`` words is always found through one, and
so is a later copy of a whole text. Shorter runs stay. ``words=None`` has windows of
``window`` lines only.

1. Fingerprints that occur once in the corpus are set aside.
2. The positions of the others are joined. Each carries the digests of the windows that
   chose it, which reach up to ``window - 1`` lines to both sides; where a digest equals
   an earlier one, the match extends over that window. Windows that overlap or touch
   chain, so a run of any length is matched to its ends.
3. The first occurrence, by ``(doc_id, text hash, line)``, stays. Later ones are deleted
   with the blank lines that follow them.

No two positions of a group are paired: every one is compared with the first occurrence
of its digest, which a combining minimum finds.

Rows with one id and one text are the same document. A NULL id orders first. NULL and
empty texts have no lines and stay as they are. Column names that begin with two
underscores are reserved.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import words as W
from tidelog.llm.common import stored, texts

WINDOW = 3
WORDS = 8
_PRINTS = "doc_id long, version long, print long, windows array<struct<run: int, digest: long>>"


def _windows(part: W.Slice, window: int, words: int | None) -> tuple[np.ndarray, ...]:
    """Row, run, digest, and the line and hash that were chosen, of every window.

    Windows are in the order of the chosen lines. ``run`` is ``window`` times the line in
    its text, plus the number of lines less one.
    """
    found = W.find_words(part)
    lines = W.find_lines(part, found)
    hashes = W.span_hashes(part.data, lines.start, lines.end, W.EXACT)
    before = np.append(np.searchsorted(found.start, lines.start), len(found.start))
    every = []
    for size in range(window if words is None else 1, window + 1):
        digests = W.gram_hashes(hashes, size)
        rows = lines.rows()[: len(digests)]
        at = np.arange(len(digests))
        first, last = lines.first[rows], lines.first[rows + 1]
        inside = at + size <= last
        if size < window:
            inside &= (before[at + size] - before[at] >= words) | ((at == first) & (at + size == last))
        best, chosen = hashes[size - 1 :].copy(), at + size - 1
        for back in range(size - 2, -1, -1):
            smaller = hashes[back : back + len(at)] < best
            best = np.where(smaller, hashes[back : back + len(at)], best)
            chosen = np.where(smaller, at + back, chosen)
        run = (at - first) * window + size - 1
        every.append([x[inside] for x in (rows, run, digests, chosen, best)])
    joined = [np.concatenate(x) for x in zip(*every)]
    order = np.argsort(joined[3], kind="stable")
    return tuple(x[order] for x in joined)


def fingerprints(docs: DataFrame, window: int = WINDOW, words: int | None = WORDS) -> DataFrame:
    """One row per fingerprint position, with the windows that chose it."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch.column("text")):
                rows, runs, digests, chosen, prints = _windows(part, window, words)
                new = np.ones(len(rows), dtype=bool)
                new[1:] = chosen[1:] != chosen[:-1]
                begins = np.flatnonzero(new)
                take = pa.array(rows[begins] + part.low)
                windows = pa.StructArray.from_arrays(
                    [
                        pa.array(runs.astype(np.int32)),
                        pa.array(digests.view(np.int64)),
                    ],
                    names=["run", "digest"],
                )
                bounds = pa.array(np.append(begins, len(rows)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(take),
                        batch.column("version").take(take),
                        pa.array(prints[begins].view(np.int64)),
                        pa.ListArray.from_arrays(bounds, windows),
                    ],
                    names=["doc_id", "version", "print", "windows"],
                )

    return docs.select("doc_id", "version", "text").mapInArrow(find, _PRINTS)


def repeated_lines(prints: DataFrame) -> DataFrame:
    """``doc_id, version, lines``: the runs of windows that repeat an earlier one."""
    often = prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    met = prints.join(often, "print").select("doc_id", "version", F.explode("windows").alias("w"))
    met = met.select(F.struct("doc_id", "version", "w.run").alias("place"), F.col("w.digest").alias("digest"))
    # rows that repeat a whole document are one place
    first = met.groupBy("digest").agg(F.min("place").alias("kept"), F.max("place").alias("other"))
    first = first.where("kept <> other").select("digest", "kept")
    later = met.join(first, "digest").where("place > kept").select("place.*")
    return later.groupBy("doc_id", "version").agg(F.collect_set("run").alias("lines"))


def _cut(text: str, runs: list[int], window: int) -> tuple[str, int]:
    """The text without the lines of its repeated windows; how many went."""
    gone = {run // window + i for run in runs for i in range(run % window + 1)}
    kept, at, deleting = [], -1, False
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            at += 1
            deleting = at in gone
        if not deleting:
            kept.append(line)
    return "\n".join(kept), len(gone)


def delete_repeated_lines(docs: DataFrame, window: int = WINDOW, words: int | None = WORDS) -> DataFrame:
    """Every row with all its columns, ``text`` without repeated runs, and ``n_deleted``.

    ``n_deleted`` counts lines and replaces a column of that name.
    """
    docs = docs.drop("n_deleted")
    version = F.xxhash64(F.col("text").cast("string"))
    own = texts(docs).withColumn("version", version)
    prints = stored(fingerprints(own, window, words), "line_prints")
    spans = repeated_lines(prints).select(
        F.col("doc_id").alias("__of"), F.col("version").alias("__v"), F.col("lines").alias("__lines")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__of")) & (version == F.col("__v"))
    joined = docs.join(spans, same, "left").drop("__of", "__v")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, at = batch.column("__lines"), batch.schema.get_field_index("text")
            marked = lines.is_valid().to_numpy(zero_copy_only=False)
            deleted = np.zeros(batch.num_rows, dtype=np.int64)
            columns = list(batch.columns[:-1])
            changed = []
            for i in np.flatnonzero(marked).tolist():
                text, deleted[i] = _cut(columns[at][i].as_py(), lines[i].as_py(), window)
                changed.append(text)
            if changed:
                new = pa.array(changed, columns[at].type)
                columns[at] = pc.replace_with_mask(columns[at], pa.array(marked), new)
            names = [*batch.schema.names[:-1], "n_deleted"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(deleted)], names=names)

    schema = T.StructType([*docs.schema.fields, T.StructField("n_deleted", T.LongType(), False)])
    return joined.mapInArrow(cut, schema)
