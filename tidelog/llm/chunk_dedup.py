"""Deleting repeated substrings, by content-defined chunking with a gear rolling hash.

A 16-bit gear hash, which sees the last 16 bytes, decides where chunks end, so boundaries depend
on nearby content only: after an insertion they fall into step again. Chunks are short,
``MEAN`` bytes on average. Where the hash does not cut for long, as in repetitive text whose
hashes are few, chunks also end at the least hash of a neighbourhood (see ``boundaries``).
From every boundary a span runs over whole chunks until it holds ``min_words`` words or
``MIN_BYTES`` bytes, the latter for text with few blanks; spans with equal digests are equal
passages. A chunk that is covered by a span that occurred earlier, by
``(doc_id, text hash, position)``, repeats; the two occurrences may overlap.

A passage is found if, after the gear has warmed up, chunks with ``min_words`` words lie
wholly in it. That fails where boundaries happen to be far apart; the README has figures.
Anything reported is equal byte for byte, but for digests that agree by chance (2^-64).

Digests that occur once are set aside first. Others are compared with their first
occurrence, which a combining minimum finds; positions are never paired with each other,
so a passage in a third of all documents costs a row per occurrence, and those rows are dealt
out to several tasks.

Rows with one id and one text are one document. A NULL id orders first. NULL and empty
texts have no spans and stay. Texts of up to 2 GB are read whole. An empty table gives no rows. Column names that begin with two underscores are reserved.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import words as W
from tidelog.llm.common import stored, texts

MEAN = 24
MIN_WORDS = 20
MIN_BYTES = 512
#: Rows of one digest that a task takes, and digests that are dealt out to several.
HOT, MAX_HOT = 50_000, 10_000

_GEAR = (W.EXACT >> W.U64(40)).astype(np.uint16)


def boundaries(data: np.ndarray, offsets: np.ndarray, mean: int = MEAN) -> np.ndarray:
    """Where chunks end in ``data``: at gear hashes in the lowest ``1 / mean``, at the least
    of ``mean`` bytes to both sides (ties cut all), and at row ends.

    The latter adds cuts where the former has none within ``mean`` bytes, and cuts every
    period of text that repeats. In a run of one byte all hashes tie; it is cut every
    ``mean`` bytes, which makes equal chunks wherever a passage enters the run.

    ``h[i] = (h[i - 1] << 1) + gear[byte i]`` over 16 bits is the sum of 16 shifted gears;
    four doublings add them up. In the first 15 bytes of a row it would see the row
    before, so no chunk ends there.
    """
    h = _GEAR[data]
    for shift in (1, 2, 4, 8):
        h[shift:] += h[:-shift] << np.uint16(shift)
    warm = np.ones(len(h), dtype=bool)
    for begin in offsets[:-1]:
        warm[begin : begin + 15] = False
    cut = (h < np.uint16((1 << 16) // mean)) & warm
    # what is not warm is nobody's least hash, and rows do not see each other
    cut |= warm & (h == _least(np.where(warm, h, np.uint16(0xFFFF)), offsets, mean)) & _dealt(data, offsets, mean)
    ends = np.unique(np.concatenate([np.flatnonzero(cut) + 1, offsets[1:]]))
    return ends[ends > 0]


def _least(h: np.ndarray, offsets: np.ndarray, reach: int) -> np.ndarray:
    """The least of ``reach`` values to both sides, by doublings, within rows."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    at = np.arange(len(h)) if len(starts) else np.zeros(0, np.int64)
    row = np.repeat(starts, np.diff(np.append(starts, len(h)))) if len(starts) else at
    # rows lie apart by filler that is never least
    gap = 2 * reach + 1
    shift = np.searchsorted(starts, row) * gap if len(starts) else at
    wide = np.full(len(h) + (len(starts) + 1) * gap, np.uint16(0xFFFF))
    wide[at + shift + reach] = h
    low, n = wide, 1
    while 2 * n <= gap:
        low, n = np.minimum(low[:-n], low[n:]), 2 * n
    low = np.minimum(low[: len(low) - (gap - n)], low[gap - n :])
    return low[at + shift]


def _dealt(data: np.ndarray, offsets: np.ndarray, mean: int) -> np.ndarray:
    """False inside runs of one byte, but for every ``mean``-th place from where one begins."""
    new = np.ones(len(data), dtype=bool)
    new[1:] = data[1:] != data[:-1]
    new[offsets[offsets < len(data)]] = True
    at = np.arange(len(data))
    since = at - np.maximum.accumulate(np.where(new, at, 0))
    return (since < 16) | (since % mean == 0)


def _spans(part: W.Slice, min_words: int, mean: int):
    """Row, start, end and digest of every span of a slice."""
    ends = boundaries(part.data, part.offsets, mean)
    starts = np.append(0, ends[:-1])
    digests = W.span_hashes(part.data, starts, ends, W.EXACT)
    row = np.searchsorted(part.offsets, starts, "right") - 1
    words = np.searchsorted(W.find_words(part).start, np.append(0, ends))
    # the first chunk with which each span is long enough
    last = np.searchsorted(words[1:], words[:-1] + min_words)
    last = np.minimum(last, np.searchsorted(ends, starts + MIN_BYTES))
    whole = last < len(ends)
    whole[whole] = row[last[whole]] == row[whole]
    first, last = np.flatnonzero(whole), last[whole]
    # a digest of the chunks from first to last: a polynomial over their digests
    power, back = (W.powers(base, len(ends) + 1) for base in (W.BASE, W.INVERSE))
    sums = np.append(W.U64(0), np.cumsum(digests * power[:-1]))
    body = (sums[last + 1] - sums[first]) * back[first]
    base = part.offsets[row[first]]
    return row[first], starts[first] - base, ends[last] - base, W.mix(body + (last - first).astype(W.U64))


def spans(docs: DataFrame, min_words: int = MIN_WORDS, mean: int = MEAN, version: Column | None = None) -> DataFrame:
    """``doc_id, version, start, digest``: every span.

    ``version`` (see ``_version``) tells texts apart that share an id; ``start`` is in bytes. Where
    a span ends follows from the text.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch.column("text")):
                if len(part.data):
                    row, start, _, digest = _spans(part, min_words, mean)
                    taken = [batch.column(c).take(pa.array(row + part.low)) for c in ("doc_id", "version")]
                    yield pa.RecordBatch.from_arrays(
                        [*taken, pa.array(start.astype(np.int32)), pa.array(digest.view(np.int64))],
                        names=["doc_id", "version", "start", "digest"],
                    )

    version = F.xxhash64("text") if version is None else version
    versioned = docs.select("doc_id", "text", version.alias("version"))
    return versioned.mapInArrow(cut, "doc_id long, version long, start int, digest long")


def _version(docs: DataFrame) -> Column:
    """A hash of the text; where no id is NULL or comes twice, ids suffice, and it is a constant."""
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    unique = ids.where("n > 1 or doc_id is null").isEmpty()
    return F.lit(0).cast("long") if unique else F.xxhash64(F.col("text").cast("string"))


def _salted(rows: DataFrame, hot: DataFrame | None, *place: str) -> DataFrame:
    """``rows`` with a ``salt`` below the number that their digest's frequency asks for."""
    if hot is None:
        return rows
    marked = rows.join(F.broadcast(hot), "digest", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    if place:
        salt = F.pmod(F.xxhash64(*place), F.col("salts")).cast("int")
    else:
        salt = F.explode(F.sequence(F.lit(0), (F.col("salts") - 1).cast("int")))
    return marked.withColumn("salt", salt).drop("salts")


def repeated_spans(
    docs: DataFrame, min_words: int = MIN_WORDS, mean: int = MEAN, version: Column | None = None
) -> DataFrame:
    """``doc_id, version, found``: by document, the spans that occurred before.

    ``found`` holds ``start`` in bytes and ``first_id``, the document of the first
    occurrence. Documents without such spans are left out.
    """
    every = spans(docs, min_words, mean, version)
    often = stored(every.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1"), "often")
    # rows of a frequent digest go to several tasks; which digests are listed changes nothing else
    hot = often.where(F.col("n") >= HOT).orderBy(F.desc("n"), "digest").limit(MAX_HOT)
    hot = [(r["digest"], -(-r["n"] // HOT)) for r in hot.collect()]
    hot = docs.sparkSession.createDataFrame(hot, "digest long, salts long") if hot else None
    keys = ["digest"] if hot is None else ["digest", "salt"]
    met = _salted(every, hot, "doc_id", "version", "start").join(_salted(often.select("digest"), hot), keys)
    met = stored(met, "spans")
    met = met.select(*keys, F.struct("doc_id", "version", "start").alias("at"))
    first = met.groupBy(*keys).agg(F.min("at").alias("kept"), F.max("at").alias("other"))
    if hot is not None:
        first = first.groupBy("digest").agg(F.min("kept").alias("kept"), F.max("other").alias("other"))
    first = _salted(first.where("kept <> other").drop("other"), hot)
    later = met.join(first, keys).where("at > kept")
    span = F.struct(F.col("at.start").cast("long").alias("start"), F.col("kept.doc_id").alias("first_id"))
    found = later.select("at.doc_id", "at.version", span.alias("span")).groupBy("doc_id", "version")
    return found.agg(F.sort_array(F.collect_set("span")).alias("found"))


def _repeated(batch: pa.RecordBatch, at: int, min_words: int) -> Iterator[tuple[int, bytes, list[list]]]:
    """Row, text and merged repeated spans of the marked rows of a batch."""
    found = batch.column("__found")
    for i in np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False)).tolist():
        text = batch.column(at).slice(i, 1)
        (part,) = W.slices(text)
        _, start, end, _ = _spans(part, min_words, MEAN)
        ends = dict(zip(start.tolist(), end.tolist()))
        own = [{**x, "end": ends[x["start"]]} for x in found[i].as_py()]
        yield i, part.data.tobytes(), merged(own)


def merged(found: list[dict]) -> list[list]:
    """Spans that overlap or touch as one: ``[start, end, first ids]``."""
    out: list[list] = []
    for span in found:
        if out and span["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span["end"])
            out[-1][2].add(span["first_id"])
        else:
            out.append([span["start"], span["end"], {span["first_id"]}])
    return out


def _marked(docs: DataFrame, min_words: int, how: str) -> DataFrame:
    """``docs`` with ``__found``, last, where spans repeat earlier ones."""
    own = texts(docs)
    version = _version(own)
    found = repeated_spans(own, min_words, version=version)
    found = found.select(*(F.col(c).alias(f"__{c}") for c in ("doc_id", "version", "found")))
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (version == F.col("__version"))
    return docs.join(found, same, how).drop("__doc_id", "__version")


def passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, start, end, n_words, first_ids``: the repeated passages, a row for each.

    ``start`` and ``end`` are bytes of the UTF-8 text; ``first_ids`` the sorted ids of
    the documents that hold (parts of) it first.
    """

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, body, spans in _repeated(batch, 1, min_words):
                for start, end, ids in spans:
                    known = sorted(ids, key=lambda x: (x is not None, x))
                    out.append((i, start, end, len(body[start:end].split()), known))
            rows, *numbers = ([x[k] for x in out] for k in range(4))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    *(pa.array(x, pa.int64()) for x in numbers),
                    pa.array([x[4] for x in out], pa.list_(pa.int64())),
                ],
                names=["doc_id", "start", "end", "n_words", "first_ids"],
            )

    schema = "doc_id long, start long, end long, n_words long, first_ids array<long>"
    return _marked(texts(docs), min_words, "inner").mapInArrow(measure, schema)


def delete_repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row with all its columns, ``text`` without passages that occurred before.

    A boundary inside a character moves to that character's end.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            columns, changed = list(batch.columns[:-1]), []
            for _, body, spans in _repeated(batch, at, min_words):
                last, kept = 0, []
                for start, end, _ in spans:
                    kept.append(body[last : _whole(body, start)])
                    last = _whole(body, end)
                changed.append(b"".join([*kept, body[last:]]).decode())
            if changed:
                marked = batch.column("__found").is_valid()
                columns[at] = pc.replace_with_mask(columns[at], marked, pa.array(changed, columns[at].type))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return _marked(docs, min_words, "left").mapInArrow(cut, T.StructType(docs.schema.fields))


def _whole(body: bytes, at: int) -> int:
    while at < len(body) and body[at] & 0xC0 == 0x80:
        at += 1
    return at
