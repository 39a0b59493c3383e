"""Finding benchmark passages in documents by pigeonhole pieces and bit-parallel edits.

Texts are words: runs of letters and digits (and bytes outside ASCII), A-Z lower-cased,
so that case and punctuation do not matter. An item of ``n`` words is found where a
stretch of a document is within ``n // 8`` word edits of it (insertions, deletions,
replacements). Cut into one piece more than that budget, one piece must occur unchanged.

The pieces of all items are looked up by hash at every word of every document; a hit
names the stretch that its item would cover, and Myers' bit-parallel algorithm computes
the distance there, one bit per word of the item.

Items go out to the tasks in blocks of about ``BLOCK_ITEMS`` items or ``BLOCK_BYTES``
bytes; a larger benchmark takes more passes, none a larger broadcast. Documents are not
shuffled. Items without words are found nowhere; items of fewer than 8 words must occur
unchanged. NULL or empty documents hold nothing. Every distinct text of the benchmark is
searched, whatever its id; texts that share an id, NULL included, report their closest
place in a document as one item.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import words as W

WORDS_PER_EDIT = 8
BLOCK_ITEMS = 5_000
BLOCK_BYTES = 4 << 20
_BITMAP = 20
_FOUND = ["doc_id", "item_id", "distance", "start", "end"]


def closest(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to a stretch of ``text``, and its first end.

    Myers 1999: the columns of the distance matrix as bit vectors of vertical steps.
    """
    m = len(pattern)
    where: dict[int, int] = defaultdict(int)
    for i, word in enumerate(pattern):
        where[word] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    best, end = m, 0
    for j, word in enumerate(text):
        equal = where.get(word, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        more, less = (down | ~(across | up)) & full, up & across
        if more & top:
            distance += 1
        elif less & top:
            distance -= 1
        more, less = (more << 1) & full, (less << 1) & full
        up, down = (less | ~(vertical | more)) & full, more & vertical
        if distance < best:
            best, end = distance, j + 1
    return best, end


def budget(n: int) -> int:
    """The edits that an item of ``n`` words may differ by."""
    return n // WORDS_PER_EDIT


@dataclass
class Items:
    """A block of items: their words, and the pieces to look up by length in words."""

    ids: list[int | None] = field(default_factory=list)
    words: list[list[int]] = field(default_factory=list)
    #: length -> (sorted hashes, item index, offset in the item, bitmap of low hash bits)
    pieces: dict[int, tuple[np.ndarray, ...]] = field(default_factory=dict)


def _hashes(part: W.Slice) -> tuple[W.Words, np.ndarray]:
    words = W.find_words(part, W.MARKS)
    return words, W.span_hashes(part.data, words.start, words.end)


def pieces(rows: list[tuple[int | None, str]]) -> Items:
    """Items as patterns; those without words are left out."""
    out, by_length = Items(), defaultdict(list)
    for part in W.slices(pa.array([text for _, text in rows], pa.string())):
        words, hashes = _hashes(part)
        for r in range(part.high - part.low):
            own = hashes[words.first[r] : words.first[r + 1]]
            if not len(own):
                continue
            item = len(out.ids)
            out.ids.append(rows[part.low + r][0])
            out.words.append(own.tolist())
            cuts = np.linspace(0, len(own), budget(len(own)) + 2).astype(int)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                by_length[b - a].append((int(W.gram_hashes(own[a:b], b - a)[0]), item, a))
    for length, found in by_length.items():
        found.sort()
        hashes = np.array([x[0] for x in found], dtype=W.U64)
        items, offsets = (np.array([x[i] for x in found]) for i in (1, 2))
        bitmap = np.zeros(1 << _BITMAP, dtype=bool)
        bitmap[(hashes & W.U64((1 << _BITMAP) - 1)).astype(np.int64)] = True
        out.pieces[length] = (hashes, items, offsets, bitmap)
    return out


def _stretches(words: W.Words, hashes: np.ndarray, items: Items) -> dict[tuple[int, int], list[list[int]]]:
    """``(row, item) -> [low, high]`` words that may hold the item, merged where they meet."""
    found = defaultdict(list)
    rows = words.rows()
    for length, (known, item, offset, bitmap) in items.pieces.items():
        grams = W.gram_hashes(hashes, length)
        at = np.flatnonzero(bitmap[(grams & W.U64((1 << _BITMAP) - 1)).astype(np.int64)])
        at = at[at + length <= words.first[rows[at] + 1]]
        first, last = (np.searchsorted(known, grams[at], side) for side in ("left", "right"))
        hit = last > first
        for position, low, high in zip(at[hit].tolist(), first[hit].tolist(), last[hit].tolist()):
            row = int(rows[position])
            for k in range(low, high):
                n = len(items.words[item[k]])
                begin = position - int(offset[k]) - budget(n)
                end = begin + n + 2 * budget(n)
                bounds = [max(begin, int(words.first[row])), min(end, int(words.first[row + 1]))]
                found[row, int(item[k])].append(bounds)
    for key, spans in found.items():
        spans.sort()
        merged = [spans[0]]
        for low, high in spans[1:]:
            if low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        found[key] = merged
    return found


def _matches(column: pa.Array, items: Items) -> Iterator[tuple[int, int | None, int, int, int]]:
    """``row, item, distance, start, end`` (characters) of every item text that a row holds."""
    for part in W.slices(column):
        words, hashes = _hashes(part)
        for (row, item), spans in _stretches(words, hashes, items).items():
            pattern, best = items.words[item], None
            for low, high in spans:
                distance, end = closest(pattern, hashes[low:high].tolist())
                if distance <= budget(len(pattern)) and (best is None or distance < best[0]):
                    best = (distance, low, low + end)
            if best is None:
                continue
            distance, low, end = best
            # from the end back, the nearest start with the same distance
            back = closest(pattern[::-1], hashes[low:end][::-1].tolist())[1]
            begin, stop = words.start[end - back], words.end[end - 1]
            base = part.offsets[row]
            chars = [len(part.data[base:x].tobytes().decode("utf-8", "replace")) for x in (begin, stop)]
            yield part.low + row, items.ids[item], distance, *chars


def _closest_places(found: Iterable[tuple]) -> list[tuple]:
    """Of the matches of a row and an id the closest, and of those the first."""
    best: dict[tuple, tuple] = {}
    for row, item, *place in found:
        best[row, item] = min(best.get((row, item), (place,)), (place,))
    return [(*key, *place) for key, (place,) in best.items()]


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded size, one at a time on the driver."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("text is not null").distinct()
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for i in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == i)
        yield pieces([(r["id"], r["text"]) for r in block.orderBy("id", "text").collect()])


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, distance, start, end``: the closest place of every item held.

    One row per row of ``docs`` and item; ``start`` and ``end`` count characters.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("version", F.xxhash64("text"))
    context = docs.sparkSession.sparkContext

    def search(items: Items) -> DataFrame:
        shared = context.broadcast(items)

        def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _closest_places(_matches(batch.column("text"), shared.value))
                if found:
                    rows, *rest = zip(*found)
                    own = [batch.column(c).take(pa.array(rows)) for c in ("doc_id", "version")]
                    yield pa.RecordBatch.from_arrays(
                        [*own, *(pa.array(x, pa.int64()) for x in rest)],
                        names=["doc_id", "version", *_FOUND[1:]],
                    )

        return docs.mapInArrow(find, "doc_id long, version long, item_id long, distance long, start long, end long")

    found = [search(items) for items in _blocks(benchmark)]
    if len(found) == 1:
        return found[0].select(*_FOUND)
    # texts of one id may lie in several blocks; rows that repeat a document stay apart
    place = F.struct("distance", "start", "end").alias("place")
    numbered = [x.select("doc_id", "version", "item_id", place, F.lit(i).alias("block")) for i, x in enumerate(found)]
    item = ["doc_id", "version", "item_id"]
    by_block = reduce(DataFrame.union, numbered).groupBy(*item, "block")
    by_block = by_block.agg(F.min("place").alias("place"), F.count("*").cast("int").alias("n"))
    best = by_block.groupBy(*item).agg(F.min("place").alias("place"), F.max("n").alias("n"))
    each = best.select(*item, F.explode(F.expr("array_repeat(place, n)")).alias("place"))
    return each.select("doc_id", "item_id", "place.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    context = docs.sparkSession.sparkContext
    for items in _blocks(benchmark):
        docs = _without(docs, context.broadcast(items))
    return docs


def _without(docs: DataFrame, shared) -> DataFrame:
    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            held = {row for row, *_ in _matches(text, shared.value)}
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[list(held)] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, T.StructType(docs.schema.fields))
