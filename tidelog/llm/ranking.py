"""Exact ranked lexical search: accumulators from short lists, then documents at a time.

A term is a maximal run of letters, digits and non-ASCII characters, with A-Z lower-cased.
With ``N`` documents that have a term, ``L`` terms in all, ``df`` documents holding a term
and ``n`` terms in a document, a term weighs ``floor(1000 ln((2N+2)/(2df+1)))`` and adds, for
``tf`` occurrences, its weight times ``10^9 tf div (1000 tf + 8 m)``, ``m = 25 + 75 n N div L``.

Each task holds an index of some of the documents, a part at a time. For one query:

* term at a time, the postings of its *short* lists (together at most ``SHORT`` of the
  documents of the part) are summed into accumulators;
* the accumulators then serve as one more list with a known highest score, beside the
  *long* lists. Blocks of documents whose highest possible score cannot reach the worst
  kept result are skipped; in the others, a document is looked up in one long list after
  the other only while it can still reach it.

Results are exact: bounds skip only what scores less than ``k`` documents that the task
already holds. The postings (of the queries' terms only) are written once and read by
document; nothing but the ``k`` best of a task and query is shuffled. Queries go out in
blocks of about ``BLOCK_TERMS`` terms, so what is broadcast has a bound; a single longer
query is a block of its own. All documents are counted and searched, in each block.

A NULL or empty text has no terms: as a document it is not counted or found, as a query it
has no results. A NULL ``doc_id`` comes last among equal scores. Rows with the same id are
documents of their own; rows with equal id and text are one query, and of one item id
with several texts each is ranked by itself. Texts of any length are read whole. An empty
table on either side gives no rows. Other columns, whatever their names, are not read.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored, texts
from tidelog.llm.words import MARKS, find_words, slices, span_hashes

K = 10
BLOCK_TERMS = 1 << 20
SHORT = 1 / 8
_BLOCK = 256  # documents of a block that is skipped or read
_DOCUMENTS, _POSTINGS = 1 << 15, 1 << 22  # of a part of the index, in one task


# Postings


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``low, high, first, hashes`` of slices of rows: the terms of each row, in order."""
    for part in slices(column):
        found = find_words(part, MARKS)
        yield part.low, part.high, found.first, span_hashes(part.data, found.start, found.end)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id, n, codes, tfs`` of documents with a term: their terms in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            for low, high, first, hashes in _terms(batch.column("text")):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                row = np.repeat(np.arange(high - low), np.diff(first))[hit]
                pair, tf = np.unique(row * len(known) + at[hit], return_counts=True)
                sizes = np.bincount(pair // len(known), minlength=high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(low, high - low),
                        pa.array(np.diff(first)),
                        _lists(pair % len(known), sizes),
                        _lists(tf, sizes),
                    ],
                    names=["doc_id", "n", "codes", "tfs"],
                )

    schema = "doc_id long, n long, codes array<int>, tfs array<int>"
    return texts(docs).mapInArrow(index, schema).where("n > 0")


# Queries


def _queries(asked: pa.Table) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The distinct terms of all queries, and per query their codes and how often each comes."""
    hashes: list[np.ndarray] = []
    for chunk in asked["text"].chunks:
        for _, _, first, found in _terms(chunk):
            hashes.extend(found[a:b] for a, b in zip(first, first[1:]))
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
    codes, times = [], []
    for own in hashes:
        distinct, count = np.unique(own, return_counts=True)
        codes.append(np.searchsorted(vocabulary, distinct))
        times.append(count)
    return vocabulary, codes, times


# Searching


class _Part:
    """An index of some documents: for every term where it occurs and what it scores."""

    def __init__(self, codes: np.ndarray, rows: np.ndarray, values: np.ndarray, documents: int, terms: int):
        order = np.argsort(codes, kind="stable")
        self.rows, self.values, self.documents = rows[order], values[order], documents
        self.first = np.searchsorted(codes[order], np.arange(terms + 1))
        self.sizes = np.diff(self.first)
        self.edges = np.arange(0, documents, _BLOCK)
        self._peaks: dict[int, np.ndarray] = {}

    def list(self, code: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.first[code], self.first[code + 1]
        return self.rows[low:high], self.values[low:high]

    def peaks(self, code: int) -> np.ndarray:
        """The highest score of a list in every block of documents."""
        if code not in self._peaks:
            rows, values = self.list(code)
            out = np.zeros(len(self.edges), np.int64)
            at = np.flatnonzero(np.diff(rows // _BLOCK, prepend=-1))
            out[rows[at] // _BLOCK] = np.maximum.reduceat(values, at)
            self._peaks[code] = out
        return self._peaks[code]

    def search(self, codes: np.ndarray, times: np.ndarray, bar: int, k: int) -> Iterator[tuple]:
        """Documents with scores of ``bar`` or more, by and by; ``send`` raises the bar."""
        held = self.sizes[codes] > 0
        codes, times = codes[held], times[held]
        order = np.argsort(self.sizes[codes], kind="stable")
        codes, times = codes[order], times[order]
        short = int(np.searchsorted(np.cumsum(self.sizes[codes]), SHORT * self.documents, "right"))
        summed = np.zeros(self.documents, np.int64)
        for code, n in zip(codes[:short], times[:short]):
            rows, values = self.list(code)
            summed[rows] += n * values
        long = [(c, n, n * self.peaks(c)) for c, n in zip(codes[short:], times[short:])]
        long.sort(key=lambda x: -x[2].max())
        highest = np.maximum.reduceat(summed, self.edges)
        rest = np.sum([p for _, _, p in long], axis=0) if long else np.zeros_like(highest)
        ahead = np.argsort(-(highest + rest), kind="stable")
        done, step = 0, 1
        while done < len(ahead):
            # blocks by falling bound, a few at first, until none can reach the bar
            blocks = ahead[done : done + step]
            blocks = blocks[(highest + rest)[blocks] >= bar]
            if not len(blocks):
                break
            done, step = done + step, 2 * step
            rows = (np.sort(blocks)[:, None] * _BLOCK + np.arange(_BLOCK)).ravel()
            rows = rows[rows < self.documents]
            scores, left = summed[rows], rest[rows // _BLOCK]
            for code, n, peaks in [(None, 0, None), *long]:
                if code is not None:
                    there, values = self.list(code)
                    at = np.minimum(np.searchsorted(there, rows), len(there) - 1)
                    scores = scores + np.where(there[at] == rows, n * values[at], 0)
                    left = left - peaks[rows // _BLOCK]
                able = scores + left >= bar
                rows, scores, left = rows[able], scores[able], left[able]
            bar = max(bar, (yield rows, scores))


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Documents until there are enough for a part of the index."""
    held: list[pa.RecordBatch] = []
    documents = postings = 0
    for batch in batches:
        low = 0
        sizes = batch.column("codes").value_lengths().to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes)
        while low < batch.num_rows:
            before = upto[low - 1] if low else 0
            high = int(np.searchsorted(upto, before + _POSTINGS - postings, "right"))
            high = min(max(high, low + 1), batch.num_rows, low + _DOCUMENTS - documents)
            held.append(batch.slice(low, high - low))
            documents, postings, low = documents + high - low, postings + upto[high - 1] - before, high
            if documents >= _DOCUMENTS or postings >= _POSTINGS or low < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, documents, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _best(scores: np.ndarray, missing: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best: high scores, then small ids, NULL ids last."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], missing[at], -scores[at]))][:k]


def _search(index: DataFrame, codes: list, times: list, weights: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """``query, doc_id, score``: the ``k`` best of every task for every query of a block."""
    shared = index.sparkSession.sparkContext.broadcast((codes, times, weights))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, times, weights = shared.value
        none = np.zeros(0, np.int64)
        kept = [(none, none.astype(bool), none) for _ in codes]  # scores, is the id NULL, ids
        for table in _parts(batches):
            ids = table["doc_id"].combine_chunks()
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            lists = table["codes"].combine_chunks()
            row = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy(zero_copy_only=False))
            code = lists.flatten().to_numpy()
            tf = table["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
            m = 25 + 75 * table["n"].combine_chunks().to_numpy() * n // total
            value = weights[code] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
            part = _Part(code, row, value, len(ids), len(weights))
            for q, best in enumerate(kept):
                # only scores above 0 count, and with k results those from the worst of them on
                bar = max(1, int(best[0][-1])) if len(best[0]) == k else 1
                found = part.search(codes[q], times[q], bar, k)
                try:
                    rows, scores = next(found)
                    while True:
                        if len(rows):
                            best = tuple(
                                np.concatenate(pair) for pair in zip(best, (scores, missing[rows], ids[rows]))
                            )
                            top = _best(*best, k)
                            best = kept[q] = tuple(x[top] for x in best)
                        rows, scores = found.send(int(best[0][-1]) if len(best[0]) == k else 1)
                except StopIteration:
                    continue
        sizes = [len(scores) for scores, _, _ in kept]
        score, missing, ids = (np.concatenate([none, *(x[i] for x in kept)]) for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(kept)), sizes)),
                pa.array(ids, mask=missing.astype(bool)),
                pa.array(score),
            ],
            names=["query", "doc_id", "score"],
        )

    return index.mapInArrow(search, "query long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    asked = items.select(F.col("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.where("text is not null").distinct()
    # a block is chosen by hash; bytes bound terms
    spread = F.xxhash64("item_id", "text")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * block_terms)))
    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    results = [spark.createDataFrame([], schema)]
    for i in range(blocks):
        part = asked.where(F.pmod(spread, F.lit(blocks)) == i).orderBy("item_id", "text").toArrow()
        vocabulary, codes, times = _queries(part)
        if not len(vocabulary):
            continue
        index = stored(_postings(docs, vocabulary), "postings")
        n, total = index.agg(F.count("*"), F.sum("n")).first()
        if not n:
            continue
        held = index.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("df"))
        weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1)))
        weighed = held.select("code", weight.alias("weight")).toArrow()
        weights = np.zeros(len(vocabulary), np.int64)
        weights[weighed["code"].to_numpy()] = weighed["weight"].to_numpy()
        found = stored(_search(index, codes, times, weights, n, total, k), "ranked")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(
            [(q, item) for q, item in enumerate(part["item_id"].to_pylist())],
            f"query long, item_id {items.schema['item_id'].dataType.simpleString()}",
        )
        ranked = ranked.join(F.broadcast(names), "query")
        results.append(ranked.select("item_id", "rank", "doc_id", "score"))
    merged = results[0] if len(results) == 1 else results[1]
    for more in results[2:]:
        merged = merged.unionByName(more)
    return merged
