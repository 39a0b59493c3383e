"""Exact top-k search by inner product, exhaustive and term at a time.

A component ``x`` of a vector counts as the integer ``floor(scale * x)``. A query is a
sparse row: its non-zero dimensions with their weights. For each of them, the postings
of that dimension, weighted, are scattered into dense arrays of scores, one per query,
over a block of candidates. The best ``k`` of each array are selected by partition, kept
per task, and merged by a ranking window.

Queries go out in blocks of at most about ``BLOCK`` rows (cut by a hash), so neither a
task nor the driver ever holds more; each block is one pass over the candidates, and its
results are written before the next begins. Candidates are not shuffled.

Vectors that are NULL, or hold NULL or a non-finite component, take no part. Vectors of
other lengths count as padded with zeros. Of rows that share a ``vec_id``, each is a
candidate, and one (the least vector) the query; a query never meets its own id. Ties go
to the smaller id. An empty table gives no rows; columns beyond id and vector are not read.

Scores are exact whatever the components: vectors whose products might leave 64 bits are
multiplied as integers of any length. A result that does not fit 64 bits fails.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

SCALE = 1024
K = 10
BLOCK = 1_024
_ROWS = 2_048


_TOP = np.iinfo(np.int64).max


def _matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Lists of whole numbers as rows, padded with zeros or cut to ``width``."""
    sizes = lists.value_lengths().to_numpy()
    width = int(sizes.max(initial=0)) if width is None else width
    flat = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(sizes), width))
    inside = column < width
    out[row[inside], column[inside]] = flat[inside]
    return out


def _accumulate(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Scores of every query with every candidate; what leaves 64 bits is ``_TOP`` or its negative."""
    limit = (2.0**62 / max(1, queries.shape[1])) ** 0.5
    small_q, small_b = (np.abs(x).max(axis=1, initial=0) < limit for x in (queries, block))
    if small_q.all() and small_b.all():
        return _sums(queries.astype(np.int64), block.astype(np.int64))
    scores = np.zeros((len(queries), len(block)), dtype=np.int64)
    wide = [np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (queries, block)]
    for q, b in ((small_q, small_b), (~small_q, small_b), (np.ones(len(queries), bool), ~small_b)):
        if not q.any() or not b.any():
            continue
        if b is small_b and q is small_q:
            part = _sums(queries[q].astype(np.int64), block[b].astype(np.int64))
        else:
            part = np.clip(_sums(wide[0][q], wide[1][b]), -_TOP, _TOP).astype(np.int64)
        scores[np.ix_(q, b)] = part
    return scores


def _sums(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Inner products, one term after the other."""
    scores = np.zeros((len(queries), len(block)), dtype=queries.dtype)
    for term in range(queries.shape[1]):
        asking, posting = np.flatnonzero(queries[:, term]), np.flatnonzero(block[:, term])
        if not len(asking) or not len(posting):
            continue
        if len(asking) == len(queries) and len(posting) == len(block):
            scores += queries[:, term, None] * block[None, :, term]
        else:
            added = queries[asking, term, None] * block[None, posting, term]
            scores[np.ix_(asking, posting)] += added
    return scores


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best: the highest scores, ties to smaller ids."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= bar)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _top_of(batches: Iterable[pa.RecordBatch], query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The best of all candidates of a task: ids and scores by query."""
    kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids]
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            part = batch.slice(low, _ROWS)
            ids = part.column("vec_id").to_numpy()
            scores = _accumulate(queries, _matrix(part.column("v"), queries.shape[1]))
            for q, own in enumerate(query_ids):
                row, (old_ids, old) = scores[q], kept[q]
                if len(old) == k:  # only what reaches the worst kept can enter
                    at = np.flatnonzero(row >= old[-1])
                    if not len(at):
                        continue
                    row, names = row[at], ids[at]
                else:
                    names = ids
                other = names != own
                names = np.concatenate([old_ids, names[other]])
                row = np.concatenate([old, row[other]])
                best = _best(names, row, k)
                kept[q] = (names[best], row[best])
    return kept


def _whole(x: Column, scale: int) -> Column:
    """``floor(scale * x)`` as a double, which beyond 2^52 is whole anyhow."""
    scaled = x * F.lit(float(scale))
    return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``vec_id, embedding``."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: _whole(x, scale)).alias("v"))
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = stored(asked, "queries")
    blocks = max(1, -(-asked.count() // block))
    results = []
    for i in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i).orderBy("vec_id").toArrow()
        found = _search(rows, part, k)
        results.append(found if blocks == 1 else stored(found, "found"))
    merged = results[0]
    for more in results[1:]:
        merged = merged.union(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, asked: pa.Table, k: int) -> DataFrame:
    """The ``k`` best of every task for a block of queries."""
    lists = asked["v"].combine_chunks()
    shared = rows.sparkSession.sparkContext.broadcast((asked["vec_id"].to_numpy(), _matrix(lists)))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        kept = _top_of(batches, query_ids, queries, k)
        if any((np.abs(scores) == _TOP).any() for _, scores in kept):
            raise OverflowError("a score does not fit 64 bits")
        sizes = [len(ids) for ids, _ in kept]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(query_ids, sizes)),
                pa.array(np.concatenate([np.zeros(0, np.int64), *(ids for ids, _ in kept)])),
                pa.array(np.concatenate([np.zeros(0, np.int64), *(scores for _, scores in kept)])),
            ],
            names=["query_id", "vec_id", "score"],
        )

    return rows.mapInArrow(search, "query_id long, vec_id long, score long")
