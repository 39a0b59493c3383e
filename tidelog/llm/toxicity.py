"""Toxicity scores from a factorization machine over hashed terms.

A text's terms are its distinct words, A-Z lower-cased and without ASCII marks, hashed to
``2 ** BITS`` buckets. A factorization machine scores ``b + sum w_i + sum <v_i, v_j>``
over the pairs of its terms, so that terms which are harmless alone can weigh together.

Training reads up to ``SAMPLE`` labelled texts, half of them of each label where there are as
many, chosen by a hash, and ``PAIRS`` terms of them. Every bucket of the sample has a weight
and factors. Most buckets are words seen a few times, and fitting them would learn the sample by
heart; so a bucket stays at rest until the slope of the loss in its weight, or in its
factors given those of the other terms of its texts, exceeds what chance
explains (``SURE``, ``SURE_PAIR``). It is asked twice: of the machine at rest, and of the machine fitted half-way, for
pairs it has missed. Neither word of a pair need follow the label alone. Moving buckets are fitted by
adaptive gradient steps on the logistic loss, in which both labels weigh alike, with L2; a
machine fitted to four fifths of the sample says, by the last, how far its output is to rise.
The driver holds the sample's buckets, bounded by ``PAIRS``, whatever the input.
Everything is seeded; equal samples give equal models.

Without labels of both kinds every text scores the share of label 1 (0.5 for none).
NULL and empty texts have no terms and score the bias. Texts of any length are read whole,
repeated rows are learned and scored as often as they come.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import words as W
from tidelog.llm.common import stored

BITS = 20
SAMPLE = 20_000
PAIRS = 1 << 23
SURE, SURE_PAIR = 5.0, 3.5  # of a weight; of factors, whose slope has FACTORS parts
FACTORS = 8
EPOCHS = 30
BATCH = 32
RATE = 0.2
SEED = 7
RUN = 1 << 18


def _terms(part: W.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every distinct term of the rows of a slice, in order."""
    words = W.find_words(part, W.MARKS)
    hashes = W.span_hashes(part.data, words.start, words.end)
    buckets = (hashes >> W.U64(64 - BITS)).astype(np.int64)
    codes = np.unique(words.rows() << BITS | buckets)
    return codes >> BITS, codes & ((1 << BITS) - 1)


@dataclass
class Machine:
    """Features by bucket (-1: none), and the parameters of the machine."""

    feature: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def scores(self, part: W.Slice) -> np.ndarray:
        rows, buckets = _terms(part)
        at = self.feature[buckets]
        rows, at = rows[at >= 0], at[at >= 0]
        return _sigmoid(_raw(self.bias, self.weight, self.factor, rows, at, part.high - part.low)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _raw(bias, weight, factor, rows, at, n) -> tuple[np.ndarray, np.ndarray]:
    """The machine's output by row, and the sums of factors."""
    linear = np.bincount(rows, weight[at], n)
    sums, squares = np.zeros((n, factor.shape[1])), np.zeros((n, factor.shape[1]))
    for k in range(factor.shape[1]):
        own = factor[at, k]
        sums[:, k] = np.bincount(rows, own, n)
        squares[:, k] = np.bincount(rows, own * own, n)
    return bias + linear + 0.5 * (sums**2 - squares).sum(1), sums


@dataclass
class _Sample:
    """Buckets of texts, text by text, and the labels; both labels weigh alike."""

    rows: np.ndarray
    at: np.ndarray
    label: np.ndarray

    def __post_init__(self):
        share = min(max(self.label.mean(), 1e-9), 1 - 1e-9)
        self.heavier = np.where(self.label == 1, 0.5 / share, 0.5 / (1 - share))
        self.bounds = np.searchsorted(self.rows, np.arange(len(self.label) + 1, dtype=self.rows.dtype))

    def of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position in ``chosen`` and bucket of every term of some texts."""
        n = np.diff(self.bounds)[chosen]
        own = np.repeat(np.arange(len(chosen)), n)
        place = np.repeat(self.bounds[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return own, self.at[place]

    def only(self, kept: np.ndarray) -> _Sample:
        mine = kept[self.at]
        return _Sample(self.rows[mine], self.at[mine], self.label)

    def part(self, chosen: np.ndarray) -> _Sample:
        """Some of the texts, as a sample."""
        place = np.cumsum(chosen, dtype=self.rows.dtype) - 1
        mine = chosen[self.rows]
        return _Sample(place[self.rows[mine]], self.at[mine], self.label[chosen])

    def errors(self, machine: tuple, chosen: np.ndarray) -> tuple:
        own, term = self.of(chosen)
        raw, sums = _raw(*machine, own, term, len(chosen))
        return own, term, (_sigmoid(raw) - self.label[chosen]) * self.heavier[chosen], sums


def _runs(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``RUN`` terms each."""
    low, n = 0, len(bounds) - 1
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + RUN, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def _each(of: Callable[[np.ndarray], np.ndarray], rows: np.ndarray) -> np.ndarray:
    """A function of an array's rows, by ``RUN`` of them."""
    return np.concatenate([of(rows[low : low + RUN]) for low in range(0, max(1, len(rows)), RUN)])


def _moving(sample: _Sample, machine: tuple, weights: bool) -> np.ndarray:
    """Buckets whose slopes chance does not explain: of their factors, and of their ``weights``."""
    terms = len(machine[1])
    slope, met = np.zeros(terms), np.zeros(terms)
    slopes, noise = np.zeros((terms, FACTORS)), np.zeros(terms)
    for low, high in _runs(sample.bounds):
        own, term, error, sums = sample.errors(machine, np.arange(low, high))
        slope += np.bincount(term, error[own], terms)
        met += np.bincount(term, minlength=terms)
        for k in range(FACTORS):
            each = error[own] * (sums[own, k] - machine[2][term, k])
            slopes[:, k] += np.bincount(term, each, terms)
            noise += np.bincount(term, each * each, terms)
    out = _each(lambda s: (s**2).sum(1), slopes) > SURE_PAIR**2 * np.maximum(noise, 1e-12)
    if weights:  # of a machine at rest the errors depend on the label alone
        share = sample.label.mean()
        spread = 1 / (16 * share) + 1 / (16 * (1 - share))
        out |= np.abs(slope) > SURE * np.sqrt(np.maximum(met * spread, 1e-12))
    return out


def _fit(sample: _Sample, terms: int) -> tuple[float, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    bias, weight = 0.0, np.zeros(terms)
    factor = rng.normal(0, 0.02, (terms, FACTORS))
    seen_w = np.full(terms, 1e-6)
    open_ = _moving(sample, (bias, weight, factor), True)
    own_sample = sample.only(open_)
    # only moving buckets have steps to remember
    at_v, seen_v = np.cumsum(open_) - 1, np.full((open_.sum(), FACTORS), 1e-6)
    for epoch in range(EPOCHS):
        if epoch == EPOCHS // 2:
            was = open_.copy()
            open_ |= _moving(sample, (bias, weight, factor), False)
            own_sample = sample.only(open_)
            at_v, before = np.cumsum(open_) - 1, seen_v
            seen_v = np.full((open_.sum(), FACTORS), 1e-6)
            seen_v[at_v[was]] = before
        order = rng.permutation(len(sample.label))
        rate = RATE / (1 + 0.1 * (epoch % (EPOCHS // 2)))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            own, term, error, sums = own_sample.errors((bias, weight, factor), chosen)
            error = error / len(chosen)
            bias -= rate * error.sum()
            touched, index = np.unique(term, return_inverse=True)
            step = np.bincount(index, error[own], len(touched)) + 1e-4 * weight[touched]
            seen_w[touched] += step**2
            steps = np.empty((len(touched), FACTORS))
            for k in range(FACTORS):
                slope = error[own] * (sums[own, k] - factor[term, k])
                steps[:, k] = np.bincount(index, slope, len(touched))
            steps += 2e-3 * factor[touched]
            met = at_v[touched]
            seen_v[met] += steps**2
            weight[touched] -= rate * step / np.sqrt(seen_w[touched])
            factor[touched] -= rate * steps / np.sqrt(seen_v[met])
    factor[~open_] = 0.0
    return bias, weight, factor


def _shift(sample: _Sample, terms: int) -> float:
    """How far outputs are to rise for most texts to be told right at 0.

    A machine whose labels weigh alike leans away from texts of which it knows few terms. One
    fitted to four fifths of the sample is tried on the last: 0, and whatever is lower, down
    to -3, and tells more texts right by being so.
    """
    apart = np.arange(len(sample.label)) % 5 == 0
    seen, tried = sample.part(~apart), sample.part(apart)
    if not 0 < seen.label.sum() < len(seen.label):
        return 0.0
    raw = _raw(*_fit(seen, terms), tried.rows, tried.at, len(tried.label))[0]
    order = np.argsort(-raw, kind="stable")
    raw, label = raw[order], tried.label[order]
    # told right if the first n are called toxic, against as many as lie above 0
    right = np.concatenate([[0], np.cumsum(2 * label - 1)])
    above = int((raw >= 0).sum())
    below = np.arange(above, int((raw >= -3).sum()) + 1)
    best = below[np.argmax(right[below])]
    if best == above:
        return 0.0
    following = raw[best] if best < len(raw) else -3.0
    return float(-(raw[best - 1] + max(following, -3.0)) / 2)


def _share_of_label(rows: DataFrame, by: str, sample: int) -> DataFrame:
    """Up to about ``sample / 2`` rows of each label, by a hash of ``by``; more of one if the other is rare."""
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    kept = {x: min(counts.get(x, 0), max(sample // 2, sample - counts.get(1 - x, 0))) for x in (0, 1)}
    limit = {x: int(1_000_000 * kept[x] / max(1, counts.get(x, 0))) for x in (0, 1)}
    place = F.pmod(F.xxhash64(by), F.lit(1_000_000))
    return rows.where(place < F.when(F.col("label") == 1, limit[1]).otherwise(limit[0]))


def labelled(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """``text, label`` of up to about ``sample`` labelled documents, chosen by a hash of the id.

    An id that is labelled 0 and 1 counts as 1. The sample's ids are broadcast; their
    number is bounded by the threshold of the hash.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    own = own.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = _share_of_label(own, "doc_id", sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "label")


def learn(labelled: DataFrame, sample: int = SAMPLE, pairs: int = PAIRS) -> Machine:
    """A machine from ``text`` and ``label`` (0 or 1; others are left out)."""
    rows = labelled.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("label").cast("int").alias("label")
    ).where("label in (0, 1)")
    rows = _share_of_label(rows, "text", sample)

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch.column("text")):
                own, buckets = _terms(part)
                count = part.high - part.low
                bounds = np.searchsorted(own, np.arange(count + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(buckets.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(part.low, count), lists], names=["label", "terms"]
                )

    found = stored(rows.mapInArrow(extract, "label int, terms array<int>"), "terms")
    held = found.agg(F.sum(F.size("terms"))).first()[0] or 0
    if held > pairs:
        found = found.where(F.pmod(F.xxhash64("terms", "label"), F.lit(1_000_000)) < int(1_000_000 * pairs / held))
    total, ones = found.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    feature = np.full(1 << BITS, -1, dtype=np.int32)
    if not 0 < ones < total:
        share = min(max(ones / total, 1e-6), 1 - 1e-6) if total else 0.5
        return Machine(feature, float(np.log(share / (1 - share))), np.zeros(1), np.zeros((1, FACTORS)))
    drawn, known = _ordered(found.toArrow())
    bias, weight, factor = _fit(drawn, len(known))
    moved = (weight != 0) | (factor != 0).any(1)
    feature[known[moved]] = np.arange(moved.sum())
    weight, factor = weight[moved], factor[moved]
    bias += _shift(drawn, len(known))
    return Machine(feature, bias, weight, factor)


def _ordered(table: pa.Table) -> tuple[_Sample, np.ndarray]:
    """The sample, in an order that does not depend on how its rows arrive, and its buckets.

    Terms are numbered by their buckets, which ascend in every text, and texts are moved as
    they are: beside the table this holds 12 bytes a term.
    """
    label = table["label"].to_numpy().astype(float)
    met = np.zeros(1 << BITS, dtype=bool)
    for lists in table["terms"].chunks:
        met[lists.flatten().to_numpy()] = True
    number = np.cumsum(met, dtype=np.int32) - np.int32(1)
    sizes = np.concatenate([lists.value_lengths().to_numpy() for lists in table["terms"].chunks])
    at = np.concatenate([number[lists.flatten().to_numpy()] for lists in table["terms"].chunks])
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    mark = np.zeros(len(label))
    for low, high in _runs(bounds):
        own = np.repeat(np.arange(high - low), sizes[low:high])
        marks = W.mix(at[bounds[low] : bounds[high]].astype(W.U64)) >> W.U64(20)
        mark[low:high] = np.bincount(own, marks.astype(float), high - low)
    order = np.lexsort((mark, label))
    moved = np.empty_like(at)
    ends = np.cumsum(sizes[order], dtype=np.int64)
    for low, high in _runs(np.concatenate([[0], ends])):
        chosen = order[low:high]
        begin = np.repeat(bounds[chosen] - (ends[low:high] - sizes[chosen]), sizes[chosen])
        first, last = ends[low] - sizes[chosen[0]], ends[high - 1]
        moved[first:last] = at[begin + np.arange(first, last)]
    rows = np.repeat(np.arange(len(label), dtype=np.int32), sizes[order])
    return _Sample(rows, moved, label[order]), np.flatnonzero(met)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """All columns of ``docs`` and ``toxicity`` (0 to 1; a column of that name goes)."""
    docs = docs.drop("toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.scores(part) for part in W.slices(batch.column("text"))]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores)], names=[*batch.schema.names, "toxicity"]
            )

    return docs.mapInArrow(rate, T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())]))
