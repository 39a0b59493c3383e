"""Scoring texts with a class-based bigram model (Brown and others, 1992).

``P(text)`` is the product, over its tokens, of ``P(class | context)`` and
``P(word | class)``. The tokens are the words, A-Z lower-cased, and one end. The context is
the class of the token before; all words outside the core, the ``CORE`` most frequent, are one
context, as they are too rare to tell what follows them.

* Word counts cover all training texts; tasks count their words before Spark sums them.
* Every word of the training texts has one of ``CLASSES`` classes, by exchange. The likelihood of the class
  bigrams is ``sum f(N(c,d)) - sum f(N(c,.)) - sum f(N(.,d))``, ``f(x) = x log x``. The
  ``SEEDS`` most frequent words are exchanged one by one first. Then the core's words are
  exchanged in rounds: the words before and after each are kept as a table, a row a word; tasks
  score every word in every class against the class matrix (to first order, without
  the word's own share), and half of the words move at a time, until the likelihood settles.
  All other words, the tail, then join the class that their neighbours make likeliest.
* A word not seen in training has one of ``KINDS`` classes by its length in bytes. How likely
  they are after a context is told by the words seen once.
* Transitions are smoothed towards class frequencies.

What reaches the driver is bounded: counts and classes of the ``HEAD`` most frequent words, and
matrices of classes. Tasks look the head up locally; other words of a text are joined with the
tail's classes. Frequent words are never shuffled, so no hot word exists in that join.

Words are told apart by 64-bit hashes. Rows with one id and text are scored as copies of
one document. NULL text is empty: one end. Texts of any length are read whole. Nothing to learn
from, or an empty table, leaves a uniform model. Columns beyond id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import words as W
from tidelog.llm.common import stored

CLASSES = 48
SEEDS, SWEEPS = 512, 6
#: The exchange ends when a round gains less than this share of the likelihood.
SETTLED = 1e-4
KINDS = 16
CORE, HEAD = 1 << 15, 1 << 18
_BUFFER = 1 << 21
_PRIOR = 20.0

# Contexts are the classes, then the tail, then the end; targets the classes, the end, the kinds.
TAIL, END = CLASSES, CLASSES + 1
CONTEXTS, TARGETS = CLASSES + 2, CLASSES + 1 + KINDS


@dataclass
class Head:
    """The most frequent words: sorted hashes, counts, lengths; ``all`` if there are no others."""

    words: np.ndarray
    n: np.ndarray
    kind: np.ndarray
    all: bool


@dataclass
class Model:
    """What tasks need to score: the head with its classes, and log10 probabilities."""

    head: Head
    own: np.ndarray  # class of each head word
    symbol: np.ndarray  # what it is as a context: its class, or the tail
    size: np.ndarray  # tokens of each class
    transition: np.ndarray  # log10 P(target | context)
    tokens: int
    types: int
    ends: int

    @property
    def emission(self) -> np.ndarray:
        """log10 P(word | class) of each head word."""
        return np.log10(self.head.n / self.size[self.own])

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 1) / (self.tokens + self.types + 1))


def _find(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The position of every hash in a sorted array; -1 where it is not there."""
    if not len(known):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


def _tokens(part: W.Slice) -> tuple[W.Words, np.ndarray, np.ndarray]:
    """The words of a slice, their hashes and kinds."""
    words = W.find_words(part)
    hashes = W.span_hashes(part.data, words.start, words.end)
    return words, hashes, np.minimum(words.end - words.start, KINDS) - 1


def _sequence(words: W.Words, symbols: np.ndarray, end: int) -> np.ndarray:
    """An end, then the symbols of every text, each with its end."""
    out = np.full(len(symbols) + len(words.first), end, dtype=np.int64)
    out[np.arange(len(symbols)) + words.rows() + 1] = symbols
    return out


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, kind, n`` over all texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting:
                hashes, kinds = (np.concatenate(x) for x in zip(*waiting))
                values, at, n = np.unique(hashes, return_index=True, return_counts=True)
                columns = [values.view(np.int64), kinds[at].astype(np.int32), n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["word", "kind", "n"])
                waiting.clear()

        for batch in batches:
            for part in W.slices(batch.column("text")):
                _, hashes, kinds = _tokens(part)
                waiting.append((hashes, kinds))
                if sum(len(h) for h, _ in waiting) > _BUFFER:
                    yield from flush()
        yield from flush()

    counted = texts.select("text").mapInArrow(count, "word long, kind int, n long")
    return counted.groupBy("word").agg(F.min("kind").alias("kind"), F.sum("n").alias("n"))


def _head(counts: DataFrame, size: int) -> Head:
    """The most frequent words, ``size`` at most, found by a histogram of counts."""
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    low, total = 1 << 30, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        if total + row["words"] > size:
            break
        total += row["words"]
        low = row["step"]
    found = counts.where(step >= low).toArrow()
    words = found["word"].to_numpy().view(W.U64)
    order = np.argsort(words)
    n, kind = found["n"].to_numpy()[order], found["kind"].to_numpy()[order]
    return Head(words[order], n, kind, total == sum(r["words"] for r in steps))


def _contexts(texts: DataFrame, head: Head) -> DataFrame:
    """``word, near, n``: for each word of the core the tokens before and after it, and how often.

    Words are positions in the core; ``near`` is twice such a position (or that of the tail
    or the end, past the last) and 1 for a token before. A row holds at most two entries a word.
    """
    size = len(head.words)
    shared = texts.sparkSession.sparkContext.broadcast(head.words)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting:
                codes, n = np.unique(np.concatenate(waiting), return_counts=True)
                word, near = np.divmod(codes, 2 * (size + 2))
                columns = [word.astype(np.int32), near.astype(np.int32), n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["word", "near", "n"])
                waiting.clear()

        for batch in batches:
            for part in W.slices(batch.column("text")):
                words, hashes, _ = _tokens(part)
                at = _find(shared.value, hashes)
                line = _sequence(words, np.where(at >= 0, at, size), size + 1)
                before, after = line[:-1], line[1:]
                for word, near, side in ((before, after, 0), (after, before, 1)):
                    mine = word < size
                    waiting.append((word[mine] * (size + 2) + near[mine]) * 2 + side)
                if sum(map(len, waiting)) > _BUFFER:
                    yield from flush()
        yield from flush()

    counted = texts.select("text").mapInArrow(count, "word int, near int, n long")
    summed = counted.groupBy("word", "near").agg(F.sum("n").alias("n"))
    lists = summed.groupBy("word").agg(F.collect_list(F.struct("near", "n")).alias("of"))
    return stored(lists.select("word", F.col("of.near").alias("near"), F.col("of.n").alias("n")), "contexts")


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Row, word, neighbour, side and count of every entry of a batch of contexts."""
    near = batch.column("near")
    row = np.repeat(np.arange(batch.num_rows), near.value_lengths().to_numpy(zero_copy_only=False))
    code = near.flatten().to_numpy()
    n = batch.column("n").flatten().to_numpy().astype(float)
    return row, batch.column("word").to_numpy()[row], code >> 1, code & 1, n


def _summed(contexts: DataFrame, shape: tuple[int, int], cells) -> np.ndarray:
    """A matrix summed over all entries; ``cells`` gives rows, columns and values of a batch."""
    size = shape[0] * shape[1]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            row, column, value = cells(*_entries(batch))
            total += np.bincount(row * shape[1] + column, value, size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    found = contexts.mapInArrow(count, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(shape)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(bigrams: np.ndarray, movable: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of every symbol: the first ``movable`` are clustered, others stand alone.

    The likelihood of class bigrams is ``sum f(N(c,d)) - sum f(N(c,.)) - sum f(N(.,d))``
    with ``f(x) = x log x``, up to a constant. A word is taken out of its class and put
    where this gains most (on ties the first class).
    """
    n = len(bigrams)
    total = classes + n - movable
    own = np.concatenate([np.arange(movable) % classes, np.arange(classes, total)])
    member = np.zeros((n, total))
    member[np.arange(n), own] = 1
    pairs = member.T @ bigrams @ member
    right, left = bigrams @ member, bigrams.T @ member  # of each word, by class
    diagonal = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for w in range(movable):
            a, twice = own[w], bigrams[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[a] -= twice
            l[a] -= twice
            pairs[a] -= r
            pairs[:, a] -= l
            pairs[a, a] -= twice
            rows, columns = pairs[:classes], pairs[:, :classes].T
            out = _xlogx(rows + r) - _xlogx(rows)
            into = _xlogx(columns + l) - _xlogx(columns)
            gain = out.sum(1) - out[diagonal, diagonal] + into.sum(1) - into[diagonal, diagonal]
            within = pairs[diagonal, diagonal]
            gain += _xlogx(within + r[:classes] + l[:classes] + twice) - _xlogx(within)
            for sums, change in ((rows.sum(1) + l[:classes], r), (columns.sum(1) + r[:classes], l)):
                gain -= _xlogx(sums + change.sum() + twice) - _xlogx(sums)
            b = int(np.argmax(gain))
            pairs[b] += r
            pairs[:, b] += l
            pairs[b, b] += twice
            if b != a:
                moved += 1
                own[w] = b
                for by_class, change in ((right, bigrams[:, w]), (left, bigrams[w])):
                    by_class[:, a] -= change
                    by_class[:, b] += change
        if not moved:
            break
    return own


def _symbols(own: np.ndarray) -> np.ndarray:
    """The context of every head position, and of the tail and the end past the last."""
    return np.append(own, [TAIL, END])


def _matrix(contexts: DataFrame, own: np.ndarray) -> np.ndarray:
    """How often one context follows another, where one of both is a head word."""
    symbol, size = _symbols(own), len(own)

    def cells(row, word, near, side, n):
        # a pair of head words is met from both sides, and counts once
        use = (side == 0) | (near >= size)
        first, second = np.where(side == 0, word, near)[use], np.where(side == 0, near, word)[use]
        return symbol[first], symbol[second], n[use]

    return _summed(contexts, (CONTEXTS, CONTEXTS), cells)


def _likelihood(pairs: np.ndarray) -> float:
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(0)).sum() - _xlogx(pairs.sum(1)).sum())


def _best(left: np.ndarray, right: np.ndarray, pairs: np.ndarray, own: np.ndarray | None) -> np.ndarray:
    """The class that gains most likelihood for each word, by the contexts before and after it.

    A word counts in its own class without itself.
    """
    eps = 0.5
    logs, n = np.log(pairs + eps), left.sum(1)
    follows, leads = np.log(pairs.sum(0) + eps), np.log(pairs.sum(1) + eps)
    score = left @ logs[:, :CLASSES] + right @ logs[:CLASSES].T
    score -= n[:, None] * (follows[:CLASSES] + leads[:CLASSES])
    if own is not None and len(own):
        placed = np.flatnonzero(own < CLASSES)
        a, l, r, m = own[placed], left[placed], right[placed], n[placed]
        alone = (l * np.log(np.maximum(pairs[:, a].T - l, 0) + eps)).sum(1)
        alone += (r * np.log(np.maximum(pairs[a] - r, 0) + eps)).sum(1)
        for sums in (pairs.sum(0)[a], pairs.sum(1)[a]):
            alone -= m * np.log(np.maximum(sums - m, 0) + eps)
        score[placed, a] = alone
    return score.argmax(1)


def _proposals(contexts: DataFrame, own: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Head words that had better be in another class, and which."""
    shared = contexts.sparkSession.sparkContext.broadcast((own, pairs))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pairs = shared.value
        symbol = _symbols(own)
        for batch in batches:
            row, _, near, side, n = _entries(batch)
            shape = (2, batch.num_rows, CONTEXTS)
            cell = (side * batch.num_rows + row) * CONTEXTS + symbol[near]
            right, left = np.bincount(cell, n, 2 * batch.num_rows * CONTEXTS).reshape(shape)
            word = batch.column("word").to_numpy()
            best = _best(left, right, pairs, own[word])
            moves = best != own[word]
            columns = [pa.array(word[moves]), pa.array(best[moves].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "class"])

    found = contexts.select("word", "near", "n").mapInArrow(score, "word int, class int").toArrow()
    return found["word"].to_numpy(), found["class"].to_numpy()


def _seeded(contexts: DataFrame, head: Head) -> np.ndarray:
    """Classes of the most frequent words by exchange; the others are still in the tail."""
    often = np.lexsort((head.words, -head.n))[:SEEDS]
    place = np.full(len(head.words) + 2, len(often))
    place[often], place[-1] = np.arange(len(often)), len(often) + 1

    def cells(row, word, near, side, n):
        use = (place[word] < len(often)) & ((side == 0) | (place[near] >= len(often)))
        first, second = np.where(side == 0, word, near)[use], np.where(side == 0, near, word)[use]
        return place[first], place[second], n[use]

    own = np.full(len(head.words), TAIL)
    if len(often):
        bigrams = _summed(contexts, (len(often) + 2, len(often) + 2), cells)
        own[often] = exchange(bigrams, len(often))[: len(often)]
    return own


def head_classes(contexts: DataFrame, head: Head) -> np.ndarray:
    """The class of every head word, by exchange in rounds until the likelihood settles."""
    own = _seeded(contexts, head)
    pairs = _matrix(contexts, own)
    best, before, turn = own, -np.inf, 0
    while True:
        word, to = _proposals(contexts, own, pairs)
        new = own[word] == TAIL
        # half of the words at a time, so that two that suit each other do not swap for ever
        mine = new | (W.mix(word.astype(W.U64)) % W.U64(2) == W.U64(turn % 2))
        own = own.copy()
        own[word[mine]] = to[mine]
        pairs = _matrix(contexts, own)
        now, turn = _likelihood(pairs), turn + 1
        if now > before:
            best = own
        if not len(word) or (turn > 1 and now - before < SETTLED * abs(now)):
            return best
        before = now


def _tail(texts: DataFrame, core: Head, own: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """``word, kind, n, class`` of the words outside the core, and ``around, times``: the
    contexts before and after them, as ``before * CONTEXTS + after``.

    Each of them is rarer than the whole core, so none is hot.
    """
    shared = texts.sparkSession.sparkContext.broadcast((core.words, own, pairs))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own, _ = shared.value
        symbol = _symbols(own)
        waiting: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting:
                hashes, kinds, around = (np.concatenate(x) for x in zip(*waiting))
                order = np.lexsort((around, hashes))
                hashes, kinds, around = hashes[order], kinds[order], around[order]
                new = np.ones(len(hashes), dtype=bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (around[1:] != around[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(hashes)))
                columns = [hashes[at].view(np.int64), kinds[at].astype(np.int32), around[at].astype(np.int32), times]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["word", "kind", "around", "times"]
                )
                waiting.clear()

        for batch in batches:
            for part in W.slices(batch.column("text")):
                words, hashes, kinds = _tokens(part)
                at = _find(known, hashes)
                line = symbol[_sequence(words, np.where(at >= 0, at, len(own)), len(own) + 1)]
                here = np.arange(len(at)) + words.rows() + 1
                rare = at < 0
                around = line[here[rare] - 1] * CONTEXTS + line[here[rare] + 1]
                waiting.append((hashes[rare], kinds[rare], around))
                if sum(len(x) for x, _, _ in waiting) > _BUFFER:
                    yield from flush()
        yield from flush()

    met = texts.select("text").mapInArrow(count, "word long, kind int, around int, times long")
    # one shuffle, by word, serves both groupings
    met = met.repartition("word").groupBy("word", "around").agg(F.min("kind").alias("kind"), F.sum("times").alias("times"))
    lists = met.groupBy("word").agg(
        F.min("kind").alias("kind"), F.sum("times").alias("n"), F.collect_list(F.struct("around", "times")).alias("of")
    )
    lists = lists.select("word", "kind", "n", F.col("of.around").alias("around"), F.col("of.times").alias("times"))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared.value[2]
        for batch in batches:
            around, size = batch.column("around"), batch.num_rows
            row = np.repeat(np.arange(size), around.value_lengths().to_numpy(zero_copy_only=False))
            code, n = around.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            left, right = (
                np.bincount(row * CONTEXTS + side, n, size * CONTEXTS).reshape(size, CONTEXTS)
                for side in np.divmod(code, CONTEXTS)
            )
            best = pa.array(_best(left, right, pairs, None).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, best], names=[*batch.schema.names, "class"])

    return stored(
        lists.mapInArrow(place, "word long, kind int, n long, around array<int>, times array<long>, class int"), "tail"
    )


def learn(texts: DataFrame, counts: DataFrame) -> tuple[Model, DataFrame | None]:
    """A model of ``texts``, whose ``word_counts`` are ``counts``, and its tail (None: no words)."""
    head, core = _head(counts, HEAD), _head(counts, min(CORE, HEAD))
    contexts = _contexts(texts, core)
    own = head_classes(contexts, core)
    pairs = _matrix(contexts, own)
    words, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = texts.count()

    # targets after contexts: words, words seen once by length, and ends
    symbol, single = _symbols(own), core.n == 1

    def targets(row, word, near, side, n):
        seen = side == 1
        once = seen & single[word]
        stop = (side == 0) & (near == len(own) + 1)
        context = np.concatenate([symbol[near[seen]], symbol[near[once]], symbol[word[stop]]])
        target = np.concatenate([own[word[seen]], CLASSES + 1 + core.kind[word[once]], np.full(stop.sum(), CLASSES)])
        return context, target, np.concatenate([n[seen], n[once], n[stop]])

    after = _summed(contexts, (CONTEXTS, TARGETS), targets)
    size = np.bincount(own[own < CLASSES], core.n[own < CLASSES], CLASSES)
    tail = None if core.all else _tail(texts, core, own, pairs)
    if tail is not None:
        each = tail.select("kind", "n", "class", F.explode(F.arrays_zip("around", "times")).alias("a"))
        before, behind = F.expr(f"a.around div {CONTEXTS}"), F.col("a.around") % CONTEXTS
        each = each.select(
            "class", before.cast("int").alias("before"), (behind == END).alias("stops"),
            F.when(F.col("n") == 1, F.col("kind")).alias("once"), F.col("a.times").alias("times"),
        )
        for r in each.groupBy("class", "before", "stops", "once").agg(F.sum("times").alias("times")).collect():
            after[r["before"], r["class"]] += r["times"]
            size[r["class"]] += r["times"]
            if r["stops"]:
                after[TAIL, CLASSES] += r["times"]
            if r["once"] is not None:
                after[r["before"], CLASSES + 1 + r["once"]] += r["times"]
    after[END, CLASSES] = ends - after[:, CLASSES].sum()  # texts without words
    share = (after.sum(0) + 1) / (after.sum() + TARGETS)
    transition = (after + _PRIOR * share) / (after.sum(1, keepdims=True) + _PRIOR)
    at = _find(core.words, head.words)
    inside = at >= 0
    classes, context = np.zeros(len(at), np.int64), np.full(len(at), TAIL)
    classes[inside] = context[inside] = own[at[inside]]
    if not inside.all():
        # a word as frequent as one of the head is in the head
        middle = tail.where(F.col("n") >= int(head.n.min())).select("word", "class").toArrow()
        found = _find(head.words, middle["word"].to_numpy().view(W.U64))
        classes[found] = middle["class"].to_numpy()
    return Model(
        head, classes, context, np.maximum(size, 1), np.log10(transition), words + ends, types + (ends > 0), ends
    ), tail


_SCORED = (
    "doc_id long, version long, n_tokens long, n_known long, base double, score double, "
    "tail array<struct<word: long, kind: int, context: int, n: long>>"
)


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """Every row scored but for the words outside the head, which it lists."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        emission = own.emission
        for batch in batches:
            for part in W.slices(batch.column("text")):
                yield _score(own, emission, batch, part)

    return docs.select("doc_id", "version", "text").mapInArrow(score, _SCORED)


def _score(own: Model, emission: np.ndarray, batch: pa.RecordBatch, part: W.Slice) -> pa.RecordBatch:
    words, hashes, kinds = _tokens(part)
    rows, docs, size = words.rows(), part.high - part.low, len(own.head.words)
    at = _find(own.head.words, hashes)
    seen = at >= 0
    line = _sequence(words, np.where(seen, at, size), size + 1)
    context = _symbols(own.symbol)[line]
    here = np.arange(len(at)) + words.rows() + 1
    before = context[here - 1]
    ends = words.first[1:] + np.arange(docs) + 1  # where each row's end lies in the line
    total = own.transition[context[ends - 1], CLASSES]
    known = at[seen]
    step = own.transition[before[seen], own.own[known]] + emission[known] if len(known) else np.zeros(0)
    total = total + np.bincount(rows[seen], step, docs)
    base = own.base(own.head.n[known]) if len(known) else np.zeros(0)
    base = np.bincount(rows[seen], base, docs) + own.base(np.array(own.ends))
    n_known = np.bincount(rows[seen], minlength=docs) + (own.ends > 0)

    # the tail: each row's words that the head lacks, by context, once, with their number
    rare = ~seen
    order = np.lexsort((before[rare], hashes[rare], rows[rare]))
    row, word, kind, after = (x[rare][order] for x in (rows, hashes, kinds, before))
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (word[1:] != word[:-1]) | (after[1:] != after[:-1])
    begins = np.flatnonzero(new)
    tail = pa.StructArray.from_arrays(
        [
            pa.array(word[begins].view(np.int64)),
            pa.array(kind[begins].astype(np.int32)),
            pa.array(after[begins].astype(np.int32)),
            pa.array(np.diff(np.append(begins, len(row)))),
        ],
        names=["word", "kind", "context", "n"],
    )
    bounds = np.searchsorted(row[begins], np.arange(docs + 1)).astype(np.int32)
    arrays = [words.counts + 1, n_known.astype(np.int64), base, total]
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(c).slice(part.low, docs) for c in ("doc_id", "version")),
            *(pa.array(x) for x in arrays),
            pa.ListArray.from_arrays(pa.array(bounds), tail),
        ],
        names=["doc_id", "version", "n_tokens", "n_known", "base", "score", "tail"],
    )


def score_texts(docs: DataFrame, learn_from: Column) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score``: one row per row.

    Training reads the rows where ``learn_from``, a condition on ``doc_id``, holds.
    ``base_score`` is that of an add-one unigram model.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    training = docs.where(learn_from)
    counts = stored(word_counts(training), "counts")
    model, known = learn(training, counts)

    scored = stored(_scored(docs.withColumn("version", F.xxhash64("text")), model), "scored")
    tail = scored.select("doc_id", "version", F.explode("tail").alias("t")).select("doc_id", "version", "t.*")
    if known is None:
        seen = tail.withColumns({"c": F.lit(None).cast("long"), "class": F.lit(None).cast("int")})
    else:
        seen = tail.join(known.select("word", F.col("n").alias("c"), "class"), "word", "left")
    target = F.coalesce("class", F.col("kind") + CLASSES + 1)
    steps = [(i, j, float(model.transition[i, j])) for i in range(CONTEXTS) for j in range(TARGETS)]
    steps = spark.createDataFrame(steps, "context int, target int, step double")
    sizes = spark.createDataFrame([(i, float(np.log10(x))) for i, x in enumerate(model.size)], "class int, size double")
    seen = seen.withColumn("target", target).join(F.broadcast(steps), ["context", "target"])
    seen = seen.join(F.broadcast(sizes), "class", "left")
    emitted = F.when(F.col("c").isNotNull(), F.log10("c") - F.col("size")).otherwise(0.0)
    c = F.coalesce("c", F.lit(0))
    own = seen.select(
        "doc_id",
        "version",
        F.lit(0).cast("long").alias("copies"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.when(c > 0, F.col("n")).otherwise(0).cast("long").alias("n_known"),
        (F.col("n") * F.log10((c + 1) / F.lit(float(model.tokens + model.types + 1)))).alias("base"),
        (F.col("n") * (F.col("step") + emitted)).alias("score"),
    )
    head = scored.select("doc_id", "version", F.lit(1).cast("long").alias("copies"), "n_tokens", "n_known", "base", "score")
    sums = head.union(own).groupBy("doc_id", "version").agg(
        *(F.sum(c).alias(c) for c in ("copies", "n_tokens", "n_known", "base", "score"))
    )
    again = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    each = sums.withColumn("copy", again)
    return each.select(
        "doc_id",
        F.expr("n_tokens div copies").alias("n_tokens"),
        F.expr("n_known div copies").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
