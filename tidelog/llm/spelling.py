"""Spelling variants: Bloom-guided neighbourhoods over the vocabulary of a corpus.

Words are the runs of ``[A-Za-z\\u00C0-\\u00FF]`` of all texts, A-Z lower-cased, of five
code points and three occurrences at least. (Before counting, one code point of a run is
deleted in one of 97 of the pairs of document and run; which, a checksum says.) Two words
are *near* if one inserted, deleted or replaced code point turns one into the other.

Every word generates the hashes of its edits: one deletion per run of equal letters, and
the replacements by later letters. That is each near pair once, as insertions are deletions
seen from the other side. The edits of a word of length ``l`` are probed against the blocked
Bloom filters of the lengths ``l - 1`` and ``l``, which every task holds; only positives
become strings, are shuffled, and join the vocabulary exactly, which removes false ones.

The filters are built by a grouped ``bit_or`` of 64-bit blocks, ``BITS`` bits a word until
all have ``MAX_BLOCKS`` blocks (32 MB, the bound on what is broadcast). A larger vocabulary
makes them denser: more false positives go to the join, none are kept or missed.

A word's *form* is its most frequent near word if at least twice as frequent as itself, so
chains of forms are as long as the logarithm of the largest count, and pointer jumping
finds their ends in the logarithm of that.

NULL and empty texts hold no words; texts and words of any length are read whole, and the
edits of long words come in pieces. A NULL ``doc_id`` counts as empty text in the checksum.
Rows that repeat a document count again. Ties go to the smaller word. An empty table gives
no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored, texts
from tidelog.llm.words import BASE, U64, mix, powers

RUN = "[A-Za-zÀ-ÿ]+"
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])
MIN_LENGTH = 5
MIN_COUNT = 3
ONE_IN = 97
RATIO = 2

BITS = 16
MAX_BLOCKS = 1 << 22
LONGEST = 255  # words of this length and over share a filter
TASK_WORDS = 8_192
_SET = 4  # bits of a block that a word sets
_PIECE = 1 << 18  # edits probed at a time

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, one_in: int = ONE_IN) -> DataFrame:
    """``word, n``: the words of all texts and how often they occur."""
    own = texts(docs).where("text is not null")
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(RUN), F.lit(0))
    run = own.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    check = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    run = run.select("run", check.alias("check"), F.char_length("run").alias("length"))
    at = (F.col("check") % F.col("length")).cast("int")
    cut = F.concat(
        F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.col("length"))
    )
    word = F.when(F.col("check") % one_in == 0, cut).otherwise(F.col("run"))
    words = run.select(word.alias("word")).where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


# Hashes and filters


def _letters(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``length, places, letters``: words of one length, a bounded number at a time."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for n in np.unique(lengths):
        places = np.flatnonzero(lengths == n)
        width = max(1, _PIECE // max(n, len(LETTERS)))
        for low in range(0, len(places), width):
            some = places[low : low + width]
            codes = "".join(words[i] for i in some).encode("utf-32-le")
            yield int(n), some, np.frombuffer(codes, np.uint32).reshape(len(some), n).astype(np.int64)


def _values(letters: np.ndarray) -> np.ndarray:
    """A random value of each letter."""
    return mix((letters + 1).astype(U64) * U64(0x9E3779B97F4A7C15))


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(blocks) >> U64(32)).astype(np.int64)


def _mask(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(hashes.shape, U64)
    for i in range(_SET):
        bits |= U64(1) << (hashes >> U64(6 * i) & U64(63))
    return bits


def _shard(length: int) -> int:
    return min(length, LONGEST)


def _filters(words: DataFrame, bits: int, max_blocks: int) -> dict[int, np.ndarray]:
    """Per length its Bloom filter, as 64-bit blocks; ``max_blocks`` in all, but one each at least."""
    shard = F.least("length", F.lit(LONGEST))
    sizes = {r.shard: r.n for r in words.groupBy(shard.alias("shard")).agg(F.count("*").alias("n")).collect()}
    share = min(bits / 64, max_blocks / max(1, sum(sizes.values())))
    blocks = {length: max(1, int(n * share)) for length, n in sizes.items()}

    def marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, _, letters in _letters(batch.column("word").to_pylist()):
                hashes = mix(np.sum(_values(letters) * powers(BASE, n), axis=1))
                shard = np.full(len(hashes), _shard(n), np.int32)
                block = _block(hashes, blocks[_shard(n)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(block), pa.array(_mask(hashes).view(np.int64))],
                    names=["shard", "block", "mask"],
                )

    marked = words.select("word").mapInArrow(marks, "shard int, block long, mask long")
    built = marked.groupBy("shard", "block").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = {length: np.zeros(n, U64) for length, n in blocks.items()}
    shards, at = built["shard"].to_numpy(), built["block"].to_numpy()
    masks = built["mask"].to_numpy().view(U64)
    for length, own in out.items():
        mine = shards == length
        own[at[mine]] = masks[mine]
    return out


def _passes(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which hashes a filter may hold."""
    masks = _mask(hashes)
    return (own[_block(hashes, len(own))] & masks) == masks


# Edits


def _edits(words: list[str], filters: dict[int, np.ndarray]) -> Iterator[tuple[int, str]]:
    """``place, edit``: the words, less a letter or with a later one, that pass the filters."""
    for n, places, letters in _letters(words):
        step, values = powers(BASE, n), _values(letters)
        terms = values * step
        before = np.cumsum(terms, axis=1) - terms
        total = terms.sum(axis=1)
        if n > 1 and _shard(n - 1) in filters:
            # without a letter, those after it move one place down
            down = values[:, 1:] * step[:-1]
            after = np.zeros_like(values)
            after[:, :-1] = down[:, ::-1].cumsum(axis=1)[:, ::-1]
            once = np.diff(letters, axis=1, prepend=-1) != 0  # of equal neighbours, the first
            row, at = np.nonzero(once)
            hit = _passes(mix((before + after)[row, at]), filters[_shard(n - 1)])
            for r, i in zip(row[hit], at[hit]):
                word = words[places[r]]
                yield places[r], word[:i] + word[i + 1 :]
        fresh = _values(LETTERS)
        for i in range(n):
            row, letter = np.nonzero(LETTERS[None, :] > letters[:, i, None])
            hashes = mix(total[row] + (fresh[letter] - values[row, i]) * step[i])
            hit = _passes(hashes, filters[_shard(n)])
            for r, c in zip(row[hit], letter[hit]):
                word = words[places[r]]
                yield places[r], word[:i] + chr(LETTERS[c]) + word[i + 1 :]


def near_pairs(words: DataFrame, bits: int = BITS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``word, n, near, near_n``: each near pair of ``word, n`` both ways."""
    sized = words.select("word", "n", F.char_length("word").cast("int").alias("length"))
    shared = words.sparkSession.sparkContext.broadcast(_filters(sized, bits, max_blocks))

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch, places, edits):
            places = pa.array(places, pa.int64())
            taken = [batch.column(c).take(places) for c in ("word", "n")]
            return pa.RecordBatch.from_arrays([pa.array(edits, pa.string()), *taken], names=["near", "word", "n"])

        for batch in batches:
            places, edits, size = [], [], 0
            for place, edit in _edits(batch.column("word").to_pylist(), shared.value):
                places.append(place)
                edits.append(edit)
                size += len(edit)
                if size > _PIECE:
                    yield rows(batch, places, edits)
                    places, edits, size = [], [], 0
            yield rows(batch, places, edits)

    # probing is much work for few bytes, so it is dealt out by words
    tasks = max(1, -(-words.count() // TASK_WORDS))
    dealt = sized.select("word", "n").repartition(tasks, "word")
    passed = dealt.mapInArrow(probe, "near string, word string, n long")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = passed.join(known, "near").select("word", "n", "near", "near_n")

    def pair(*columns: str):
        return F.struct(*[F.col(c).alias(name) for c, name in zip(columns, ("word", "n", "near", "near_n"))])

    both = F.array(pair("word", "n", "near", "near_n"), pair("near", "near_n", "word", "n"))
    return pairs.select(F.inline(both))


def _ends(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last word of the chain of forms."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = now.join(further, "root", "left")
        after = stored(jumped.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if after.where("next is not null").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts."""
    words = stored(vocabulary(docs), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = near_pairs(words).groupBy("word").agg(F.first("n").alias("own"), F.count("*").alias("n_near"), best)
    form = F.when(-F.col("best.less") >= ratio * F.col("own"), F.col("best.near"))
    found = stored(found.select("word", "n_near", form.alias("form"), (-F.col("best.less")).alias("near_n")), "forms")
    roots = _ends(found.where("form is not null"))
    joined = words.join(found, "word", "left").join(roots, "word", "left")
    return joined.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("near_n")).alias("form_n"),
    )
