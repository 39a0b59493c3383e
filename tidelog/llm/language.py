"""Language identification with bit-sliced Bloom filters of character n-grams.

Every learned language has a set of n-grams. The sets are kept in one bit-sliced filter:
a table of slots, each a bitmask with one bit per language. The slots of an n-gram's
hashes, combined with AND, give all languages that (seem to) contain it, at once. For a
text, the bits of all its n-grams are counted per language. A language whose filter is
filled to the share ``f`` admits a foreign n-gram with chance ``f ** hashes``; counts are
corrected for that, and the largest share of recognized n-grams decides. Ties go to the
language that comes first by code point.

N-grams run over lower-cased letters; everything else reads as one blank per character,
and n-grams with two neighbouring blanks are left out, so they see single words and
where words meet. Texts are read whole, whatever their length. Rows that repeat a text are
learned once; an empty table, or one without labels, gives ``und`` for all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import words as W
from tidelog.llm.common import stored

N = 4
SLOT_BITS = 20
HASHES = 3
#: Distinct labelled texts per language that training reads, about; they are chosen by a hash.
SAMPLE = 4_000
#: The most n-grams a language keeps, the most frequent ones.
GRAMS = 30_000
#: A language with fewer n-grams that come twice also learns those that come once.
FEW = 1_000
#: A language takes an n-gram that is at least this often, relative to where it is most.
SHARE = 0.25
#: Languages that are learned: those with the most distinct labelled texts.
LANGUAGES = 512
UNKNOWN = "und"
SEGMENT = 1 << 19

_codes: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For every code point below 2^16 its lower-case letter, or 0."""
    global _codes
    if _codes is None:
        table = np.zeros(1 << 16, dtype=np.uint32)
        for c in range(1 << 16):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _codes = table
    return _codes


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of a text, in segments; nothing if it has no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    high = codes >= 1 << 16
    letters = _letters()[np.where(high, 0, codes)]
    if high.any():
        extra = [c if chr(c).isalpha() else 0 for c in codes[high].tolist()]
        letters[high] = extra
    if not letters.any():
        return
    padded = np.concatenate([np.zeros(N - 2, np.uint32), letters, np.zeros(N - 2, np.uint32)])
    for low in range(0, len(padded) - N + 1, SEGMENT):
        part = padded[low : low + SEGMENT + N - 1]
        blank = part == 0
        pair = blank[:-1] & blank[1:]
        bad = np.zeros(len(part) - N + 1, dtype=bool)
        for i in range(N - 1):
            bad |= pair[i : i + len(bad)]
        total = np.zeros(len(bad), dtype=W.U64)
        for i in range(N):
            total = total * W.U64(0x100000001B3) + part[i : i + len(bad)]
        yield W.mix(total[~bad])


@dataclass
class Filters:
    """The bit-sliced filter; ``fill`` is the share of slots that each language occupies.

    A mask has a word for each 64 languages, so ``slots`` is a list of tables.
    """

    languages: list[str]
    slots: list[np.ndarray]
    fill: np.ndarray

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """The first 64 languages of every n-gram, as bits."""
        return self.mask_words(hashes)[0]

    def mask_words(self, hashes: np.ndarray) -> list[np.ndarray]:
        """The languages of every n-gram, as bits, 64 to a word."""
        found: list[np.ndarray] = []
        for slot in _slots(hashes):
            own = [table[slot] for table in self.slots]
            found = [a & b for a, b in zip(found, own)] if found else own
        return found

    def shares(self, text: str) -> np.ndarray | None:
        """The corrected share of n-grams by language; None for a text without letters."""
        counts, n = np.zeros(len(self.languages)), 0
        for part in grams(text):
            masks = self.mask_words(part)
            n += len(part)
            for i in range(len(self.languages)):
                word = masks[i // 64]
                counts[i] += np.count_nonzero(word & word.dtype.type(1 << i % 64))
        if n == 0:
            return None if not any(c.isalpha() for c in text) else np.zeros(len(self.languages))
        wrong = self.fill**HASHES
        return np.clip((counts / n - wrong) / np.maximum(1 - wrong, 1e-9), 0, 1)


def _slots(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """The slots of every hash: double hashing over two halves."""
    step = (hashes >> W.U64(32)) | W.U64(1)
    for i in range(HASHES):
        yield ((hashes + W.U64(i) * step) & W.U64((1 << SLOT_BITS) - 1)).astype(np.int64)


def learn(docs: DataFrame, sample: int = SAMPLE, keep: int = GRAMS, most: int = LANGUAGES) -> Filters:
    """Filters from ``text`` and ``lang`` of labelled rows.

    About ``sample`` distinct texts of each language are read, chosen by a hash, however often
    they are repeated. Their n-grams are counted in the tasks and summed by Spark; a
    language's ``keep`` most frequent ones reach the driver, so what it holds does not grow
    with the input. At most ``most`` languages are learned.
    """
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null").withColumn("hash", F.xxhash64("text"))
    sizes = rows.select("lang", "hash").distinct().groupBy("lang").agg(F.count("*").alias("texts"))
    sizes = sizes.orderBy(F.desc("texts"), "lang").limit(most).collect()
    languages = sorted(r["lang"] for r in sizes)  # by code point, as UTF-8 is
    if not languages:
        return Filters([], [np.zeros(1 << SLOT_BITS, np.uint8)], np.zeros(0))
    limits = [(r["lang"], min(1_000_000, int(1_000_000 * sample / r["texts"]))) for r in sizes]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, limit int")
    chosen = rows.join(F.broadcast(limits), "lang").where(F.pmod("hash", F.lit(1_000_000)) < F.col("limit"))
    # copies of a chosen text meet in its task before one of them is moved
    rows = chosen.groupBy("lang", "hash").agg(F.min("text").alias("text")).select("lang", "text")

    counted = rows.mapInArrow(_counted, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_lang = counted.groupBy("lang").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 1).alias("again"))
    rate = counted.join(F.broadcast(by_lang), "lang").withColumn("rate", F.col("n") / F.col("total"))
    best = rate.groupBy("gram").agg(
        F.max("rate").alias("most"), F.collect_list(F.struct("lang", "rate", "n", "again")).alias("in")
    )
    kept = best.select("gram", "most", F.explode("in").alias("l"))
    kept = kept.where(f"l.rate >= {SHARE} * most and (l.n > 1 or l.again < {FEW})")
    kept = stored(kept.select("gram", "l.lang", "l.n"), "grams")
    slots = [
        np.zeros(1 << SLOT_BITS, dtype=_width(min(64, len(languages) - low))) for low in range(0, len(languages), 64)
    ]
    fill = np.zeros(len(languages))
    keep = min(keep, (1 << 21) // len(languages))
    for i, lang in enumerate(languages):
        top = kept.where(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(keep).select("gram")
        values = np.array([r[0] for r in top.collect()], dtype=np.int64).view(W.U64)
        word, bit = slots[i // 64], slots[i // 64].dtype.type(1 << i % 64)
        for slot in _slots(values):
            word[slot] |= bit
        fill[i] = np.count_nonzero(word & bit) / len(word)
    return Filters(languages, slots, fill)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each n-gram occurs in the texts of a language; ``SEGMENT`` of them wait to be counted."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[np.ndarray]] = {}
    held = 0

    def settle() -> None:
        for lang, found in waiting.items():
            values, n = np.unique(np.concatenate(found), return_counts=True)
            totals[lang] = _add(totals.get(lang), values, n)
        waiting.clear()

    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang")):
            for part in grams(text.as_py()):
                waiting.setdefault(lang.as_py(), []).append(part)
                held += len(part)
                if held >= SEGMENT:
                    settle()
                    held = 0
    settle()
    for lang, (values, n) in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(values)), pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))],
            names=["lang", "gram", "n"],
        )


def _width(n: int) -> type:
    return np.uint8 if n <= 8 else np.uint16 if n <= 16 else np.uint32 if n <= 32 else np.uint64


def _add(have, values: np.ndarray, n: np.ndarray):
    if have is None:
        return values, n
    both, at = np.unique(np.concatenate([have[0], values]), return_inverse=True)
    return both, np.bincount(at, weights=np.concatenate([have[1], n])).astype(np.int64)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``lang_score`` (0 to 1) from ``text``.

    ``und`` with score 0 stands for NULL texts and texts without a letter. A text with
    letters always gets a learned language (``und`` if none was learned). Columns of
    these two names are replaced.
    """
    docs = docs.drop("lang_pred", "lang_score")
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            names, scores = [], np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column("text")):
                shares = own.shares(text.as_py()) if text.is_valid and own.languages else None
                if shares is None:
                    names.append(UNKNOWN)
                else:
                    best = int(np.argmax(shares))
                    names.append(own.languages[best])
                    scores[i] = shares[best]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores)],
                names=[*batch.schema.names, "lang_pred", "lang_score"],
            )

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    return docs.mapInArrow(predict, T.StructType([*docs.schema.fields, *added]))
