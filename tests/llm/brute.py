"""Plain-Python counterparts of the operators, for small tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


def remainder(doc_id: int, divisor: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % divisor


def lines(docs: list[tuple], window: int = 3, few: int = 8) -> list[tuple]:
    """``doc_id, text, n_deleted`` of ``(doc_id, text)``, by comparing runs of lines.

    Runs have ``window`` lines, or fewer with ``few`` words in all, or are a whole text.
    """
    ordered = sorted(docs, key=lambda d: d[0])
    seen, out = set(), []
    for doc_id, text in ordered:
        if text is None:
            out.append((doc_id, None, 0))
            continue
        parts = text.split("\n")
        bodies = [x.strip(" \t\n\v\f\r") for x in parts if x.strip(" \t\n\v\f\r")]
        gone = set()
        for size in range(1, window + 1):
            for p in range(len(bodies) - size + 1):
                run = tuple(bodies[p : p + size])
                if size < window and size < len(bodies) and sum(len(words(x)) for x in run) < few:
                    continue
                if run in seen:
                    gone.update(range(p, p + size))
                seen.add(run)
        kept, at, cut = [], -1, False
        for line in parts:
            if line.strip(" \t\n\v\f\r"):
                at += 1
                cut = at in gone
            if not cut:
                kept.append(line)
        out.append((doc_id, "\n".join(kept), len(gone)))
    return out


def shingles(text: str | None, k: int) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def components(docs: list[tuple], k: int, percent: int) -> dict[int, tuple[int, int]]:
    """``doc_id -> (set size, component)`` by comparing all pairs."""
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def nearest(pattern: list, text: list) -> int:
    """The least edit distance of ``pattern`` to a stretch of ``text``."""
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for word in text:
        new = [0]
        for i, own in enumerate(pattern):
            new.append(min(column[i + 1] + 1, new[i] + 1, column[i] + (own != word)))
        column = new
        best = min(best, column[-1])
    return best


def marked_words(text: str | None) -> list[str]:
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def counts(docs: list[tuple]) -> Counter:
    """Token counts of the training texts, the end as None."""
    out = Counter()
    for doc_id, text in docs:
        if remainder(doc_id, 7) != 2:
            out.update([*words(text), None])
    return out
