"""Sharding, ranked search and spelling variants: plain Python, planted cases, odd rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import queries, ranking, sharding, spelling

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
CLASH = ("n", "code", "codes", "score", "rank", "query", "word", "near", "root", "place", "task", "size", "shard", "slot", "rows")


def frame(spark, rows, kind="doc_id long, text string"):
    df = spark.createDataFrame(rows, kind)
    return df.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, empty, long and repeated texts, and ids that repeat or lack."""
    rows = [
        (0, "spelling of the words"), (0, "spelling of the words"), (1, None), (2, ""), (3, " \n\t ,,,"),
        (4, LONG), (None, "spelling of the words"), (None, None), (5, "x" * 70_000), (6, "É" * 3_000 + " ÷ é"),
        (7, "Spellinf spellinf SPELLINF"), (9, "other words\x00here"), (8, "of of of spelling words the"),
    ]
    return frame(spark, rows)


# Ranked search


def ranked(docs, items, k=10):
    """``(item, rank, doc, score)`` by scoring all documents for all items."""
    tf = [(d, Counter(brute.marked_words(t))) for d, t in docs if t is not None]
    tf = [(d, c, c.total()) for d, c in tf if c]
    n, total = len(tf), sum(s for _, _, s in tf)
    df = Counter(term for _, c, _ in tf for term in c)
    out = []
    for item, text in sorted(set(items), key=str):
        if text is None:
            continue
        found = []
        for doc, own, size in tf:
            m = 25 + 75 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 8 * m))
                for t in brute.marked_words(text) if t in own
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out.extend((item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(found)[:k], 1))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_search_equals_scoring_all(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    items = queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()
    want = ranked([tuple(r) for r in docs], [tuple(r) for r in items])
    assert got(queries.op12_ranked_search(spark, sf_dir)) == want


@pytest.mark.parametrize("k, short, block_terms", [(3, 1 / 8, 1 << 20), (1, 0.0, 100), (50, 1.0, 1 << 20)])
def test_search_at_any_setting(spark, monkeypatch, k, short, block_terms):
    """Few documents in a block and a part, so that blocks are skipped; frequent and rare terms."""
    monkeypatch.setattr(ranking, "SHORT", short)
    rng = random.Random(5)
    words = [f"t{int(1 / (0.001 + rng.random()))}" for _ in range(400)]
    docs = [(rng.randint(0, 900), " ".join(rng.choices(words, k=rng.randint(0, 60)))) for _ in range(700)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(25)]
    df = ranking.rank(frame(spark, docs), frame(spark, items, "item_id long, text string"), k, block_terms)
    want = ranked(docs, items, k)
    assert [r[:2] + r[3:] for r in got(df)] == [r[:2] + r[3:] for r in want]
    assert got(df) == want


def test_part_search_skips_nothing_that_counts():
    rng = np.random.default_rng(1)
    documents, terms = 5_000, 40
    held = rng.random((terms, documents)) < np.geomspace(0.9, 0.001, terms)[:, None]
    value = rng.integers(1, 1_000, (terms, documents)) * held
    codes, rows = np.nonzero(held)
    part = ranking._Part(codes, rows, value[codes, rows], documents, terms)
    for _ in range(30):
        asked = np.unique(rng.integers(0, terms, 12))
        times = rng.integers(1, 3, len(asked))
        scores = (value[asked] * times[:, None]).sum(axis=0)
        bar = int(np.sort(scores)[-10])
        seen = dict.fromkeys(np.flatnonzero(scores >= max(bar, 1)))
        found = part.search(asked, times, 1, 10)
        out, answer = {}, next(found)
        try:
            while True:
                out.update(zip(*(x.tolist() for x in answer)))
                top = sorted(out.values())[-10:]
                answer = found.send(top[0] if len(top) == 10 else 1)
        except StopIteration:
            pass
        assert all(out[d] == scores[d] for d in seen) and all(scores[d] == s for d, s in out.items())


def test_search_on_odd_rows(spark, odd):
    items = [(1, "Spelling words"), (1, "other"), (1, "other"), (2, None), (3, ""), (None, "the OF of"), (4, "absent")]
    asked = frame(spark, items, "item_id long, text string")
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    result = ranking.rank(odd, asked)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(result) == ranked(docs, items)
    assert ranking.rank(odd.where("false"), asked).count() == 0
    assert ranking.rank(odd, asked.where("false")).count() == 0
    assert ranking.rank(odd.where("text is null"), asked).count() == 0


# Sharding


def check_shards(rows, texts, shards, split=()):
    """Slots are gapless, sizes and checksums right, and equal texts together."""
    slots, where = defaultdict(list), defaultdict(set)
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts)
    facts = Counter()
    for d, t in texts:
        data = None if t is None else t.encode()
        facts[d, 16 + len(data or b""), None if data is None else zlib.crc32(data)] += 1
    assert facts == Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    for r in rows:
        slots[r.shard].append(r.slot)
        where[r.text_crc32, r.size].add(r.shard)
    assert set(slots) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for k, s in where.items() if k not in split)
    return slots, where


def test_shards(spark, sf_dir):
    texts = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    rows = queries.op11_sharding(spark, sf_dir).collect()
    groups, total = defaultdict(lambda: np.zeros(3)), np.zeros(3)
    for _, text in texts:
        data = (text or "").encode()
        own = np.array([16 + len(data), len(brute.words(text)), 1])
        groups[None if text is None else zlib.crc32(data), own[0]] += own
        total += own
    check_shards(rows, texts, 40, {k for k, own in groups.items() if (40 * own > total).any()})
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert sorted(map(tuple, queries.op11_sharding(spark, sf_dir).collect()), key=str) == sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("cells", [64, 1 << 14])
def test_shards_are_near_equal(spark, cells):
    """A third of the rows are one text, many have no words, and cells gather the rest."""
    rng = random.Random(2)
    texts = [(None if i % 9 == 0 else i, "the same text of all " * 20) for i in range(2_000)]
    texts += [(i, "x" * rng.randint(0, 900)) for i in range(2_000)]
    texts += [(i, " ".join("ab" for _ in range(rng.randint(1, 300)))) for i in range(2_000)]
    shards = 5
    rows = sharding.shard(frame(spark, texts), shards, cells).collect()
    heavy = (zlib.crc32(texts[0][1].encode()), 16 + len(texts[0][1]))
    slots, where = check_shards(rows, texts, shards, {heavy})
    assert len(where[heavy]) > 1
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    largest = max(r.size for r in rows) if cells > 1000 else sum(size.values()) / cells
    assert max(size.values()) - min(size.values()) <= largest + 0.01 * sum(size.values())


def test_packing_by_hand():
    # the item that needs rows goes where rows are left, not where bytes are
    vectors = np.array([[0.6, 0.6, 0.1], [0.1, 0.1, 0.6], [0.1, 0.1, 0.4], [0.3, 0.3, 0.1]])
    assert sharding.pack(vectors, 2).tolist() == [0, 1, 0, 1]
    assert sharding.pack(np.zeros((0, 3)), 2).tolist() == []
    assert set(sharding.pack(np.full((4, 3), 0.9), 2).tolist()) == {0, 1}


def test_shards_on_odd_rows(spark, odd):
    texts = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    result = sharding.shard(odd, 3)
    assert result.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot"]
    check_shards(result.collect(), texts, 3, {(zlib.crc32(b"x"), 17)})
    assert sharding.shard(odd.where("false"), 3).count() == 0
    assert {r.slot for r in sharding.shard(odd.where("text is null"), 1).collect()} == {0, 1}


# Spelling


def spelled(docs, pairs=True):
    """The words of texts by a plain count, and near words by comparing all pairs."""
    import re

    n = Counter()
    for doc, text in docs:
        lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            n[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = defaultdict(set)
    if pairs:
        shorter, holes = defaultdict(set), defaultdict(set)
        for w in n:
            for i in range(len(w)):
                shorter[w[:i] + w[i + 1 :]].add(w)
                holes[i, w[:i] + w[i + 1 :]].add(w)
        for w in n:
            for other in shorter.get(w, ()):
                near[w].add(other)
                near[other].add(w)
        for group in holes.values():
            for w in group:
                near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def test_spelling_equals_plain_count(spark, sf_dir):
    docs = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert got(queries.op13_spelling(spark, sf_dir)) == spelled(docs)


@pytest.mark.parametrize("max_blocks", [1, 1 << 22])
def test_neighbours_at_any_density(spark, max_blocks):
    """Full filters let everything through, and the join removes it."""
    rng = random.Random(4)
    words = {"".join(rng.choice("abé÷") for _ in range(rng.randint(5, 7))) for _ in range(600)}
    words |= {"a" * 300, "a" * 299, "a" * 298 + "b", "a" * 301}
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    pairs = [(r.word, r.near) for r in spelling.near_pairs(df, max_blocks=max_blocks).collect()]

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        a, b = sorted((a, b), key=len)
        i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]

    want = {(a, b) for a in words for b in words if near(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_chains_of_forms(spark):
    """Counts that double along a chain: the root is its end."""
    chain = ["abcde" + "fghijklm"[:i] for i in range(7)]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2**i))
    rows = {r.word: r for r in spelling.variants(frame(spark, [(1, text)])).collect()}
    docs = [(1, text)]
    assert sorted((tuple(r) for r in rows.values()), key=str) == spelled(docs)
    assert rows[chain[0]].root == chain[-1] and rows[chain[0]].form == chain[1]


def test_spelling_on_odd_rows(spark, odd):
    rows = odd.union(odd).union(odd)
    docs = [tuple(r) for r in rows.select("doc_id", "text").collect()]
    result = spelling.variants(rows)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got(result) == spelled(docs)
    assert spelling.variants(odd.where("false")).count() == 0
    assert spelling.variants(odd.where("text is null")).count() == 0
