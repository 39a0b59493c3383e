"""Every operator against plain Python or SQL on the given tables."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import brute
import numpy as np
import pytest
from oracle import difference, duck
from pyspark.sql import functions as F

from tidelog.llm import chunk_dedup, class_lm, decontaminate, language, near_dup, queries, search
from tidelog.llm import words as W
from tidelog.llm.common import table


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf_dir, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), duck(sf_dir), queries.ORACLES[name]) is None


def test_lines(spark, sf_dir, docs):
    assert sorted(map(tuple, queries.op1_line_dedup(spark, sf_dir).collect())) == brute.lines(docs)


def test_near_duplicates(spark, sf_dir, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op2_near_dup(spark, sf_dir).collect()}
    assert got == brute.components(docs, 3, 85)


def test_families_without_a_common_original(spark):
    """Copies that all differ from each other, a chain, and a passage that everyone has."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base, shared = [word() for _ in range(150)], [word() for _ in range(60)]
    rows, chain = [], list(base)
    for i in range(60):
        own = list(base)
        for _ in range(rng.randint(1, 5)):
            own[rng.randrange(150)] = word()
        rows.append((i, " ".join(own)))
    for i in range(60, 90):
        chain = list(chain)
        for _ in range(4):
            chain[rng.randrange(150)] = word()
        rows.append((i, " ".join(chain)))
    for i in range(90, 150):
        rows.append((i, " ".join(shared + [word() for _ in range(rng.randint(20, 90))])))
    rng.shuffle(rows)
    for k, percent in ((3, 85), (5, 80)):
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, percent)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.components(rows, k, percent)


def test_languages(spark, sf_dir):
    langs = {r.doc_id: r.lang for r in table(spark, sf_dir, "documents").select("doc_id", "lang").collect()}
    rows = queries.op3_language_id(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(langs)
    assert all(r.held_out == (brute.remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_masks_name_every_language_of_a_gram(spark):
    rows = [("aaaa bbbb " * 20, "x"), ("bbbb cccc " * 20, "y")]
    filters = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    mask = lambda t: int(filters.masks(next(language.grams(t)))[1])
    assert filters.languages == ["x", "y"] and (mask("aaaa"), mask("bbbb"), mask("cccc")) == (1, 3, 2)


def test_mix_comes_near_its_targets(spark, sf_dir):
    by = defaultdict(list)
    for r in queries.op4_mixing(spark, sf_dir).collect():
        by[r.source].append(r)
        assert r.taken in {r.size * i for i in range(4)}
    total = sum(r.size for rows in by.values() for r in rows)
    assert math.isclose(sum(rows[0].target for rows in by.values()), total)
    for rows in by.values():
        assert sum(r.size for r in rows) == rows[0].source_size
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows)


def test_passages_of_the_benchmark(spark, sf_dir, docs):
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in queries.op5_decontamination(spark, sf_dir).collect()}
    texts = [(d, brute.marked_words(t)) for d, t in docs]
    grams = [(d, {tuple(t[i : i + 4]) for i in range(len(t) - 3)}) for d, t in texts]
    wanted = {}
    for item, text in items:
        pattern = brute.marked_words(text)
        pieces = {tuple(pattern[i : i + 4]) for i in range(len(pattern) - 3)}
        for (d, t), (_, own) in zip(texts, grams):
            if pieces & own:  # a piece has five words or more
                distance = brute.nearest(pattern, t)
                if distance <= len(pattern) // 8:
                    wanted[d, item] = distance
    assert got == wanted and wanted


def test_edits_are_counted(spark):
    rng = random.Random(5)
    for _ in range(300):
        pattern = [rng.randrange(4) for _ in range(rng.randint(1, 90))]
        text = [rng.randrange(4) for _ in range(rng.randint(0, 120))]
        assert decontaminate.closest(pattern, text)[0] == brute.nearest(pattern, text)
    item = " ".join(f"w{i}" for i in range(32))
    near = item.replace("w3 ", "").replace("w17 ", "W17, x ").replace("w30", "y")
    far = " ".join(f"w{i}" if i % 4 else "z" for i in range(32))
    docs = spark.createDataFrame([(1, "a b. " + near + " c"), (2, far), (3, item.upper())], "doc_id long, text string")
    items = spark.createDataFrame([(9, item), (8, ""), (7, None), (6, "Xyz!")], "item_id long, text string")
    found = decontaminate.find_items(docs, items).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in found} == {(1, 9, 3), (3, 9, 0)}
    assert {(r.start, r.end) for r in found if r.doc_id == 3} == {(0, len(item))}
    assert [r.doc_id for r in decontaminate.decontaminate(docs, items).collect()] == [2]


def test_benchmarks_larger_than_a_block(spark, sf_dir, monkeypatch):
    whole = queries.op5_decontamination(spark, sf_dir).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)
    assert sorted(queries.op5_decontamination(spark, sf_dir).collect()) == sorted(whole)


@pytest.mark.parametrize("head", [class_lm.HEAD, 50])
def test_language_model(spark, sf_dir, docs, monkeypatch, head):
    monkeypatch.setattr(class_lm, "HEAD", head)
    seen = brute.counts(docs)
    n, v = sum(seen.values()), len(seen)
    texts = dict(docs)
    rows = queries.op6_class_lm(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        tokens = [*brute.words(texts[r.doc_id]), None]
        known = sum(seen[t] > 0 for t in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), known, n)
        assert r.held_out == (brute.remainder(r.doc_id, 7) == 2)
        assert math.isclose(r.base_score, sum(math.log10((seen[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def tables(texts):
    """A model, class and count of every training word by its hash, and its context where not the tail."""
    counts = class_lm.word_counts(texts)
    model, tail = class_lm.learn(texts, counts)
    head = model.head.words.tolist()
    known = {w: (c, n) for w, c, n in zip(head, model.own.tolist(), model.head.n.tolist())}
    if tail is not None:
        known.update({r.word % 2**64: (r["class"], r.n) for r in tail.collect()})
    assert len(known) == counts.count()
    return model, known, dict(zip(head, model.symbol.tolist()))


def word_hash(word: bytes) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(W.span_hashes(data, np.array([0]), np.array([len(data)]))[0])


@pytest.mark.parametrize("head", [class_lm.HEAD, 50, 0])
def test_word_probabilities_sum_to_one(spark, docs, monkeypatch, head):
    monkeypatch.setattr(class_lm, "HEAD", head)
    model, known, _ = tables(spark.createDataFrame(docs[:60], "doc_id long, text string"))
    assert np.allclose((10**model.transition).sum(1), 1)
    share = defaultdict(float)
    for c, n in known.values():
        share[c] += n / model.size[c]
    assert all(0 <= c < class_lm.CLASSES for c in share) and all(math.isclose(x, 1) for x in share.values())


@pytest.mark.parametrize("core, head", [(class_lm.CORE, class_lm.HEAD), (100, 300)])
def test_score_is_the_sum_over_tokens(spark, docs, monkeypatch, core, head):
    """100 documents scored token by token with the model's tables."""
    monkeypatch.setattr(class_lm, "HEAD", head)
    monkeypatch.setattr(class_lm, "CORE", core)
    some = docs[:100]
    frame = spark.createDataFrame(some, "doc_id long, text string")
    train = F.col("doc_id") % 3 != 0
    model, known, heads = tables(frame.where(train))
    got = {r.doc_id: r.score for r in class_lm.score_texts(frame, train).collect()}
    for doc_id, text in some:
        context, total = class_lm.END, 0.0
        for word in brute.words(text):
            h = word_hash(word)
            c, n = known.get(h, (None, 0))
            if c is None:
                total += model.transition[context, class_lm.CLASSES + min(len(word), class_lm.KINDS)]
            else:
                total += model.transition[context, c] + math.log10(n / model.size[c])
            context = heads.get(h, class_lm.TAIL)
        total += model.transition[context, class_lm.CLASSES]
        assert math.isclose(got[doc_id], total, rel_tol=1e-9)


def test_words_of_one_use_share_a_class(spark):
    """Animals and colours: each follows its own words, and tail words join them."""
    rng = random.Random(5)
    animals, colours = [f"animal{i}" for i in range(20)], [f"colour{i}" for i in range(20)]
    rows = []
    for i in range(1_500):
        words = []
        for _ in range(8):
            words += rng.choice([["the", rng.choice(animals), "runs"], ["painted", rng.choice(colours), "walls"]])
        rows.append((i, " ".join(words)))
    rows.append((9_999, "the animalrare runs painted colourrare walls"))
    model, known, _ = tables(spark.createDataFrame(rows, "doc_id long, text string"))
    of = lambda word: known[word_hash(word.encode())][0]
    seen = {of(w) for w in animals}, {of(w) for w in colours}
    assert not seen[0] & seen[1] and of("animalrare") not in seen[1] and of("colourrare") not in seen[0]


def test_exchange_never_loses_likelihood():
    rng = np.random.default_rng(1)
    counts = rng.poisson(rng.random((40, 40)) * 5).astype(float)

    def likelihood(own):
        member = np.eye(own.max() + 1)[own]
        pairs = member.T @ counts @ member
        f = class_lm._xlogx
        return f(pairs).sum() - f(pairs.sum(0)).sum() - f(pairs.sum(1)).sum()

    start = np.concatenate([np.arange(36) % 6, np.arange(6, 10)])
    runs = [likelihood(class_lm.exchange(counts, 36, 6, sweeps)) for sweeps in range(1, 6)]
    assert likelihood(start) < runs[0] and all(a <= b + 1e-6 for a, b in zip(runs, runs[1:]))


def test_repeated_passages(spark, sf_dir, docs):
    """What is reported occurred before, byte for byte; long copies are found."""
    texts = {d: (t or "").encode() for d, t in docs}
    found = queries.op7_chunk_dedup(spark, sf_dir).collect()
    for r in found:
        piece = texts[r.doc_id][r.start : r.end]
        assert r.n_words == len(piece.split()) >= 20 and min(r.first_ids) <= r.doc_id
        if len(r.first_ids) == 1 and r.first_ids[0] != r.doc_id:
            assert piece[:60] in texts[r.first_ids[0]]
    covered = {r.doc_id for r in found}
    first = {}
    for d in sorted(texts):
        if len(texts[d].split()) > 60 and first.setdefault(texts[d], d) != d:
            assert d in covered


def test_chunks_resist_insertions(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    rows, wanted = [], []
    for i in range(200):
        passage = " ".join(word() for _ in range(70))
        rows.append((2 * i, " ".join([word() for _ in range(rng.randint(0, 30))] + [passage, word()])))
        rows.append((2 * i + 1, " ".join([word() for _ in range(rng.randint(5, 30))] + [passage])))
        wanted.append(2 * i + 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = chunk_dedup.passages(docs).collect()
    assert sorted(r.doc_id for r in got) == wanted
    assert all(r.first_ids == [r.doc_id - 1] for r in got)
    left = {r.doc_id: r.text for r in chunk_dedup.delete_repeated_passages(docs).collect()}
    assert all(left[d] == t for d, t in rows if d % 2 == 0)
    assert all(len(left[d].split()) < len(t.split()) - 30 for d, t in rows if d % 2)


def test_toxicity(spark, sf_dir):
    labels = {r.doc_id: r.toxic for r in table(spark, sf_dir, "labels").collect()}
    rows = queries.op8_toxicity(spark, sf_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    toxic = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    clean = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    assert not toxic or not clean or np.mean(toxic) > np.mean(clean)


def test_machine_learns_an_exclusive_pair(spark):
    """The label is exactly one of two words: neither follows it alone, only the pair does."""
    from tidelog.llm import toxicity

    rng = random.Random(4)
    rows = []
    for _ in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        text = [f"f{rng.randrange(200)}" for _ in range(10)] + ["dolt"] * a + ["tribe"] * b
        rows.append((" ".join(text), int(a != b)))
    machine = toxicity.learn(spark.createDataFrame(rows, "text string, label int"))
    cases = [(0, "dolt f1 f2 f3"), (1, "tribe f9 f4"), (2, "dolt tribe f7"), (3, "f5 f6 f7")]
    got = {r.doc_id: r.toxicity for r in toxicity.score(spark.createDataFrame(cases, "doc_id long, text string"), machine).collect()}
    assert got[0] > 0.9 and got[1] > 0.9 and got[2] < 0.1 and got[3] < 0.4


def test_labels_are_sampled_apart(spark):
    from tidelog.llm import toxicity

    rows = [(f"w{i} " + ("insult" if i % 50 == 0 else "kind"), int(i % 50 == 0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "text string, label int")
    kept = toxicity._share_of_label(df, "text", 200).groupBy("label").count().collect()
    kept = {r.label: r["count"] for r in kept}
    assert kept[1] == 60 and 90 <= kept[0] <= 190
    machine = toxicity.learn(df, sample=200, pairs=500)
    got = toxicity.score(spark.createDataFrame([(0, "insult"), (1, "kind")], "doc_id long, text string"), machine).collect()
    assert got[0].toxicity > 0.5 > got[1].toxicity


def test_machine_learns_that_both_words_are_needed(spark):
    from tidelog.llm import toxicity

    rng = random.Random(4)
    rows = []
    for _ in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        text = [f"f{rng.randrange(200)}" for _ in range(10)] + ["dolt"] * insult + ["tribe"] * group
        rows.append((" ".join(text), int(insult and group)))
    machine = toxicity.learn(spark.createDataFrame(rows, "text string, label int"))
    cases = [(0, "dolt tribe"), (1, "dolt"), (2, "tribe"), (3, ""), (4, None)]
    got = toxicity.score(spark.createDataFrame(cases, "doc_id long, text string"), machine).collect()
    assert [r.toxicity >= 0.5 for r in got] == [True, False, False, False, False]
    assert sorted((r.toxicity >= 0.5 for r in got), reverse=True) and got[0].toxicity > 0.9


def test_search_of_sparse_and_odd_vectors(spark, monkeypatch):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        v = [rng.choice([0.0, 0.0, 1.0, -0.5, rng.random()]) for _ in range(rng.choice([8, 8, 8, 5]))]
        rows.append((i, v))
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (500, [float("inf")] * 8), (3, rows[3][1])]
    rows += [(None, [1.0] * 8), (403, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows[:400] + [rows[404], rows[406]]]
    wanted = set()
    for q, v in {i: v for i, v in whole if i % 50 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)
        wanted.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10]))
    for block in (1024, 3):
        got = search.top_k(vectors, F.col("vec_id") % 50 == 0, block=block).collect()
        assert sorted(map(tuple, got)) == sorted(wanted)


def test_urls(spark, sf_dir):
    rows = queries.op10_url_filter(spark, sf_dir).collect()
    urls = {r.page_id: r.url for r in table(spark, sf_dir, "pages").select("page_id", "url").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        rest = urls[r.page_id].split("://", 1)[1]
        host = min((rest.split(c, 1)[0] for c in "/?#"), key=len)
        path = min((rest[len(host) :].split(c, 1)[0] for c in "?#"), key=len)
        fits = [
            x for x in queries.RULES if ("." + host.lower()).endswith("." + x.host) and path.startswith(x.path)
        ]
        best = max(fits, key=lambda x: len(x.name), default=None)
        assert (r.host, r.path, r.rule) == (host.lower(), path, best and best.name)
        assert r.verdict == best.verdict if best else r.verdict in ("allow", "block")


def test_urls_are_judged_by_how_they_look(spark, sf_dir):
    """Blocked URLs are long and full of digits, on hosts and endings of all kinds; no suffix tells."""
    from tidelog.llm import url_filter

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def url(bad, host):
        path = f"/{word()}/" + (digits(rng.randint(20, 40)) if bad else word()) + rng.choice([".html", "", ".php"])
        return f"http://{word()}.{word()}.{host}{path}" + (f"?a={digits(9)}&b=1&c=2" if bad and rng.random() < 0.5 else "")

    rows, truth = [], {}
    for i in range(3_000):
        told, bad = rng.random() < 0.6, rng.random() < 0.4
        host = ("bad.test" if bad else "good.test") if told else "unknown.test"
        rows.append((i, url(bad, host)))
        if not told:
            truth[i] = bad
    rules = [url_filter.Rule("bad.test", "/", "block"), url_filter.Rule("good.test", "/", "allow")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, rules).collect()}
    right = [(got[i].verdict == "block") == bad for i, bad in truth.items()]
    assert np.mean(right) > 0.95 and all(got[i].rule is None for i in truth)


def test_shares_tell_nothing_that_a_rule_tested(spark, sf_dir):
    """The given pages: many scores, not the handful that copied rules would give."""
    rows = queries.op10_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert len({r.score for r in rows if r.rule is None}) > 30


def test_urls_that_repeat_or_are_long(spark):
    from tidelog.llm import url_filter

    long = "http://a.example.com/" + "x1" * 300_000
    rows = [(1, long), (2, long), (2, None), (None, "http://b.net/es/q"), (3, "no host"), (4, "http://c.net/es/1"), (5, "http://c.org/z")]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), queries.RULES).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.rule): r for r in got}
    assert by[1, "com/"].verdict == by[2, "com/"].verdict == "allow" and by[4, "net/es/"].verdict == "block"
    assert by[5, None].verdict in ("allow", "block") and by[2, None].host == "" == by[3, None].path


def test_long_texts_are_hashed_in_segments(monkeypatch):
    import pyarrow as pa

    text = pa.array(["ab  cd " * 3000, None, "", "x" * 9000, "ab"])
    whole = [W.span_hashes(p.data, w.start, w.end) for p in W.slices(text) for w in [W.find_words(p)]]
    monkeypatch.setattr(W, "SLICE", 1000)
    parts = [W.span_hashes(p.data, w.start, w.end) for p in W.slices(text) for w in [W.find_words(p)]]
    assert len(parts) > len(whole) and np.array_equal(np.concatenate(whole), np.concatenate(parts))
    assert whole[0][0] == whole[0][-1]


def test_toxicity_learns_in_bounded_driver_memory(spark, monkeypatch):
    """The driver holds a few dozen bytes a term of the sample beside its buckets, and the order of rows is nothing to it."""
    import tracemalloc

    from tidelog.llm import toxicity

    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    monkeypatch.setattr(toxicity, "BATCH", 400)
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{i}" for i in rng.choice(3_000, 700, replace=False)) for _ in range(800)]
    rows = [(f"{'insult' if i % 2 else 'kind'} {text}", i % 2) for i, text in enumerate(texts)]
    machines, peaks = [], []
    for given in (rows, rows[::-1]):
        df = spark.createDataFrame(given, "text string, label int")
        tracemalloc.start()
        try:
            machines.append(toxicity.learn(df))
            peaks.append(tracemalloc.get_traced_memory()[1])
        finally:
            tracemalloc.stop()
    terms = sum(len(text.split()) for text, _ in rows)
    assert max(peaks) < 30 * terms + 100 * (1 << 18)
    one, other = machines
    assert one.bias == other.bias and np.array_equal(one.weight, other.weight) and np.array_equal(one.factor, other.factor)


def test_language_counts_in_bounded_memory():
    """N-grams are counted as they come, however many texts a batch holds."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(2)
    texts = [" ".join(rng.choice(["river", "stone", "winter", "apple"]) for _ in range(300)) for _ in range(2_500)]
    langs = ["en" if i % 3 else "de" for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(langs)], names=["text", "lang"])
    next(language.grams("warm"))
    tracemalloc.start()
    try:
        got = [r for out in language._counted([batch]) for r in out.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    want = defaultdict(int)
    for text, lang in zip(texts, langs):
        for part in language.grams(text):
            for gram in part.view(np.int64).tolist():
                want[lang, gram] += 1
    assert {(r["lang"], r["gram"]): r["n"] for r in got} == want
    assert sum(want.values()) > 4 * language.SEGMENT and peak < 64 * language.SEGMENT
