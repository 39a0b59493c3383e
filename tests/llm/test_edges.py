"""NULLs, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import random

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.llm import (
    chunk_dedup,
    class_lm,
    decontaminate,
    language,
    line_dedup,
    mixing,
    near_dup,
    queries,
    search,
    toxicity,
    url_filter,
)
from tidelog.llm import words as W
from tidelog.llm.common import remainder

LINES = "one line of text here\nanother line of some text\na third line of the text"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
ROWS = [
    (0, LINES, "en", "a", 1),
    (0, LINES, "en", "a", 1),
    (1, None, None, None, None),
    (2, "", "en", "", 0),
    (3, " \n\t ", None, "b", 3),
    (4, LONG, "en", "b", 9),
    (5, "\n" + LINES + "\nand more", "fr", None, 2),
    (None, LINES, "fr", "a", 5),
    (6, "123 !!", "en", "a", 6),
    (7, "é", "fr", "c", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("version", "lines", "score", "copies", "n_deleted", "toxicity", "lang_pred", "place", "value", "a", "b", "key", "n")


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where(F.lit(False))


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, LINES), (2, None), (3, "")], "item_id long, text string")


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_lines(docs, none):
    rows = line_dedup.delete_repeated_lines(docs).collect()
    got = by_id(rows)
    assert len(rows) == len(ROWS) and set(rows[0].asDict()) == {*docs.columns, "n_deleted"}
    # a NULL id orders first and keeps the lines; rows that repeat a document go alike
    assert got[None].text == LINES and got[5].text == "\nand more" and got[5].n_deleted == 3
    assert [r.text for r in rows if r.doc_id == 0] == ["", ""]
    assert (got[1].text, got[2].text, got[3].text, got[4].text) == (None, "", " \n\t ", LONG)
    assert line_dedup.delete_repeated_lines(none).count() == 0


def test_lines_of_short_texts_and_long_lines(spark):
    """Runs of fewer than three lines repeat by their words, whole texts by being whole."""
    long = "a line that holds as many as eight words"
    rows = [
        (0, f"top\n{long}\nend"),
        (1, f"{long}\nmore"),
        (2, long),
        (3, "two short\nlines here"),
        (4, " two short \n\nlines here\n"),
        (5, "two short"),
        (6, "two short"),
        (7, f"x1\ntwo short\nx2\n{long}\ntwo short\nx3"),
        (8, "five words are in this\nand three here\na"),
        (9, "b\nfive words are in this\nand three here"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_deleted) for r in line_dedup.delete_repeated_lines(docs).collect()}
    assert got == {
        0: (rows[0][1], 0), 1: ("more", 1), 2: ("", 1), 3: (rows[3][1], 0), 4: ("", 2), 5: ("two short", 0),
        6: ("", 1), 7: ("x1\ntwo short\nx2\ntwo short\nx3", 1), 8: (rows[8][1], 0), 9: ("b", 2),
    }
    left = corpus_pipeline.lines(spark, docs, "")
    assert sorted(r.doc_id for r in left.collect()) == [0, 1, 3, 5, 7, 8, 9]
    three = {r.doc_id: r.n_deleted for r in line_dedup.delete_repeated_lines(docs, words=None).collect()}
    assert not any(three.values())


def test_near_duplicates(docs, none):
    rows = near_dup.near_duplicates(docs, 3, 85).collect()
    got = by_id(rows)
    assert len(rows) == len(ROWS)
    assert (got[0].component_id, got[5].component_id, got[5].n_shingles) == (0, 0, 16)
    assert [got[i].n_shingles for i in (1, 2, 3, 6, 7)] == [0, 0, 0, 1, 1]
    assert all(r.kept == (r.doc_id != 5) for r in rows) and got[None].component_id is None
    assert near_dup.near_duplicates(none).count() == 0


def test_language(docs, none):
    filters = language.learn(docs)
    rows = language.identify(docs, filters).collect()
    got = by_id(rows)
    assert len(rows) == len(ROWS) and {got[i].lang_pred for i in (1, 2, 3, 6)} == {"und"}
    assert got[4].lang_pred == "en" and got[7].lang_pred in ("en", "fr")
    blank = language.learn(none)
    assert {r.lang_pred for r in language.identify(docs, blank).collect()} == {"und"}
    assert language.identify(none, filters).count() == 0


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in rows)
    assert by_id(rows)[1].size == 0 and by_id(rows)[4].size == 120_000
    assert len({r.copies for r in rows if r.doc_id == 0}) == 1
    # sources by code point, NULL last: "", a, b, c, NULL weigh 5, 2, 1, 5, 2
    targets = {r.source: r.target for r in rows}
    assert targets[""] == 0 and targets["c"] == 3 and targets["a"] == 3 * 50 and targets[None] == 3 * 18
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert set(mixing.mixed_documents(docs).columns) == set(docs.columns)


def test_decontamination(docs, none, items):
    found = decontaminate.find_items(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found if r.doc_id is not None) == [(0, 1), (0, 1), (5, 1)]
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns and left.count() == len(ROWS) - 4
    assert decontaminate.decontaminate(docs, items.where(F.lit(False))).count() == len(ROWS)
    assert decontaminate.find_items(none, items).count() == 0


@pytest.mark.parametrize("block", [5_000, 1])
def test_decontamination_by_items_that_share_an_id(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
    one, two, three = (" ".join(f"{c}{i}" for i in range(16)) for c in "abc")
    rows = [(1, one), (2, "x " + two), (2, "x " + two), (3, three), (4, f"{two.replace('b7', 'z')} {one}"), (5, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for id_ in (7, None):
        items = spark.createDataFrame([(id_, x) for x in (one, two, three, one)], "item_id long, text string")
        found = sorted(map(tuple, decontaminate.find_items(docs, items).collect()))
        ends = {1: (0, 0, len(one)), 2: (0, 2, 2 + len(two)), 3: (0, 0, len(three))}
        ends[4] = (0, len(rows[4][1]) - len(one), len(rows[4][1]))
        assert found == [(d, id_, *ends[d]) for d in (1, 2, 2, 3, 4)]
        assert [r.doc_id for r in decontaminate.decontaminate(docs, items).collect()] == [5]


def test_language_model(docs, none):
    rows = class_lm.score_texts(docs, ~(remainder(7) == 2)).collect()
    got = by_id(rows)
    assert len(rows) == len(ROWS) and [got[i].n_tokens for i in (1, 2, 3, 4)] == [1, 1, 1, 120_001]
    assert all(r.score <= 0 and r.base_score <= 0 for r in rows)
    untaught = class_lm.score_texts(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in untaught)
    assert class_lm.score_texts(none, F.lit(True)).count() == 0


def test_passages(docs, none):
    long = F.concat_ws(" ", F.lit(LONG[:3000]), F.col("doc_id").cast("string"))
    copies = docs.withColumn("text", F.when(F.col("doc_id") != 4, long).otherwise(F.col("text")))
    rows = chunk_dedup.passages(copies).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 4, 5, 6, 7}
    assert all(0 in r.first_ids for r in rows if r.doc_id not in (4,))
    left = chunk_dedup.delete_repeated_passages(copies)
    assert left.columns == docs.columns and left.count() == len(ROWS)
    assert by_id(chunk_dedup.delete_repeated_passages(docs).collect())[1].text is None
    assert chunk_dedup.passages(none).count() == 0


def test_passages_of_repetitive_text(spark):
    """Copies are found where the gear hash takes few values, or where blanks are rare."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    around = lambda: " ".join(word(5) for _ in range(30))
    kinds = [" ".join([word(rng.randint(1, 9))] * 100) for _ in range(30)]
    kinds += [" ".join(([word(6), word(3), word(4)] * 34)[:100]) for _ in range(30)]
    kinds += [word(1000) for _ in range(10)] + [word(1) * 1000 for _ in range(3)]
    rows = [(2 * i + k, f"{around()} {x} {around()}") for i, x in enumerate(kinds) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    both = chunk_dedup.spans(docs).groupBy((F.col("doc_id") / 2).cast("long").alias("pair"), "digest")
    both = both.agg(F.countDistinct("doc_id").alias("n")).where("n = 2")
    assert sorted(r.pair for r in both.select("pair").distinct().collect()) == list(range(len(kinds)))
    # rows do not see each other
    (part,) = W.slices(pa.array([t for _, t in rows] + ["", "x"]))
    ends = set(chunk_dedup.boundaries(part.data, part.offsets).tolist())
    alone = set()
    for base, (_, text) in zip(part.offsets.tolist(), [*rows, (None, "x")]):
        (own,) = W.slices(pa.array([text]))
        alone |= {base + x for x in chunk_dedup.boundaries(own.data, own.offsets).tolist()}
    assert ends == alone | {int(part.offsets[-1])}


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame(
        [(0, 1, 1), (0, 1, 0), (4, 0, 0), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"
    )
    machine = toxicity.learn(toxicity.labelled(docs, labels))
    assert toxicity.score(docs, machine).count() == len(ROWS)
    blank = toxicity.learn(toxicity.labelled(docs, labels.where(F.lit(False))))
    assert {r.toxicity for r in toxicity.score(docs, blank).collect()} == {0.5}
    assert toxicity.score(none, machine).count() == 0


def test_search(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = search.top_k(vectors, F.col("vec_id") == 0, k=10).collect()
    assert [(r.rank, r.vec_id) for r in got] == [(1, 1), (2, 2)]
    assert search.top_k(vectors.where(F.lit(False)), F.col("vec_id") == 0).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.COM", "x://b.com?q#f", "s://WWW.Example.com/en/1", "s://m.example.com/en/1", "s://c.org/a?b=1&c=2", "s://n.net/fr/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    got = {r.page_id: r for r in url_filter.judge_urls(pages, queries.RULES).collect()}
    assert len(got) == len(urls) and all(r.verdict in ("allow", "block") for r in got.values())
    assert [(got[i].host, got[i].path, got[i].rule) for i in (0, 2, 4, 5)] == [
        ("", "", None), ("", "", None), ("a.com", "", None), ("b.com", "", None),
    ]
    assert [got[i].rule for i in (6, 7, 9)] == ["www.example.com/en/", "example.com/en/", "net/fr/"]
    assert url_filter.judge_urls(pages.where(F.lit(False)), queries.RULES).count() == 0


def test_pipeline_stages(spark, docs, none, items, tmp_path):
    folder = f"file://{tmp_path}"
    items.write.parquet(f"{folder}/benchmark.parquet")
    for frame in (docs, none):
        rows = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, folder)
            assert out.columns[: len(docs.columns)] == docs.columns or name == "mixing"
            assert set(docs.columns) <= set(out.columns)
            rows = corpus_pipeline.stored(out, name)
    near = corpus_pipeline.near_duplicates(spark, docs, folder).collect()
    assert sorted(r.doc_id for r in near if r.doc_id is not None) == [0, 1, 2, 3, 4, 6, 7]


def test_language_of_copies_few_texts_and_many_languages(spark):
    """2,000 copies of one text, one text of its own, and 70 languages at once."""
    import random

    rng = random.Random(3)

    def text(alphabet, n=40):
        return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(3, 7))) for _ in range(n))

    copies = text("abcd")
    rows = [(copies, "aa")] * 2_000 + [(text("efgh"), "bb")]
    rows += [(text("ijkl"), "cc") for _ in range(400)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for sample in (100, 4_000):
        filters = language.learn(docs, sample=sample)
        assert filters.languages == ["aa", "bb", "cc"]
        asked = spark.createDataFrame([(copies,), (rows[2_000][0],), (text("ijkl"),)], "text string")
        found = {r.text: r for r in language.identify(asked, filters).collect()}
        assert found[copies].lang_pred == "aa" and found[rows[2_000][0]].lang_pred == "bb"
        assert sorted(r.lang_pred for r in found.values()) == ["aa", "bb", "cc"]
        assert all(r.lang_score > 0.3 for r in found.values())
    many = [(text([chr(0x4E00 + 20 * i + j) for j in range(8)]), f"l{i:02d}") for i in range(70) for _ in range(3)]
    filters = language.learn(spark.createDataFrame(many, "text string, lang string"))
    assert len(filters.languages) == 70 and len(filters.slots) == 2
    asked = spark.createDataFrame(many, "text string, lang string")
    assert all(r.lang_pred == r.lang for r in language.identify(asked, filters).collect())
    assert len(language.learn(asked, most=5).languages) == 5


def test_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([("same words here", "xx"), ("same words here", "ab")], "text string, lang string")
    found = language.identify(docs, language.learn(docs)).collect()
    assert {r.lang_pred for r in found} == {"ab"}


def test_passages_of_rows_without_an_id(spark):
    """12,000 different texts under no id, and under one, hold a passage that an earlier row has."""
    passage = " ".join(f"shared{i}" for i in range(60))
    for doc_id in (None, 7):
        rows = [(doc_id, f"row {i} begins so {i * 7919} {passage} and ends {i}") for i in range(12_000)]
        found = chunk_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string"))
        assert found.count() == 11_999 and found.where("n_words < 40").count() == 0
        left = chunk_dedup.delete_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
        assert left.where(F.length("text") > 300).count() == 1


def test_frequent_passages_are_dealt_out(spark, monkeypatch):
    """Which digests count as frequent changes where rows go, not what is found."""
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, f"{i * 7919} begins {passage} ends {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = sorted(map(str, chunk_dedup.passages(docs).collect()))
    monkeypatch.setattr(chunk_dedup, "HOT", 7)
    assert sorted(map(str, chunk_dedup.passages(docs).collect())) == plain and len(plain) == 299


def test_pipeline_keeps_texts_that_share_an_id(spark, folder):
    """Different texts under one id stay; equal texts without ids leave one; reruns agree."""
    text = " ".join(f"word{i}" for i in range(50))
    other = " ".join(f"other{i}" for i in range(50))
    third = " ".join(f"third{i}" for i in range(50))
    rows = [(None, text, "a"), (None, text, "b"), (None, text + " more", "c"), (7, other, "d"), (7, third, "e"), (7, third, "f")]
    rows += [(8, other + " end", "g"), (9, None, "h"), (None, "", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [
        sorted(
            (tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(n), folder).collect()), key=str
        )
        for n in (1, 3)
    ]
    assert runs[0] == runs[1]
    got = runs[0]
    assert sum(r[1] is not None and r[1].startswith("word") for r in got) == 1
    assert {r[1] for r in got if r[0] == 7} == {other, third} and len([r for r in got if r[0] == 7]) == 2
    assert not [r for r in got if r[0] == 8] and (9, None, "h") in got and (None, "", "i") in got


def test_scores_of_large_components(spark):
    """Components that leave 64 bits when multiplied, and a result that does not fit."""
    rows = [(0, [3.0e6, 1.0]), (1, [2.0, 5.0e15]), (2, [1.0e18, 0.0]), (3, [-1.0e18, 2.0]), (4, [0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in search.top_k(vectors, F.col("vec_id") == 4).collect()}
    assert set(got.values()) == {0} and len(got) == 4
    fits = vectors.where("vec_id in (0, 1, 4)")
    with pytest.raises(Exception, match="does not fit 64 bits|Overflow"):
        search.top_k(vectors, F.col("vec_id") == 2).collect()
    got = {r.vec_id: r.score for r in search.top_k(fits, F.col("vec_id") == 0, scale=1).collect()}
    assert got == {1: 6_000_000 + 5_000_000_000_000_000, 4: 0}
