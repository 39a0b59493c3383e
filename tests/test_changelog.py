import random

import pytest
from folds import fold_changelog, fold_runs
from pyspark.sql import functions as F
from test_apply import CHANGES, UPSERTS, base, frame, random_upserts, row

from tidelog import schemas
from tidelog.functions import kinds
from tidelog.operators import changelog, sequence, skew

KEYS = ["id"]


def entries(df):
    got = df.select("seq", "sub", "row_kind", F.struct("id", "actor", "alias").alias("row"))
    return sorted(
        ((r.seq, r.sub, r.row_kind, r.row.asDict()) for r in got.collect()), key=lambda e: e[:2]
    )


@pytest.mark.parametrize("hot_rows,width", [(1_000_000, 1 << 20), (1, 7), (30, 16), (1, 1)])
@pytest.mark.parametrize("emit_unchanged", [True, False])
def test_upsert_changelog_equals_fold(spark, hot_rows, width, emit_unchanged):
    rows = random_upserts(4)
    got = changelog.upsert_changelog(
        frame(spark, rows, UPSERTS), KEYS, "row", "seq", emit_unchanged,
        hot_rows=hot_rows, width=width,
    )
    assert entries(got) == fold_changelog(rows, emit_unchanged=emit_unchanged)


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_upsert_changelog_against_a_table(spark, hot_rows):
    rows = random_upserts(6)
    table = {k: row(k, "base", None) for k in range(0, 20, 2)}
    got = changelog.upsert_changelog(
        frame(spark, rows, UPSERTS), KEYS, "row", "seq", table=base(spark, table),
        hot_rows=hot_rows, width=8,
    )
    assert entries(got) == fold_changelog(rows, table)


def test_upsert_changelog_starts_below_zero(spark):
    rows = [(seq - 150, *rest) for seq, *rest in random_upserts(9)]
    got = changelog.upsert_changelog(frame(spark, rows, UPSERTS), KEYS, "row", "seq", hot_rows=1, width=8)
    assert entries(got) == fold_changelog(rows)
    unplaced = frame(spark, [(None, 1, row(1, "a"))], UPSERTS)
    with pytest.raises(Exception, match="without its place"):
        changelog.upsert_changelog(unplaced, KEYS, "row", "seq").collect()


def test_changelog_kinds(spark):
    rows = [
        (1, "r", None, row(1, "a")),
        (2, "u", row(1, "a"), row(2, "b")),
        (3, "d", row(2, "b"), None),
        (4, "t", None, None),
    ]
    log = changelog.changelog(frame(spark, rows, CHANGES))
    assert entries(log) == [
        (1, 0, "+I", row(1, "a")),
        (2, 0, "-U", row(1, "a")),
        (2, 1, "+U", row(2, "b")),
        (3, 0, "-D", row(2, "b")),
    ]
    flags = changelog.retractions(log).orderBy("seq", "sub").select("is_add").collect()
    assert [f[0] for f in flags] == [True, False, True, False]


@pytest.mark.parametrize(
    "bad",
    [
        (1, "q", None, None),
        (1, "u", None, row(1)),
        (1, "d", None, row(1)),
        (1, "c", None, None),
    ],
)
def test_bad_change_fails(spark, bad):
    with pytest.raises(Exception, match="lacks its|unknown operation"):
        changelog.changelog(frame(spark, [bad], CHANGES)).collect()


def test_append_only_rejects_updates(spark):
    rows = [(1, "c", None, row(1)), (2, "u", row(1), row(1, "b"))]
    log = changelog.changelog(frame(spark, rows, CHANGES))
    with pytest.raises(Exception, match="append-only"):
        changelog.append_only(log).collect()
    assert changelog.append_only(log.where("seq = 1")).count() == 1


def test_upsert_records_keep_nulls_and_tombstones(spark):
    rows = [(1, "c", None, row(1)), (2, "d", row(1), None)]
    log = changelog.changelog(frame(spark, rows, CHANGES))
    got = changelog.upsert_records(log, KEYS, schemas.COLUMNS).orderBy("offset").collect()
    assert [tuple(r) for r in got] == [
        ('{"id":1}', '{"id":1,"actor":null,"alias":null}', 2),
        ('{"id":1}', None, 4),
    ]


def test_moved_rows_leave_a_tombstone(spark):
    rows = [(1, "c", None, row(1)), (2, "u", row(1), row(2)), (3, "u", row(2), row(2)), (4, "u", row(2), row(1))]
    log = changelog.changelog(frame(spark, rows, CHANGES), KEYS)
    got = changelog.upsert_records(log, KEYS, schemas.COLUMNS).orderBy("offset").collect()
    assert [(r.key, r.value is None, r.offset) for r in got] == [
        ('{"id":1}', False, 2),
        ('{"id":1}', True, 4),
        ('{"id":2}', False, 5),
        ('{"id":2}', False, 7),
        ('{"id":2}', True, 8),
        ('{"id":1}', False, 9),
    ]


def test_unknown_codes(spark):
    df = spark.createDataFrame([("c",), ("z",), (None,)], "code string")
    names = df.select(kinds.op_name(F.col("code")), kinds.row_kind_op(F.col("code"))).collect()
    assert [tuple(r) for r in names] == [("CREATE", "INSERT"), (None, "INSERT"), (None, "INSERT")]


@pytest.mark.parametrize("width", [1, 5, 64, 1 << 20])
def test_resequence_equals_fold(spark, width):
    rng = random.Random(width)
    rows = []
    for part, size in ((0, 200), (1, 10), (2, 1)):
        offsets = [rng.randrange(size * 2) for _ in range(size)]
        rows += [("t", part, o, f"v{o}") for o in offsets]
    df = frame(spark, rows, "topic string, partition int, offset bigint, value string")
    got = sequence.resequence(df, width)
    for part in (0, 1, 2):
        mine = got.where(F.col("partition") == part).select("offset", "run").collect()
        want = fold_runs([r[2] for r in rows if r[1] == part])
        assert sorted(tuple(r) for r in mine) == want


def test_in_offset_order(spark):
    rows = [("t", p, o, "v") for p in (0, 1) for o in range(50)]
    df = frame(spark, rows, "topic string, partition int, offset bigint, value string")
    got = [tuple(r) for r in sequence.in_offset_order(df).collect()]
    assert got == sorted(rows)


def test_hot_keys_are_bounded(spark):
    df = spark.createDataFrame([(k % 5,) for k in range(100)], "id int")
    assert skew.hot_keys(df, KEYS, min_rows=1, max_keys=3).count() == 3
    assert skew.hot_keys(df, KEYS, min_rows=21).count() == 0
