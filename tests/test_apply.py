import random

import pytest
from folds import fold_changes, fold_upserts
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import apply

IMAGE = "struct<id:int,actor:string,alias:string>"
CHANGES = f"seq bigint, op string, before {IMAGE}, after {IMAGE}"
UPSERTS = f"seq bigint, id int, row {IMAGE}"
KEYS = ["id"]


def row(key, actor=None, alias=None):
    return {"id": key, "actor": actor, "alias": alias}


def random_changes(seed, n=400, ids=12, hot=0.4):
    rng = random.Random(seed)
    key = lambda: 0 if rng.random() < hot else rng.randrange(ids)
    out = []
    for seq in range(n):
        op = rng.choice("ccuuddrtm")
        before = row(key()) if op in "ud" else None
        after = row(key(), f"a{seq}", rng.choice([None, f"b{seq}"])) if op in "cur" else None
        out.append((seq, op, before, after))
    return out


BASE = {k: row(k, "base", None) for k in range(0, 12, 2)}


def frame(spark, rows, schema, seed=0):
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, schema).repartition(3)


def base(spark, table=None):
    rows = list((BASE if table is None else table).values())
    return spark.createDataFrame(rows, schemas.DEMO)


def as_table(df):
    rows = [r.asDict() for r in df.collect()]
    table = {r["id"]: r for r in rows}
    assert len(rows) == len(table)
    return table


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [None, 1, 30, 1_000_000])
def test_apply_changes_equals_fold(spark, seed, hot_rows):
    changes = random_changes(seed)
    got = apply.apply_changes(
        base(spark), frame(spark, changes, CHANGES), KEYS, hot_rows=hot_rows
    )
    assert as_table(got) == fold_changes(BASE, [c[1:] for c in changes])


def test_apply_reads(spark):
    changes = random_changes(5)
    got = apply.apply_changes(base(spark), frame(spark, changes, CHANGES), KEYS, apply_reads=True)
    assert as_table(got) == fold_changes(BASE, [c[1:] for c in changes], apply_reads=True)


def test_few_keys_form_equals_plain_form(spark):
    reduced = apply.reduce_changes(frame(spark, random_changes(7), CHANGES), KEYS)
    plain = apply.merge_changes(base(spark), reduced, KEYS)
    few = apply.merge_changes(base(spark), reduced, KEYS, few=True)
    assert as_table(plain) == as_table(few)


def test_order_of_rows_does_not_matter(spark):
    changes = random_changes(3)
    results = [
        as_table(apply.apply_changes(base(spark), frame(spark, changes, CHANGES, s), KEYS))
        for s in (1, 2)
    ]
    assert results[0] == results[1]


def test_empty_changes(spark):
    got = apply.apply_changes(base(spark), frame(spark, [], CHANGES), KEYS)
    assert as_table(got) == BASE


@pytest.mark.parametrize(
    "change",
    [
        (1, "x", None, None),
        (1, "u", None, row(1)),
        (1, "d", None, None),
        (1, "c", None, None),
        (1, "c", None, row(None)),
    ],
)
def test_bad_change_fails(spark, change):
    with pytest.raises(Exception, match="unknown operation|lacks its (before|after)|NULL key"):
        apply.apply_changes(base(spark), frame(spark, [change], CHANGES), KEYS).collect()


def test_policies(spark):
    changes = [(1, "x", None, None), (2, "d", None, None), (3, "t", None, None)]
    df = frame(spark, changes, CHANGES)
    got = apply.apply_changes(
        base(spark), df, KEYS, on_unknown_op="ignore", on_missing_before="ignore"
    )
    assert as_table(got) == BASE
    with pytest.raises(Exception, match="truncate"):
        apply.apply_changes(
            base(spark), frame(spark, changes[2:], CHANGES), KEYS, on_truncate="fail"
        ).collect()


def random_upserts(seed, n=300, tombstones=True):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        key = 0 if rng.random() < 0.4 else rng.randrange(12)
        gone = tombstones and rng.random() < 0.2
        out.append((seq, key, None if gone else row(key, f"a{seq}", rng.choice([None, "b"]))))
    return out


@pytest.mark.parametrize("few", [False, True])
def test_upsert_with_deletes_equals_fold(spark, few):
    rows = random_upserts(1)
    want = fold_upserts(BASE, [r[1:] for r in rows])
    df = frame(spark, rows, UPSERTS)
    assert as_table(apply.upsert(base(spark), df, KEYS, deletes=True)) == want
    reduced = apply.reduce_upserts(df, KEYS, deletes=True)
    assert as_table(apply.merge_changes(base(spark), reduced, KEYS, few=few)) == want


@pytest.mark.parametrize("seed", range(3))
def test_combined_reductions_equal_one(spark, seed):
    changes = random_changes(seed, n=200, ids=40)
    want = fold_changes(BASE, [c[1:] for c in changes])
    parts = None
    for version, low in enumerate(range(0, 200, 20)):
        part = apply.reduce_changes(
            frame(spark, changes[low : low + 20], CHANGES), KEYS, hot_rows=None
        ).withColumn("v", F.lit(version))
        parts = part if parts is None else parts.unionByName(part)
    combined = apply.combine_reduced(parts, KEYS, "v")
    assert as_table(apply.merge_changes(base(spark), combined, KEYS)) == want


def test_plain_upsert_refuses_tombstones(spark):
    rows = frame(spark, [(1, 3, None)], UPSERTS)
    with pytest.raises(Exception, match="NULL row"):
        apply.upsert(base(spark), rows, KEYS).collect()
    with pytest.raises(Exception, match="NULL row"):
        apply.reduce_upserts(rows, KEYS).collect()


def test_upsert_widens_to_target(spark):
    target = base(spark).select(F.col("id").cast("bigint").alias("id"), "actor", "alias")
    got = apply.upsert(target, frame(spark, random_upserts(2, tombstones=False), UPSERTS), KEYS)
    assert got.schema["id"].dataType.simpleString() == "bigint"


def test_insert_delete_update(spark):
    rows = [(s, k, f"a{s}", None) for s, k in enumerate([1, 1, 2, 3, 2, 1])]
    df = frame(spark, rows, "seq bigint, id int, actor string, alias string")
    inserted = as_table(apply.insert_if_absent(base(spark), df, KEYS))
    assert inserted == {**BASE, 1: row(1, "a0"), 3: row(3, "a3")}
    deleted = as_table(apply.delete_by_key(base(spark), df, KEYS))
    assert deleted == {k: v for k, v in BASE.items() if k not in (1, 2, 3)}
    start = {2: row(2, "x", "y"), 4: row(4, "x", "y")}
    updated = as_table(apply.update_by_key(base(spark, start), df, KEYS))
    assert updated == {2: row(2, "a4", None), 4: row(4, "x", "y")}


@pytest.mark.parametrize("how", ["upsert", "insert_if_absent", "delete_by_key", "update_by_key"])
def test_null_keys_fail(spark, how):
    target = spark.createDataFrame([(1, "a", "b")], "id int, actor string, alias string")
    rows = [(None, "x", "y", 5)]
    flat = spark.createDataFrame(rows, "id int, actor string, alias string, seq bigint")
    calls = {
        "upsert": lambda: apply.upsert(
            target, flat.select("id", "seq", F.struct("id", "actor", "alias").alias("row")), KEYS
        ),
        "insert_if_absent": lambda: apply.insert_if_absent(target, flat, KEYS),
        "delete_by_key": lambda: apply.delete_by_key(target, flat, KEYS),
        "update_by_key": lambda: apply.update_by_key(target, flat, KEYS),
    }
    with pytest.raises(Exception, match="NULL key id"):
        calls[how]().collect()
