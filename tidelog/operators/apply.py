"""Applying changes to a keyed table, as set-based jobs.

Every operator comes in two steps: *reduce* the changes to one row per key, then
*merge* that with the target. Order comes from ``seq``, a total order carried by the
changes, never from arrival. Keys must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import skew


def _fail(message: str) -> Column:
    return F.raise_error(F.lit(message))


def _steps(
    changes: DataFrame,
    keys: Sequence[str],
    apply_reads: bool,
    on_missing_before: str,
    on_truncate: str,
    on_unknown_op: str,
) -> DataFrame:
    """Changes as deletes and inserts of single keys, ordered by ``q``.

    An update is a delete of its before key and then an insert of its after row, so
    updates that change the key need no special case.
    """
    for policy in (on_missing_before, on_truncate, on_unknown_op):
        if policy not in ("fail", "ignore"):
            raise ValueError("policies are 'fail' or 'ignore'")
    op, before, after = F.col("op"), F.col("before"), F.col("after")
    row_type = changes.schema["after"].dataType

    def key_of(image: Column) -> list[Column]:
        return [F.coalesce(image[k], _fail(f"NULL key {k}")).alias(k) for k in keys]

    delete = F.struct(
        *key_of(before),
        (F.col("seq") * 2).alias("q"),
        F.lit(True).alias("is_delete"),
        F.lit(None).cast(row_type).alias("row"),
    )
    insert = F.struct(
        *key_of(after),
        (F.col("seq") * 2 + 1).alias("q"),
        F.lit(False).alias("is_delete"),
        after.alias("row"),
    )
    nothing = F.lit(None)
    no_before = _fail("a change lacks its before image") if on_missing_before == "fail" else nothing
    no_after = _fail("a change lacks its after image")
    truncate = _fail("a truncate cannot be applied") if on_truncate == "fail" else nothing
    unknown = _fail("unknown operation code") if on_unknown_op == "fail" else nothing
    inserts = op.isin("c", "r") if apply_reads else op == "c"
    steps = (
        F.when(inserts & after.isNull(), no_after)
        .when(inserts, F.array(insert))
        .when((op == "u") & after.isNull(), no_after)
        .when((op == "u") & before.isNull(), no_before)
        .when(op == "u", F.array(delete, insert))
        .when((op == "d") & before.isNull(), no_before)
        .when(op == "d", F.array(delete))
        .when(op == "t", truncate)
        .when(op.isin("r", "m"), nothing)
        .otherwise(unknown)
    )
    return changes.select(F.inline(steps))


def reduce_changes(
    changes: DataFrame,
    keys: Sequence[str],
    apply_reads: bool = False,
    on_missing_before: str = "fail",
    on_truncate: str = "ignore",
    on_unknown_op: str = "fail",
    hot_rows: int | None = skew.HOT_ROWS,
    within: Column | None = None,
) -> DataFrame:
    """One row per touched key: ``had_delete``, and ``row``, the first insert after the last delete.

    With ``within``, a condition on the key columns, other keys are left out, even of an
    update that moves a row between two keys.

    Cold keys take one shuffle. Hot keys are never shuffled row by row: their last delete
    is broadcast (at most ``skew.MAX_HOT_KEYS`` rows), the inserts after it are found
    where they lie, and each task passes on one row per hot key. ``hot_rows=None`` skips
    the pass that looks for hot keys, for feeds known to have none.
    """
    keys = list(keys)
    steps = _steps(changes, keys, apply_reads, on_missing_before, on_truncate, on_unknown_op)
    steps = steps if within is None else steps.where(within)
    delete_q = F.when(F.col("is_delete"), F.col("q"))

    last, q = F.col("last_delete"), F.col("q")

    def collapse(df: DataFrame) -> DataFrame:
        live = ~F.col("is_delete") & (last.isNull() | (q > last))
        return df.groupBy(*keys).agg(
            F.max(last.isNotNull()).alias("had_delete"),
            F.min_by("row", F.when(live, q)).alias("row"),
        )

    within_key = F.max(delete_q).over(Window.partitionBy(*keys))
    if hot_rows is None:
        return collapse(steps.withColumn("last_delete", within_key))
    hot = skew.hot_keys(steps, keys, F.max(delete_q).alias("last_delete"), min_rows=hot_rows)
    # One join shape for both parts, so Spark finds the hot keys once. When there are
    # none, adaptive execution drops the join and the hot part.
    marked = steps.join(F.broadcast(hot), keys, "left")
    cold_part = marked.where(F.col("hot_rows").isNull())
    cold_part = cold_part.withColumn("last_delete", F.coalesce(within_key, last))
    hot_part = marked.where(
        F.col("hot_rows").isNotNull()
        & (last.isNull() | (q == last) | (~F.col("is_delete") & (q > last)))
    )
    return collapse(cold_part).unionByName(collapse(hot_part))


def _as_target(row: Column, target: DataFrame) -> Column:
    """``row`` with the columns and types of ``target``."""
    return F.struct(*[row[f.name].cast(f.dataType).alias(f.name) for f in target.schema.fields])


def merge_changes(
    target: DataFrame, reduced: DataFrame, keys: Sequence[str], few: bool = False
) -> DataFrame:
    """The target after reduced changes: deleted keys go, absent keys come.

    The plain form is one full outer join. ``few`` says the caller has counted the
    reduced keys and found them few: then only keys are broadcast and the target is
    not shuffled.
    """
    keys = list(keys)
    new_row = F.when(F.col("row").isNotNull(), _as_target(F.col("row"), target))
    if few:
        deleted = reduced.where("had_delete").select(*keys)
        plain = reduced.where(~F.col("had_delete")).select(*keys)
        kept = target.join(F.broadcast(deleted), keys, "left_anti")
        present = target.select(*keys).join(F.broadcast(plain), keys, "left_semi").distinct()
        added = reduced.where(F.col("row").isNotNull()).join(present, keys, "left_anti")
        return kept.unionByName(added.select(new_row.alias("row")).select("row.*"))
    old = target.select(*keys, F.struct(*target.columns).alias("old"))
    joined = old.join(reduced, keys, "full_outer")
    keep = F.col("old").isNotNull() & ~F.coalesce("had_delete", F.lit(False))
    result = joined.select(F.when(keep, F.col("old")).otherwise(new_row).alias("result"))
    return result.where(F.col("result").isNotNull()).select("result.*")


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], **options
) -> DataFrame:
    """Apply change envelopes to a table.

    Creates insert if absent, updates delete and then insert, deletes delete. Reads are
    ignored unless ``apply_reads``; see ``reduce_changes`` for the options.
    """
    return merge_changes(target, reduce_changes(changes, keys, **options), keys)


def _with_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows``, failing at a NULL key."""
    return rows.withColumns({k: F.coalesce(F.col(k), _fail(f"NULL key {k}")) for k in keys})


def latest_upserts(upserts: DataFrame, keys: Sequence[str], row: str, seq: str) -> DataFrame:
    """The last row per key, NULL for a delete; combined before the shuffle."""
    return _with_keys(upserts, keys).groupBy(*keys).agg(F.max_by(row, seq).alias("row"))


def _no_tombstones(latest: DataFrame) -> DataFrame:
    return latest.withColumn(
        "row", F.coalesce("row", _fail("a NULL row, which deletes, without deletes=True"))
    )


def reduce_upserts(
    upserts: DataFrame,
    keys: Sequence[str],
    row: str = "row",
    seq: str = "seq",
    deletes: bool = False,
) -> DataFrame:
    """Upserts in the form of ``reduce_changes``: each replaces whatever its key held."""
    latest = latest_upserts(upserts, keys, row, seq)
    latest = latest if deletes else _no_tombstones(latest)
    return latest.select(*keys, F.lit(True).alias("had_delete"), "row")


def combine_reduced(reduced: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Several reductions, applied in order of ``version``, as one.

    A key has at most one row per version, so the window over a key is small.
    """
    last = F.max(F.when(F.col("had_delete"), F.col(version))).over(Window.partitionBy(*keys))
    live = F.col("row").isNotNull() & (F.col("last").isNull() | (F.col(version) >= F.col("last")))
    return (
        reduced.withColumn("last", last)
        .groupBy(*keys)
        .agg(
            F.max("had_delete").alias("had_delete"),
            F.min_by("row", F.when(live, F.col(version))).alias("row"),
        )
    )


#: Columns of a versioned table beside its own: the position of a row's write, and
#: whether that write deleted it (a tombstone, which holds only the key).
VERSION = (T.StructField("_seq", T.LongType()), T.StructField("_deleted", T.BooleanType()))


def latest_versions(
    upserts: DataFrame,
    keys: Sequence[str],
    row: str = "row",
    seq: str = "seq",
    deletes: bool = False,
) -> DataFrame:
    """The last write per key and its position: key, ``seq``, ``row`` (NULL for a delete).

    Unlike ``reduce_upserts`` the result can meet other writes in any order.
    """
    placed = _with_keys(upserts, keys).withColumn(seq, F.coalesce(F.col(seq), _fail("a write without seq")))
    latest = placed.groupBy(*keys).agg(F.max(seq).alias("seq"), F.max_by(row, seq).alias("row"))
    return latest if deletes else _no_tombstones(latest)


def combine_versions(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Several sets of latest writes as one; their order does not matter."""
    return versions.groupBy(*keys).agg(F.max("seq").alias("seq"), F.max_by("row", "seq").alias("row"))


def merge_versions(
    target: DataFrame, versions: DataFrame, keys: Sequence[str], few: bool = False
) -> DataFrame:
    """A versioned table after latest writes: per key the write of the highest ``seq`` stays.

    Tombstones stay in the table, so merging commutes: any order and grouping of the
    writes gives the same rows. A write at the position the table has is that write again.
    ``few`` is as in ``merge_changes``.
    """
    keys, row = list(keys), F.col("row")
    names = [f.name for f in VERSION]
    fields = [
        (F.when(row.isNotNull(), row[f.name]).otherwise(F.col(f.name)) if f.name in keys else row[f.name])
        .cast(f.dataType)
        .alias(f.name)
        for f in target.schema.fields
        if f.name not in names
    ]
    new = F.struct(*fields, F.col("seq").alias("_seq"), row.isNull().alias("_deleted"))
    if few:
        places = F.broadcast(versions.select(*keys, F.col("seq").alias("_new")))
        kept = target.join(places, keys, "left")
        kept = kept.where(F.col("_new").isNull() | (F.col("_seq") >= F.col("_new"))).drop("_new")
        newer = target.select(*keys, "_seq").join(places, keys).where(F.col("_seq") >= F.col("_new"))
        added = versions.join(newer.select(*keys), keys, "left_anti")
        return kept.select(*target.columns).unionByName(added.select(new.alias("new")).select("new.*"))
    old = target.select(*keys, F.struct(*target.columns).alias("old"))
    joined = old.join(versions, keys, "full_outer")
    stays = F.col("seq").isNull() | F.coalesce(F.col("old._seq") >= F.col("seq"), F.lit(False))
    return joined.select(F.when(stays, F.col("old")).otherwise(new).alias("result")).select("result.*")


def upsert(
    target: DataFrame,
    upserts: DataFrame,
    keys: Sequence[str],
    row: str = "row",
    seq: str = "seq",
    deletes: bool = False,
) -> DataFrame:
    """Update rows whose key exists, insert the others; the last write wins.

    With ``deletes`` a NULL row deletes; without, it fails.
    """
    keys = list(keys)
    latest = latest_upserts(upserts, keys, row, seq)
    kept = target.join(latest.select(*keys), keys, "left_anti")
    rows = latest.where(F.col("row").isNotNull()) if deletes else _no_tombstones(latest)
    return kept.unionByName(
        rows.select(_as_target(F.col("row"), target).alias("row")).select("row.*")
    )


def insert_if_absent(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], seq: str = "seq"
) -> DataFrame:
    """Add the first row of every key the target lacks."""
    keys = list(keys)
    first = _with_keys(rows, keys).groupBy(*keys).agg(
        F.min_by(F.struct(*[c for c in rows.columns if c != seq]), seq).alias("row")
    )
    added = first.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(
        added.select(_as_target(F.col("row"), target).alias("row")).select("row.*")
    )


def delete_by_key(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove the rows whose key is listed."""
    return target.join(_with_keys(doomed, keys).select(*keys).distinct(), list(keys), "left_anti")


def update_by_key(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], seq: str = "seq"
) -> DataFrame:
    """Set the other columns of existing rows to the last values given, NULLs included."""
    keys = list(keys)
    last = _with_keys(rows, keys).groupBy(*keys).agg(
        F.max_by(F.struct(*[c for c in rows.columns if c not in (*keys, seq)]), seq).alias("new")
    )
    columns = []
    for field in target.schema.fields:
        if field.name in keys or field.name not in rows.columns:
            columns.append(F.col(field.name))
        else:
            new = F.col("new")[field.name].cast(field.dataType)
            columns.append(
                F.when(F.col("new").isNotNull(), new).otherwise(F.col(field.name)).alias(field.name)
            )
    return target.join(last, keys, "left").select(*columns)
