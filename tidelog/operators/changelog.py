"""Conversions between change envelopes, changelogs, retractions and keyed upserts.

A change has ``seq`` (its place in the total order), ``op``, ``before`` and ``after``.
A changelog row has ``seq``, ``sub`` (order inside one change), ``row_kind`` and the
payload columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import codecs, kinds
from tidelog.operators import skew

CHANGE_FIELDS = ("op", "before", "after")


def _entry(sub: int, kind: str, image: Column) -> Column:
    return F.struct(F.lit(sub).alias("sub"), F.lit(kind).alias("row_kind"), image.alias("image"))


def changelog(changes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per image of each change, with its row kind.

    Reads and creates insert, updates give a before and an after row, deletes give a
    delete row; truncate and message changes carry no row. Columns other than the
    envelope's stay. With ``keys``, an update that changes one of them gives a delete
    and an insert instead, as the row leaves one key and turns up under another.
    """
    op, before, after = (F.col(c) for c in CHANGE_FIELDS)

    needs_after = op.isin("c", "r", "u") & after.isNull()
    needs_before = op.isin("u", "d") & before.isNull()
    moved = F.lit(False)
    for key in keys:
        moved = moved | ~before[key].eqNullSafe(after[key])
    entries = (
        F.when(needs_after, F.raise_error(F.lit("a change lacks its after image")))
        .when(needs_before, F.raise_error(F.lit("a change lacks its before image")))
        .when(op.isin("c", "r"), F.array(_entry(0, kinds.INSERT, after)))
        .when(
            (op == "u") & moved,
            F.array(_entry(0, kinds.DELETE, before), _entry(1, kinds.INSERT, after)),
        )
        .when(
            op == "u",
            F.array(_entry(0, kinds.UPDATE_BEFORE, before), _entry(1, kinds.UPDATE_AFTER, after)),
        )
        .when(op == "d", F.array(_entry(0, kinds.DELETE, before)))
        .when(op.isin("t", "m"), F.lit(None))
        .otherwise(F.raise_error(F.lit("unknown operation code")))
    )
    kept = [c for c in changes.columns if c not in CHANGE_FIELDS]
    rows = changes.select(*kept, F.explode(entries).alias("entry"))
    return rows.select(*kept, "entry.sub", "entry.row_kind", "entry.image.*")


def retractions(log: DataFrame) -> DataFrame:
    """A changelog as (``is_add``, payload): true adds a row, false takes one back."""
    return log.withColumn("row_kind", kinds.is_add(F.col("row_kind"))).withColumnRenamed(
        "row_kind", "is_add"
    )


def images(log: DataFrame, columns: Sequence[str], *extra: str) -> DataFrame:
    """The payload of every changelog row, whatever its kind: a log of images, not a table."""
    return log.select(*extra, *columns)


def without_null_records(df: DataFrame, record: str) -> DataFrame:
    """Drop rows whose record as a whole is NULL; records with NULL fields stay."""
    return df.where(F.col(record).isNotNull())


def upsert_records(log: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A changelog as keyed JSON upserts: the after row, or a NULL value for a delete.

    ``seq`` and ``sub`` fold into one ``offset`` that keeps the order of the log. Rows
    from before an update are left out, so the log must show an update that changes its
    key as a delete and an insert: ``changelog`` does with the same ``keys``.
    """
    return log.where(F.col("row_kind") != kinds.UPDATE_BEFORE).select(
        codecs.to_json(F.struct(*keys)).alias("key"),
        F.when(F.col("row_kind") != kinds.DELETE, codecs.to_json(F.struct(*columns))).alias(
            "value"
        ),
        (F.col("seq") * 2 + F.col("sub")).alias("offset"),
    )


def upsert_table(upserts: DataFrame, keys: Sequence[str], row: str, seq: str) -> DataFrame:
    """The table a keyed upsert feed describes: the last row per key, unless it is NULL."""
    last = upserts.groupBy(*keys).agg(F.max_by(row, seq).alias(row))
    return last.where(F.col(row).isNotNull()).select(f"{row}.*")


def upsert_changelog(
    upserts: DataFrame,
    keys: Sequence[str],
    row: str,
    seq: str,
    emit_unchanged: bool = True,
    table: DataFrame | None = None,
    hot_rows: int = skew.HOT_ROWS,
    width: int = skew.SEGMENT,
) -> DataFrame:
    """The changelog a keyed upsert feed describes.

    The first row of a key inserts, later rows update, a NULL row deletes; a delete for
    an absent key gives nothing. With ``emit_unchanged=False`` an update that changes
    nothing gives nothing either. ``table``, if given, holds the rows from before the feed.
    ``seq`` must be unique per key; a NULL fails.

    The previous row comes from ``lag``. Hot keys are cut into ranges of ``seq``, so no
    task holds more than ``width`` rows of one key, and the last row of each range is
    carried to the first row of the next.
    """
    no_seq = F.raise_error(F.lit("a change without its place in the order"))
    place = F.coalesce(F.col(seq), no_seq.cast(upserts.schema[seq].dataType))
    slim = upserts.select(
        *keys, place.alias("seq"), F.lit(False).alias("earlier"), F.struct(F.col(row)).alias("box")
    )
    if table is not None:
        touched = slim.select(*keys).distinct()
        earlier = table.join(touched, list(keys), "left_semi").select(
            *keys,
            F.lit(-(1 << 63)).cast("bigint").alias("seq"),
            F.lit(True).alias("earlier"),
            F.struct(F.struct(*table.columns).alias(row)).alias("box"),
        )
        slim = slim.unionByName(earlier)
    hot = F.broadcast(skew.hot_keys(slim, keys, min_rows=hot_rows))
    cut = slim.join(hot, list(keys), "left").withColumn(
        "seg", F.when(F.col("hot_rows").isNotNull(), skew.segment("seq", width)).otherwise(-1)
    )
    ends = (
        cut.where(F.col("hot_rows").isNotNull())
        .groupBy(*keys, "seg")
        .agg(F.max_by("box", "seq").alias("box"))
    )
    carried = ends.select(
        *keys, "seg", F.lag("box").over(Window.partitionBy(*keys).orderBy("seg")).alias("carried")
    )
    before = F.lag("box").over(Window.partitionBy(*keys, "seg").orderBy("seq"))
    paired = (
        cut.withColumn("inside", before)
        .join(carried, [*keys, "seg"], "left")
        .select(
            "seq",
            "earlier",
            F.coalesce("inside", "carried")[row].alias("old"),
            F.col("box")[row].alias("new"),
        )
    )
    old, new = F.col("old"), F.col("new")

    changed = F.lit(True) if emit_unchanged else ~old.eqNullSafe(new)
    entries = (
        F.when(old.isNull() & new.isNotNull(), F.array(_entry(0, kinds.INSERT, new)))
        .when(
            old.isNotNull() & new.isNotNull() & changed,
            F.array(_entry(0, kinds.UPDATE_BEFORE, old), _entry(1, kinds.UPDATE_AFTER, new)),
        )
        .when(old.isNotNull() & new.isNull(), F.array(_entry(0, kinds.DELETE, old)))
    )
    rows = paired.where(~F.col("earlier")).select("seq", F.explode(entries).alias("entry"))
    return rows.select("seq", "entry.sub", "entry.row_kind", "entry.image.*")


def append_only(log: DataFrame) -> DataFrame:
    """The payload of an insert-only changelog; any other row kind fails the query."""
    kind = F.col("row_kind")
    shown = F.coalesce(kind, F.lit("NULL"))
    checked = F.when(kind == kinds.INSERT, kind).otherwise(
        F.raise_error(F.concat(F.lit("an append-only table cannot take a row of kind "), shown))
    )
    return log.where(checked == kinds.INSERT).drop("row_kind", "sub")
