"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

A *group* is the rows of equal texts; its vector is its bytes (UTF-8 and ``OVERHEAD`` a row),
tokens (words) and rows, each as a share of what one shard should hold. Items, largest first,
go where the dot product with the shard's residual capacity is highest, among the shards that
still have room for their bytes; so bytes are near equal at the end (the law ``bytes``), and
tokens and rows as near as the groups allow.

What is packed has a bound, whatever the input: groups with a share of over ``1 / CELLS`` of
all bytes, tokens or rows (fewer than ``3 CELLS``) are items of their own, and the others are
gathered by a hash of their text into ``CELLS`` cells, whose sums are items. So the driver
packs at most ``4 CELLS`` items and sends that many places back.

A group stays whole unless it has over ``WHOLE`` of a shard's share in some dimension, so that
no shard could hold it. Such a group, a third of all rows perhaps, is cut into the fewest equal pieces that do not, by the
place of its rows; equal texts then lie in as few shards as these pieces need.

Places (``slot``, and the cuts) number the rows of a stored table: rows are counted by group and
by the task that wrote them, the counts are summed, and rows are numbered inside a task's share,
so that no group is ever brought together. Reruns over the same files agree.

A NULL text has no bytes and no checksum; all NULL texts are one group. Texts of any length
are read whole. ``doc_id`` plays no part: NULL or repeated ids are rows like others. Other
columns, whatever their names, are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, stored, texts

SHARDS = 40
OVERHEAD = 16
CELLS = 1 << 14
WHOLE = 1.0

_SIZES = ("size", "tokens", "rows")


def facts(docs: DataFrame) -> DataFrame:
    """Every row, without its text: size, checksum, tokens, group, cell, and the row's place."""
    text = F.col("text")
    data = text.cast("binary")
    return texts(docs).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.md5(data), F.lit("")).alias("group"),
        F.monotonically_increasing_id().alias("place"),
    )


def _cell(cells: int) -> Column:
    return F.pmod(F.xxhash64("group"), F.lit(cells)).cast("int")


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item; ``vectors`` are shares of a shard in bytes, tokens and rows.

    Items go by falling sums of shares, ties in the order given.
    """
    out = np.zeros(len(vectors), np.int64)
    residual = np.ones((shards, vectors.shape[1]))
    for i in np.argsort(-vectors.sum(axis=1), kind="stable"):
        own = vectors[i]
        fits = residual[:, 0] >= own[0]
        score = np.where(fits, residual @ own, -np.inf) if fits.any() else residual[:, 0]
        out[i] = best = int(np.argmax(score))
        residual[best] -= own
    return out


def _numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with their number from 0 within ``key``, by ``place``."""
    cut = rows.withColumn("task", F.shiftrightunsigned("place", 33))
    counts = cut.groupBy(key, "task").agg(F.count("*").alias("held"))
    before = Window.partitionBy(key).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(key, "task", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("shift"))
    inside = F.row_number().over(Window.partitionBy(key, "task").orderBy("place")) - 1
    found = cut.withColumn("inside", inside).join(shift, [key, "task"])
    return found.withColumn(name, (F.col("shift") + F.col("inside")).cast("long")).select(*rows.columns, name)


def shard(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS, whole: float = WHOLE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot`` of every row of ``docs``."""
    spark = docs.sparkSession
    rows = stored(facts(docs), "facts")
    groups = rows.groupBy("group").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
    )
    groups = stored(groups, "groups")
    total = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SIZES]).first()
    share = np.array([max(1, total[c]) / shards for c in _SIZES])
    heavy = F.lit(False)
    for c in _SIZES:
        heavy = heavy | (F.col(c) * cells > max(1, total[c]))
    large = groups.where(heavy).orderBy("group").toArrow()
    light = groups.where(~heavy).groupBy(_cell(cells).alias("cell"))
    light = light.agg(*[F.sum(c).alias(c) for c in _SIZES]).orderBy("cell").toArrow()

    def vectors(table) -> np.ndarray:
        return np.stack([table[c].to_numpy() / s for c, s in zip(_SIZES, share)], axis=1)

    own, copies = vectors(large), large["rows"].to_numpy()
    pieces = np.ceil(own.max(axis=1, initial=0) / whole).astype(np.int64)
    pieces = np.clip(pieces, 1, copies)  # a row is never cut
    ends = np.cumsum(pieces)
    group = np.repeat(np.arange(len(pieces)), pieces)
    nth = np.arange(len(group)) - (ends - pieces)[group]
    # piece i of m holds the rows from ceil(i copies / m) on
    first, last = (-(-(nth + i) * copies[group] // pieces[group]) for i in (0, 1))
    parts = own[group] * ((last - first) / copies[group])[:, None]
    placed = pack(np.concatenate([parts, vectors(light)]), shards)
    listed = [placed[b - n : b].tolist() for b, n in zip(ends, pieces)]
    by_group = spark.createDataFrame(
        list(zip(large["group"].to_pylist(), listed, copies.tolist())), "group string, parts array<int>, copies long"
    )
    by_cell = np.zeros(cells, np.int64)
    by_cell[light["cell"].to_numpy()] = placed[len(placed) - light.num_rows :]
    cell_shard = spark.createDataFrame(list(enumerate(by_cell.tolist())), "cell int, cell_shard int")

    found = rows.join(F.broadcast(by_group), "group", "left").withColumn("cell", _cell(cells))
    found = found.join(F.broadcast(cell_shard), "cell")
    result = found.select("doc_id", "size", "text_crc32", "place", "group", "parts", "copies", "cell_shard")
    split = F.coalesce(F.size("parts") > 1, F.lit(False))
    first = F.coalesce(F.get("parts", F.lit(0)), F.col("cell_shard"))
    dealt = result.where(~split).withColumn("shard", first)
    if any(len(x) > 1 for x in listed):
        piece = F.expr("get(parts, cast(nth * size(parts) div copies as int))")
        cut = _numbered(result.where(split), "group", "nth").withColumn("shard", piece)
        dealt = dealt.unionByName(cut.drop("nth"))
    dealt = stored(dealt.select("doc_id", "size", "text_crc32", "place", "shard"), "dealt")
    slotted = _numbered(dealt, "shard", "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")
