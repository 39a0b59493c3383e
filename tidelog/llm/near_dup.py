"""Near-duplicate documents by bottom-k sketches of their word shingles.

One hash function orders all shingles. A document's sketch is its ``k`` smallest shingle
hashes (all, if it has fewer), so one list serves as MinHash sample, as index key and,
for short texts, as the full set.

1. Documents with equal shingle sets become one class; its smallest id stands for it.
2. Inverted lists of the retained values give overlaps. Two linked classes share at least
   ``overlap`` sketch values (below), so they share one of the ``size - overlap + 1``
   rarest of either side. Only those values are looked up: a passage that thousands of
   documents share makes values too common to be among them, whatever its length.
3. First every list is matched with its centre, the member whose values are the most
   common: the text a family of copies derives from. Classes that link are one component.
4. The classes of lists with several components are then matched across components by
   their full sets, exactly, through lists of their rarest shingles. Within a component
   links add nothing, and members of a family that have too much of their own to link
   with anyone meet nobody there.
5. A pair is dropped if the sketch of the union, the ``k`` smallest of both sketches
   together, has too few values in common; the rest are verified on full sets.

Overlap. A union sketch of a pair with Jaccard similarity ``t`` samples ``k`` shingles of
the union without replacement; of these, fewer than ``m`` lie in both sets with a chance
of at most ``exp(-k * KL(m/k, t))``. ``m`` is the largest with ``exp(-20)``, 2e-9. Where
a partner's union with the set cannot exceed ``k`` shingles, the overlap is exact:
``t`` times the set.

A document is its ``doc_id``: rows that share one share a component. Rows without an id
link with nothing and are kept. NULL texts, and texts without words, have an empty set,
which links with nothing. Words lower-case A-Z; a text with fewer words than a shingle
has its whole sequence as one. Texts of any length are read whole; an empty table gives no rows;
columns beyond id and text are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import words as W
from tidelog.llm.common import stored, texts
from tidelog.llm.components import components

K = 64


def needed_overlap(percent: int, k: int = K) -> int:
    """The overlap of two full sketches that linked documents have but with chance 2e-9."""
    t = percent / 100

    def unlikely(m: int) -> bool:
        a = (m - 1) / k
        if a >= t:
            return False
        kl = (a * math.log(a / t) if a else 0.0) + (1 - a) * math.log((1 - a) / (1 - t))
        return k * kl >= 20

    return max([m for m in range(1, k + 1) if unlikely(m)], default=1)


def _sets(part: W.Slice, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sorted distinct shingle hashes of every row of a slice."""
    words = W.find_words(part)
    grams, begin = W.row_grams(W.span_hashes(part.data, words.start, words.end), words.first, shingle)
    for r in range(len(begin) - 1):
        yield part.low + r, np.unique(grams[begin[r] : begin[r + 1]])


def sketches(docs: DataFrame, shingle: int, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, digest, sketch``; the digest names the full set."""

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch.column("text")):
                sizes, digests, kept = [], [], []
                for _, values in _sets(part, shingle):
                    sizes.append(len(values))
                    mixed = W.mix(values ^ W.U64(0xA5A5A5A5A5A5A5A5))
                    digests.append((mixed.sum(dtype=W.U64), np.bitwise_xor.reduce(mixed)))
                    kept.append(values[:k])
                bounds = np.append(0, np.cumsum([len(x) for x in kept])).astype(np.int32)
                flat = np.concatenate(kept).view(np.int64)
                pairs = np.array(digests, dtype=W.U64).view(np.int64)
                digest = pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.low, part.high - part.low),
                        pa.array(np.array(sizes, dtype=np.int64)),
                        digest,
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                    ],
                    names=["doc_id", "n_shingles", "digest", "sketch"],
                )

    schema = "doc_id long, n_shingles long, digest struct<a: long, b: long>, sketch array<long>"
    return docs.mapInArrow(sketch, schema)


def _lists(classes: DataFrame, percent: int, k: int) -> DataFrame:
    """``value, key, id, n, weight``: the rare ends of the sketches that others share.

    ``weight`` grows with how common the values of the class are.
    """
    own = ["key", "id", "n"]
    postings = classes.select(*own, F.explode("sketch").alias("value"))
    often = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = postings.join(often, "value").groupBy(*own).agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"),
        F.sum(F.log2("df")).alias("weight"),
    )
    size = F.least(F.col("n"), F.lit(k))
    exact = F.ceil(F.col("n") * percent / 100)
    bound = F.lit(needed_overlap(percent, k))
    overlap = F.when(F.col("n") * 100 <= k * percent, exact).otherwise(bound)
    # values that no other class has come first in the order of rarity
    alone = size - F.size("values")
    rare = F.greatest(size - overlap + 1 - alone, F.lit(0)).cast("int")
    ends = F.slice("values", 1, rare)
    return shared.select(*own, "weight", F.explode(ends).alias("v")).select(
        F.col("v.value").alias("value"), *own, "weight"
    )


def _met(lists: DataFrame) -> DataFrame:
    """The lists with more than one member."""
    several = lists.groupBy("value").agg(F.count("*").alias("members")).where("members > 1")
    return lists.join(several.select("value"), "value")


def _centre_pairs(lists: DataFrame, percent: int) -> DataFrame:
    centre = lists.groupBy("value").agg(F.max_by(F.struct("id", "n"), F.struct("weight", -F.col("id"))).alias("c"))
    met = lists.join(centre.select("value", F.col("c.id").alias("c"), F.col("c.n").alias("cn")), "value")
    met = met.where("id <> c").where(F.least("n", "cn") * 100 >= F.greatest("n", "cn") * percent)
    return met.select(F.greatest("id", "c").alias("a"), F.least("id", "c").alias("b")).distinct()


def _band(n: Column) -> Column:
    """Sizes in steps of about 1.5 %."""
    return F.floor(F.log(n) * 64).cast("int")


def _unmerged(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, component``: the classes in lists that hold several components."""
    marked = lists.join(labels.withColumnRenamed("node", "id"), "id", "left")
    marked = marked.select("value", "key", F.coalesce("component", "id").alias("component"))
    spread = marked.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = spread.where("low <> high").select("value")
    return marked.join(several, "value").select("key", "component").distinct()


def _crossing_pairs(sets: DataFrame, unmerged: DataFrame, percent: int) -> DataFrame:
    """All pairs of unmerged classes from different components that may link.

    Sets of ``n >= m`` shingles that link have ``a = percent * (n + m) / (100 + percent)``
    in common, so one of the ``n - a + 1`` rarest of the larger is among the ``m - a + 1``
    rarest of the smaller. Smaller sets wait in lists by value and band of sizes, and
    larger ones ask in every band with as many values as its sizes call for. Where the
    rest of either set is too short for ``a``, the pair is left out.
    """
    own = sets.join(unmerged, "key").withColumn("n", F.size("values").cast("long"))
    whose = ["key", "id", "n", "component"]
    postings = own.select(*whose, F.explode("values").alias("value"))
    often = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    ordered = postings.join(often, "value").groupBy(*whose).agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values")
    )
    alone = F.col("n") - F.size("values")

    def common(n: Column, m: Column) -> Column:
        return F.ceil(percent * (n + m) / (100 + percent))

    def rarest(count: Column) -> Column:
        """Place and value of the ``count`` rarest values, but for those it has alone."""
        return F.posexplode(F.slice("values", 1, F.greatest(count - alone, F.lit(0)).cast("int")))

    n, m = F.col("n"), F.col("m")
    waiting = ordered.select(*whose, alone.alias("alone"), rarest(n - common(n, n) + 1).alias("at", "v"))
    waiting = waiting.select("v.value", _band(n).alias("band"), *_place("y"))
    least = F.ceil(n * percent / 100)
    asking = ordered.withColumn("band", F.explode(F.sequence(_band(least), _band(n))))
    asking = asking.withColumn("m", F.greatest(least, F.ceil(F.exp(F.col("band") / 64))))
    asking = asking.select(*whose, "band", alone.alias("alone"), rarest(n - common(n, m) + 1).alias("at", "v"))
    asking = stored(asking.select("v.value", "band", *_place("x")), "asking")
    waiting = stored(waiting, "waiting")

    # in a list, members of its largest component are not matched with each other
    sizes = waiting.groupBy("value", "ycomponent").agg(F.count("*").alias("members"))
    home = sizes.groupBy("value").agg(F.max_by("ycomponent", F.struct("members", -F.col("ycomponent"))).alias("home"))
    asking, waiting = asking.join(home, "value"), waiting.join(home, "value")
    xn, yn = F.col("xn"), F.col("yn")
    rest = F.least(xn - F.col("xat"), yn - F.col("yat"))
    may = (F.col("xcomponent") != F.col("ycomponent")) & (yn <= xn) & (rest >= common(xn, yn))
    strange = asking.where("xcomponent <> home").join(waiting, ["value", "band"]).where(may)
    at_home = asking.where("xcomponent = home").join(waiting.where("ycomponent <> home"), ["value", "band"]).where(may)
    met = strange.select("xid", "yid").union(at_home.select("xid", "yid"))
    return met.select(F.greatest("xid", "yid").alias("a"), F.least("xid", "yid").alias("b")).distinct()


def _place(side: str) -> list[Column]:
    """Whose posting it is, and how many values of the set come before it."""
    before = F.col("alone") + F.col("at")
    return [*(F.col(c).alias(side + c) for c in ("id", "n", "component")), before.alias(f"{side}at")]


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs whose union sketch has enough values in both; ``sure`` where it is the union."""
    own = classes.select("id", "n", "sketch")
    met = pairs.join(own.toDF("a", "an", "as"), "a").join(own.toDF("b", "bn", "bs"), "b")

    def estimate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = needed_overlap(percent, k)
        for batch in batches:
            keep, sure = np.zeros(batch.num_rows, dtype=bool), np.zeros(batch.num_rows, dtype=bool)
            sides = [[x.values.to_numpy() for x in batch.column(c)] for c in ("as", "bs")]
            whole = [batch.column(c).to_numpy() <= k for c in ("an", "bn")]
            for i, (x, y) in enumerate(zip(*sides)):
                x, y = x.view(W.U64), y.view(W.U64)
                if whole[0][i] and whole[1][i]:  # the sketches are the sets
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = sure[i] = 100 * common >= percent * (len(x) + len(y) - common)
                else:
                    both, times = np.unique(np.concatenate([x, y]), return_counts=True)
                    keep[i] = (times[:k] == 2).sum() >= least
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(sure)], names=["a", "b", "sure"]
            ).filter(pa.array(keep))

    return met.select("a", "an", "as", "b", "bn", "bs").mapInArrow(estimate, "a long, b long, sure boolean")


def _full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``key, id, values``: the full sets of the classes that ``wanted`` has the keys of."""

    def full(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch.column("text")):
                rows, kept = [], []
                for r, values in _sets(part, shingle):
                    mixed = W.mix(values ^ W.U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=W.U64)
                    if mixed.view(np.int64) == batch.column("key")[r].as_py():  # else another text of the id
                        rows.append(r)
                        kept.append(values)
                take = pa.array(rows, pa.int64())
                bounds = np.append(0, np.cumsum([len(x) for x in kept])).astype(np.int32)
                flat = np.concatenate([np.zeros(0, W.U64), *kept]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(take) for c in ("key", "doc_id")),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                    ],
                    names=["key", "id", "values"],
                )

    named = classes.join(wanted, "key", "left_semi").select(F.col("id").alias("doc_id"), "key")
    found = docs.join(named, "doc_id").select("doc_id", "key", "text")
    return found.mapInArrow(full, "key long, id long, values array<long>").dropDuplicates(["key"])


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs that link by their full sets."""
    hopeful = stored(_estimated(pairs, classes, percent, k), "estimated")
    own = sets.select("id", "values")
    both = hopeful.where("not sure").join(own.toDF("a", "x"), "a").join(own.toDF("b", "y"), "b")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x, y = (batch.column(c)[i].values.to_numpy() for c in ("x", "y"))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    exact = both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")
    return hopeful.where("sure").select("a", "b").union(exact)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of the input.

    Documents link with ``100 * intersection >= percent * union``; ``component_id`` is
    the smallest id reachable.
    """
    docs = texts(docs)
    own = stored(sketches(docs, shingle, k), "sketches")
    named = own.where("n_shingles > 0 and doc_id is not null")
    by_set = named.groupBy("n_shingles", "digest").agg(
        F.min_by("sketch", "doc_id").alias("sketch"), F.min("doc_id").alias("id")
    )
    # rows that share an id may bring several sets; a link of one is a link of the id
    classes = by_set.select(F.col("digest.a").alias("key"), "id", F.col("n_shingles").alias("n"), "sketch")
    classes = stored(classes, "classes")
    members = named.select("doc_id", F.col("digest.a").alias("key")).join(classes.select("key", "id"), "key")
    members = members.select(F.col("doc_id").alias("a"), F.col("id").alias("b")).where("a <> b").distinct()

    lists = stored(_met(_lists(classes, percent, k)), "lists")
    sets = stored(_full_sets(docs, classes, lists.select("key").distinct(), shingle), "sets")
    links = stored(_verified(_centre_pairs(lists, percent), classes, sets, percent, k), "links")
    labels = stored(components(links), "labels")
    unmerged = stored(_unmerged(lists, labels), "unmerged")
    rest = _verified(_crossing_pairs(sets, unmerged, percent), classes, sets, percent, k)

    edges = members.union(labels.select("node", "component")).union(rest)
    found = components(stored(edges.distinct(), "edges"))
    out = own.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def kept_documents(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all columns, of which one document of each group stays.

    Here a document is its ``doc_id`` and its text: different texts under one id, and texts
    without an id, are documents of their own. The one with the smallest id stays (NULL last,
    then by a hash of the text); of rows with its id and text one stays, the least by a hash of
    all columns.
    """
    counted = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if counted.where("n > 1 or doc_id is null").isEmpty():
        # ids tell documents apart, so texts need not be moved a second time
        gone = near_duplicates(docs, shingle, percent).where("not kept").select("doc_id").distinct()
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    node = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), F.col("text"))
    ids = docs.select(node.alias("__node"), F.col("doc_id").alias("__id"))
    found = near_duplicates(docs.select(node.alias("doc_id"), "text"), shingle, percent)
    found = stored(found.select(F.col("doc_id").alias("__node"), "component_id").distinct(), "near")
    order = F.struct(F.col("__id").isNull().alias("none"), "__id", "__node")
    named = ids.groupBy("__node", "__id").agg(F.count("*").alias("__n"))
    named = stored(named, "named")
    best = named.join(found, "__node").groupBy("component_id").agg(F.min(order).alias("least"))
    chosen = best.select(F.col("least.__node").alias("__node"))
    left = docs.withColumn("__node", node).join(chosen, "__node", "left_semi")
    several = named.where("__n > 1").select("__node")
    once = left.join(several, "__node", "left_anti").select(*docs.columns)
    again = left.join(several, "__node", "left_semi").withColumn("__row", F.struct(*docs.columns))
    again = again.groupBy("__node").agg(F.min_by("__row", F.xxhash64(*docs.columns)).alias("__row"))
    return once.unionByName(again.select("__row.*"))
