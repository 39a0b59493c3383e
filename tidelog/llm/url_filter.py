"""Judging URLs: rules first, then gradient-boosted trees on lexical features.

A rule has a host, a path and a verdict. It fits a URL whose host is the rule's or a
subdomain of it and whose path starts with the rule's; the longest rule that fits wins.
URLs that no rule fits are judged by trees that learned from the URLs that rules judge.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased. Path: what follows the host up to ``?``, ``#`` or the end. A NULL URL, or
one without ``://``, has both empty, fits no rule and is judged by the trees.

Features are those of the text alone: lengths, depth, shares of digits and hyphens,
entropy, numbers of parameters and labels, and the smoothed share of blocked URLs among
the training URLs with the same suffix: the label before the host's last two, the first
segment of the path, the second, and the file ending. A suffix that some rule tests is left
out: it would only hand the rules back. A training URL has its shares from the other folds (by
a hash of the URL), not from itself. Trees are Spark ML's.
Training reads about ``SAMPLE`` judged URLs, chosen by a hash of the URL; shares count all of
them. Where rules judge nothing, or all alike, the verdict of the rest is that one verdict
(allow for none).

URLs that repeat are judged alike, each row for itself; URLs of any length are read whole. An
empty table gives no rows. Columns beyond id and URL are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored

SAMPLE = 20_000
TREES = 10
DEPTH = 4
SEED = 7
ALLOW, BLOCK = "allow", "block"
FOLDS = 5
SUFFIXES = ("site", "first_segment", "second_segment", "ending")
NUMBERS = ("url_length", "host_length", "path_length", "depth", "labels", "digits", "hyphens", "entropy", "parameters")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://((?s:.*))$", 1)
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return _lower(host), path


def _judged(rules: list[Rule]) -> Column:
    """The longest rule that fits, as ``struct(rule, verdict)``; NULL for none."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = host & F.col("path").startswith(rule.path)
        told = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, told) if out is None else out.when(fits, told)
    return out if out is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def untested(rules: list[Rule]) -> list[str]:
    """The suffixes that no rule looks at."""
    tested = {
        "site": any(r.host.count(".") >= 2 for r in rules),
        "first_segment": any(len(r.path) > 1 for r in rules),
        "second_segment": any(r.path.count("/") > 1 and not r.path.endswith("/") or r.path.count("/") > 2 for r in rules),
        "ending": any("." in r.path for r in rules),
    }
    return [name for name in SUFFIXES if not tested[name]]


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.split(text, "")
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def part(letter: Column) -> Column:
        share = F.size(F.filter(letters, lambda x: x == letter)) / n
        return -share * F.log2(share)

    return F.aggregate(
        F.filter(F.array_distinct(letters), lambda x: x != ""), F.lit(0.0), lambda total, x: total + part(x)
    )


def featured(urls: DataFrame) -> DataFrame:
    """Numbers and suffixes of ``url``, with ``host`` and ``path``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host, path = host_and_path(url)
    urls = urls.withColumns({"host": host, "path": path})
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return urls.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": F.regexp_count(path, F.lit("/")).cast("double"),
            "labels": F.regexp_count(host, F.lit(r"[^.]+")).cast("double"),
            "digits": _share(url, "[0-9]"),
            "hyphens": _share(host, "-"),
            "entropy": _entropy(url),
            "parameters": F.regexp_count(query, F.lit("[^&]+")).cast("double"),
            "site": F.regexp_extract(host, r"([^.]+)\.[^.]*\.[^.]*$", 1),
            "first_segment": F.regexp_extract(path, "^/([^/]*)", 1),
            "second_segment": F.regexp_extract(path, "^/[^/]*/([^/]*)", 1),
            "ending": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1),
        }
    )


def _shares(judged: DataFrame, name: str, mean: float) -> DataFrame:
    """``name, fold, <name>_share``: by value, of the URLs of other folds; fold -1: of all."""
    counted = judged.select(name, "fold", (F.col("verdict") == BLOCK).cast("long").alias("blocked"))
    counted = counted.where(F.col(name) != "").groupBy(name, "fold").agg(F.count("*").alias("n"), F.sum("blocked").alias("b"))
    total = counted.groupBy(name).agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    folds = F.explode(F.sequence(F.lit(-1), F.lit(FOLDS - 1))).alias("fold")
    apart = total.select(name, folds, "n", "b").join(
        counted.select(name, "fold", F.col("n").alias("own_n"), F.col("b").alias("own_b")), [name, "fold"], "left"
    )
    n, b = (F.col(c) - F.coalesce(f"own_{c}", F.lit(0)) for c in ("n", "b"))
    # smoothed by twenty URLs of the mean
    return apart.select(name, "fold", ((b + 20 * mean) / (n + 20)).alias(f"{name}_share"))


def _with_suffix_shares(rows: DataFrame, shares: dict[str, DataFrame], mean: float) -> DataFrame:
    for name, share in shares.items():
        rows = rows.join(share, [name, "fold"], "left")
    return rows.fillna(mean, [f"{name}_share" for name in shares])


def judge_urls(pages: DataFrame, rules: list[Rule], sample: int = SAMPLE) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``: one row per row.

    ``score`` is the trees' chance of ``block``; NULL where a rule decides.
    """
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    told = featured(urls).withColumn("told", _judged(rules))
    told = told.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int"))
    rows = stored(told.select("*", "told.*").drop("told"), "urls")
    judged = rows.where("verdict is not null")
    n, blocked = judged.agg(F.count("*"), F.count_if(F.col("verdict") == BLOCK)).first()
    out = ["page_id", "host", "path", "rule", "verdict", "score"]
    if not 0 < blocked < n:
        only = BLOCK if n and blocked == n else ALLOW
        score = F.when(F.col("verdict").isNull(), F.lit(float(only == BLOCK)))
        return rows.withColumns({"verdict": F.coalesce("verdict", F.lit(only)), "score": score}).select(*out)

    limit = 1_000_000 if n <= sample else int(1_000_000 * sample / n)
    chosen = judged.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < limit)
    chosen = chosen.withColumn("label", (F.col("verdict") == BLOCK).cast("double"))
    mean = blocked / n
    shares = {name: stored(_shares(judged, name, mean), f"{name}_shares") for name in untested(rules)}
    columns = [*NUMBERS, *(f"{name}_share" for name in shares)]
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    training = assembler.transform(_with_suffix_shares(chosen, shares, mean)).select("features", "label")
    training = stored(training.orderBy("label", F.hash("features")), "training")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32, cacheNodeIds=False)
    model = trees.fit(training)

    rest = rows.where("verdict is null").withColumn("fold", F.lit(-1))
    scored = model.transform(assembler.transform(_with_suffix_shares(rest, shares, mean)))
    chance = F.get(F.col("p"), F.lit(1))
    scored = scored.withColumn("p", vector_to_array("probability")).withColumn("score", chance)
    scored = scored.withColumn("verdict", F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW))
    ruled = judged.withColumn("score", F.lit(None).cast("double"))
    return ruled.select(*out).union(scored.select(*out))
