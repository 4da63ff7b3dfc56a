"""URL filter: rules first, then gradient-boosted trees on lexical features.

The trees are trained from labelled URLs (those that a rule decides) on
length, depth, digit ratio, entropy, parameter counts and statistics of the
host's suffix.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_rows

ALLOW, BLOCK = "allow", "block"

#: Rules that one list may hold: it is sent to every task.
MAX_RULES = 100_000

FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "host_digits", "hyphens", "longest_segment", "https")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    h = F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))
    return F.translate(h, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: str, path: str, by_host: dict[str, list[Rule]]) -> Rule | None:
    """The longest rule whose host is ``host`` or a parent domain of it and whose path starts ``path``."""
    best, tail = None, host
    while True:
        for r in by_host.get(tail, ()):
            if path.startswith(r.path) and (best is None or len(r.text) > len(best.text)):
                best = r
        _, dot, tail = tail.partition(".")
        if not dot:
            return best


def lexical(url: str, host: str, path: str) -> list[float]:
    n = len(url)
    query = url.partition("#")[0].partition("?")[2]
    segments = [s for s in path.split("/") if s]
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(url).values()) if n else 0.0
    return [float(x) for x in (n, len(host), len(path), len(segments), len([x for x in host.split(".") if x]), sum("0" <= c <= "9" for c in url) / n if n else 0.0, entropy,
                               sum(1 for p in query.split("&") if p), sum("0" <= c <= "9" for c in host), host.count("-"), max(map(len, segments), default=0), url[:8].lower() == "https://")]


def features(pages: DataFrame, rules: list[Rule], url: str = "url", page_id: str = "page_id") -> DataFrame:
    """(page_id, host, path, suffix, x, rule, decided): lexical features, and
    the longest rule that fits with its verdict (else NULL)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; a list holds {MAX_RULES} at most")

    def run(batches):
        by_host: dict[str, list[Rule]] = {}
        for r in rules:
            by_host.setdefault(r.host, []).append(r)
        for b in batches:
            x, rule, verdict = [], [], []
            for u, h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                x.append(lexical(u or "", h, p))
                r = longest_rule(h, p, by_host) if u and "://" in u else None
                rule.append(r.text if r else None), verdict.append(r.verdict if r else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), b.column(4), pa.array(x, pa.list_(pa.float64())), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=["page_id", "host", "path", "suffix", "x", "rule", "decided"])
    u = F.col(f"`{url}`").cast("string")
    src = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), u.alias("url"), host_of(u).alias("host"), path_of(u).alias("path"))
    src = src.withColumn("suffix", F.substring_index("host", ".", -1))
    return map_rows(src, run, "page_id long, host string, path string, suffix string, x array<double>, rule string, decided string")


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", page_id: str = "page_id", max_labelled: int = 20_000, trees: int = 20, depth: int = 4, seed: int = 42) -> DataFrame:
    """(page_id, host, path, rule, verdict, p_block): one row per page.

    A rule's verdict stands; other URLs get the trees' (block from p_block 0.5
    on). Trees are fitted on about ``max_labelled`` labelled URLs at most, up to half of them
    of each verdict (those with the smallest hashes), weighted back to the verdicts'
    numbers, so a rare verdict is never lost; suffix counts and blocked shares cover all rows. NULL
    URLs and URLs without ``://`` have empty host and path and fit no rule.
    Without labelled URLs of both kinds nothing is blocked but by rule. Repeated
    rows are judged one by one; only id and url are read.
    """
    rows = cut(features(pages, rules, url, page_id), "urls")
    blocked, labelled = F.col("decided") == BLOCK, F.col("decided").isNotNull()
    stats = (rows.groupBy("suffix").agg(F.count("*").alias("n"), F.sum(F.when(blocked, 1).otherwise(0)).alias("blocked"))
             .select(F.col("suffix").alias("_s"), F.log1p("n").alias("seen"), ((F.col("blocked") + 1) / (F.col("n") + 2)).alias("blocked_share")))
    parts, hashed = 1_000_000, F.xxhash64("page_id", "host", "path")
    size = {r["decided"]: r for r in rows.where(labelled).groupBy("decided").agg(F.count("*").alias("n"), F.min(hashed).alias("least")).collect()}     # a row per verdict
    every = rows.join(stats, F.col("suffix") == F.col("_s")).withColumn("features", array_to_vector(F.concat("x", F.array("seen", "blocked_share"))))
    if len(size) < 2:
        return every.select("page_id", "host", "path", "rule", F.coalesce("decided", F.lit(ALLOW)).alias("verdict"), F.lit(0.0).alias("p_block"))
    within = F.lit(False)
    for verdict, r in size.items():              # the smallest hash stays at any rate
        rate = min(parts, parts * max_labelled // (2 * r["n"]))
        within = within | ((F.col("decided") == verdict) & ((F.pmod(hashed, F.lit(parts)) < rate) | (hashed == r["least"])))
    sample = cut(every.where(labelled & within).select("features", F.when(blocked, 1.0).otherwise(0.0).alias("label")), "labelled-urls")
    taken = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    scale = sum(taken.values()) / sum(r["n"] for r in size.values())
    weight = {label: size[verdict]["n"] / taken[label] * scale for verdict, label in ((BLOCK, 1.0), (ALLOW, 0.0))}
    sample = sample.withColumn("weight", F.when(F.col("label") == 1.0, weight[1.0]).otherwise(weight[0.0])).repartition(4)
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, weightCol="weight").fit(sample)
    p = F.element_at(vector_to_array(F.col("probability")), 2)
    told = model.transform(every).withColumn("p_block", p)
    verdict = F.coalesce("decided", F.when(F.col("p_block") >= 0.5, BLOCK).otherwise(ALLOW))
    return told.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")
