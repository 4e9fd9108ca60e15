"""Operator 4, URL filter: rules first, then gradient-boosted trees on lexical features of the URL.

Features: length, depth, digit ratio, character entropy, parameters, hyphens, host labels, longest label, file suffix,
and the suffix statistics: how often labelled URLs of the same host ending are blocked (smoothed to the overall rate;
counted over all labelled URLs by an aggregation). The trees are trained on a bounded sample of each class of the URLs
that a rule labels, weighted to the class's size; they give the verdict where no rule fits.

Rules are pairs of host ending and path start; the longest rule that fits wins. They are a short list and become one
expression.

Defined results: a null URL, or one without "://", has an empty host and path, fits no rule, and is judged by its
features; repeated rows get equal verdicts; with labels of one class only (or none) the method gives that class (or
allow); an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.llm.storage import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The contract's rules: host and path, and the verdict.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block"))
LEXICAL = ("length", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "labels", "longest_label", "dotted")
#: Labelled URLs of each class that the trees are trained on, about; smoothing of the suffix statistics, in URLs.
MAX_ROWS = 20_000
SMOOTHING = 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without "://"."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def first_fitting(rules=RULES) -> Column:
    """The longest rule that fits ``host`` and ``path``, or null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        end, _, start = rule.partition("/")
        fits = ((F.col("host") == end) | F.col("host").endswith("." + end)) & F.col("path").startswith("/" + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _measures(url: str, host: str) -> tuple:
    rest = url.split("://", 1)[-1]
    path = rest.split("?", 1)[0].split("#", 1)[0]
    query = rest.split("?", 1)[1].split("#", 1)[0] if "?" in rest else ""
    counts, n = Counter(url), max(len(url), 1)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    labels = host.split(".")
    return (len(url), path.count("/"), sum(c.isdigit() for c in url) / n, entropy,
            query.count("&") + 1 if query else 0, host.count("-"), len(labels), max(map(len, labels)),
            int("." in path.rsplit("/", 1)[-1]) if "/" in path else 0)


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` (with ``host``) with the lexical features of each URL."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [_measures(u or "", h) for u, h in zip(frame["_text"], frame["host"])]
            found = pd.DataFrame(rows, columns=list(LEXICAL), dtype="float64")
            yield pd.concat([frame.reset_index(drop=True), found], axis=1)

    held = df.withColumn("_text", F.coalesce(url, F.lit("")))
    schema = T.StructType([*held.schema.fields, *(T.StructField(name, T.DoubleType()) for name in LEXICAL)])
    return held.mapInPandas(run, schema).drop("_text")


def judge(pages: DataFrame, id_col: str = "page_id", url: str = "url", rules=RULES, max_rows: int = MAX_ROWS,
          trees: int = 12, depth: int = 3) -> DataFrame:
    """Per row of ``pages``: id, host, path, rule, verdict, and the trees' probability of block (null if there were
    labels of one class only)."""
    host, path = host_and_path(F.col(url))
    seen = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    said = dict(rules)
    by_rule = F.lit(None).cast("string")
    for rule, verdict in said.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    seen = seen.withColumn("rule", first_fitting(rules)).withColumn("by_rule", by_rule)
    seen = seen.withColumn("ending", F.substring_index("host", ".", -1))
    blocked = (F.col("by_rule") == "block").cast("double")
    place = F.pmod(F.xxhash64("page_id", "url"), F.lit(2**31))
    endings = stored(seen.where("by_rule is not null").groupBy("ending").agg(
        F.count("*").alias("seen"), F.sum(blocked).alias("blocked"),
        F.min(F.when(blocked == 0, place)).alias("first_allowed"), F.min(F.when(blocked == 1, place)).alias("first_blocked")),
        "endings")
    total = endings.agg(F.coalesce(F.sum("seen"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0.0)),
                        F.min("first_allowed"), F.min("first_blocked")).first()
    n, bad = int(total[0]), float(total[1])
    if bad in (0.0, float(n)):
        only = "block" if n and bad else "allow"
        return seen.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.lit(only)).alias("verdict"),
                           F.lit(None).cast("double").alias("p_block"))
    rate = bad / n
    ending_rate = (F.coalesce("blocked", F.lit(0.0)) + SMOOTHING * rate) / (F.coalesce("seen", F.lit(0)) + SMOOTHING)
    known = lexical(seen).join(endings.select("ending", "seen", "blocked"), "ending", "left").withColumn("ending_rate", ending_rate)
    vector = VectorAssembler(inputCols=[*LEXICAL, "ending_rate"], outputCol="features")
    # Of each class, what lies below its bound, the first URL in any case.
    shares = [min(1.0, max_rows / (n - bad)), min(1.0, max_rows / bad)]
    bounds = [max(int(x * 2**31), first + 1) for x, first in zip(shares, total[2:])]
    of_class = lambda values: F.when(blocked == 1, F.lit(values[1])).otherwise(F.lit(values[0]))
    sample = known.where("by_rule is not null").where(place < of_class(bounds)).withColumn("label", blocked).withColumn(
        "weight", of_class([1 / x for x in shares]))
    sample = stored(vector.transform(sample.select("label", "weight", *LEXICAL, "ending_rate")).select(
        "label", "weight", "features"), "train")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=11, maxBins=32, weightCol="weight").fit(
        sample.coalesce(1))
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(vector.transform(known)).withColumn("p_block", vector_to_array("probability")[1])
    return scored.select("page_id", "host", "path", "rule", F.coalesce(
        "by_rule", F.when(F.col("p_block") > 0.5, "block").otherwise("allow")).alias("verdict"), "p_block")
