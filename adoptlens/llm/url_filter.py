"""Operator 6, URL filters, in DataFrame functions and Spark's own gradient-boosted trees.

Rules judge the urls they fit; they also label the urls that the trees learn from. Urls that
no rule fits get the trees' verdict from lexical features: length, depth, digit ratio,
entropy, parameter counts and statistics of the host's suffix.

The trees learn from at most ``sample`` labelled urls (those with the smallest hash). A null
url or one without ``://`` has an empty host and path and is judged by the trees; every row is
judged by itself, repeated rows and null ids too; without labelled urls the verdict is allow,
with labels of one kind it is that kind; an empty table gives no rows.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptlens.llm.tables import stored


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case A-Z, and path up to the query; empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
    return host & F.startswith(F.col("path"), F.lit(rule.path))


def with_rule(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, url, host, path, and the longest rule that fits with its verdict."""
    host, path = host_and_path(F.col("url"))
    out = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        rule = F.when(_fits(r), F.lit(r.host + r.path)).otherwise(rule)
        verdict = F.when(_fits(r), F.lit(r.verdict)).otherwise(verdict)
    return out.withColumns({"rule": rule, "rule_verdict": verdict})


def _share(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    signs = F.array_remove(F.array_distinct(F.split(text, "")), "")

    def add(total, sign):
        p = (size - F.length(F.replace(text, sign, F.lit("")))) / size
        return total - p * F.log2(p)

    return F.aggregate(signs, F.lit(0.0), add)


LEXICAL = ["url_length", "host_length", "path_length", "depth", "host_depth", "digit_ratio", "sign_ratio", "entropy", "n_params", "has_fragment", "closes_with_slash", "hyphens", "secure"]
SUFFIX = ["suffix_rate", "suffix_known"]


def with_features(urls: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    count = lambda text, sign: F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))
    return urls.withColumns({
        "suffix": F.substring_index("host", ".", -1),
        "url_length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": count(F.col("path"), "/"), "host_depth": count(F.col("host"), "."),
        "digit_ratio": _share(url, "[^0-9]"), "sign_ratio": _share(url, "[A-Za-z0-9]"), "entropy": _entropy(url),
        "n_params": F.when(F.contains(url, F.lit("?")), 1 + count(url, "&")).otherwise(0),
        "has_fragment": F.contains(url, F.lit("#")).cast("int"), "closes_with_slash": F.endswith("path", F.lit("/")).cast("int"),
        "hyphens": count(F.col("host"), "-"), "secure": F.startswith(url, F.lit("https")).cast("int"),
    })


def judge(pages: DataFrame, rules: list[Rule], sample: int = 20_000, trees: int = 12, depth: int = 4) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' ``block_probability``."""
    urls = with_features(with_rule(pages, rules))
    labelled = urls.where("rule_verdict is not null").withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    order = F.xxhash64("page_id", "url")
    known = stored(labelled.orderBy(order, "page_id", "url").limit(sample).coalesce(2), "labelled-urls")
    found = known.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    verdict, unruled = F.col("rule_verdict"), urls
    if not found.n or found.blocked in (0, found.n):
        constant = "block" if found.n and found.blocked else "allow"
        probability = F.lit(1.0 if constant == "block" else 0.0)
        return unruled.select("page_id", "host", "path", "rule", F.coalesce(verdict, F.lit(constant)).alias("verdict"), probability.alias("block_probability"))

    prior = found.blocked / found.n
    # at most ``sample`` suffixes; smoothed towards the share over all
    rates = known.groupBy("suffix").agg(((F.sum("label") + 5 * prior) / (F.count("*") + 5)).alias("rate"))

    def complete(frame: DataFrame) -> DataFrame:
        frame = frame.join(F.broadcast(rates), "suffix", "left")
        frame = frame.withColumns({"suffix_rate": F.coalesce("rate", F.lit(prior)), "suffix_known": F.col("rate").isNotNull().cast("int")})
        return VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="features").transform(frame)

    model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, seed=6, cacheNodeIds=False).fit(complete(known))
    judged = model.transform(complete(urls)).withColumn("block_probability", vector_to_array("probability")[1])
    by_trees = F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce(verdict, by_trees).alias("verdict"), "block_probability")
