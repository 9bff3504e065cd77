"""URL filter: rules for hosts and paths, and a classifier for all other URLs.

The classifier is a logistic regression on hashed character n-grams of host and path,
fitted on a small labelled table of URLs. Everything runs in Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskline.functions.text import let
from deskline.llm.common import fresh, set_aside


class UrlRule(NamedTuple):
    """Allow or block a host, its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str


def url_host(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, with A-Z
    in lower case. Empty without ``://`` and for null."""
    host = F.regexp_extract(_after_scheme(url), r"\A([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` (host and path) and
    ``verdict``, else null. Of equally long rules the first one counts."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        inside = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = inside & F.startswith(path, F.lit(rule.path))
        value = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def url_features(host: Column, path: Column, sizes: Sequence[int] = (3, 4, 5)) -> Column:
    """Character n-grams of host and path, each marked with where it is from. Host and
    path are bounded by ``^`` and ``$``, so short ones have n-grams as well."""

    def grams(part: Column, mark: str, size: int) -> Column:
        framed = F.concat(F.lit("^"), part, F.lit("$"))
        return let(
            framed,
            lambda t: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(t) - (size - 1), F.lit(1))),
                lambda i: F.concat(F.lit(mark), F.substring(t, i, F.lit(size))),
            ),
        )

    return F.concat(*[grams(part, mark, n) for part, mark in ((host, "h"), (path, "p")) for n in sizes])


class UrlFilter(NamedTuple):
    hashing: HashingTF
    model: LogisticRegressionModel


def train_url_filter(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", features: int = 1 << 14) -> UrlFilter:
    """Fit the classifier on URLs labelled 1 (block) or 0 (allow). Rows with a null
    label teach nothing, a null URL is one without host and path."""
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=features, binary=True)
    url = F.col(url_col)
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        F.col(label_col).cast("double").alias("label"), url_features(url_host(url), url_path(url)).alias("grams")
    )
    regression = LogisticRegression(regParam=0.01, maxIter=50)
    return UrlFilter(hashing, regression.fit(hashing.transform(rows)))


def filter_urls(
    pages: DataFrame,
    trained: UrlFilter,
    rules: Sequence[UrlRule] = (),
    url_col: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the longest that fits, else null),
    ``block_score`` (the classifier's probability) and ``verdict`` (allow or block: the
    rule's, else block from ``threshold`` on).

    Only the URL is read for it, no row is moved. A null URL has an empty host and path,
    which the classifier judges. Columns of ``pages`` that have one of these names are
    kept under another: ``host`` as ``host_``.
    """
    own = pages.columns
    pages = set_aside(pages, ("host", "path", "rule", "block_score", "verdict"))
    url_col = dict(zip((c.lower() for c in own), pages.columns)).get(url_col.lower(), url_col)
    grams, features, raw, judged, scored = (fresh(pages, n) for n in ("grams", "features", "raw", "judged", "scored"))
    url = F.col(url_col)
    rows = pages.withColumns({"host": url_host(url), "path": url_path(url)})
    rows = rows.withColumns({grams: url_features(F.col("host"), F.col("path")), judged: longest_rule(F.col("host"), F.col("path"), rules)})
    hashed = trained.hashing.copy().setInputCol(grams).setOutputCol(features).transform(rows)
    model = trained.model.copy().setFeaturesCol(features).setProbabilityCol(scored).setRawPredictionCol(raw).setPredictionCol("")
    score = vector_to_array(scored)[1]
    return model.transform(hashed).select(
        *pages.columns,
        "host",
        "path",
        F.col(judged)["rule"].alias("rule"),
        score.alias("block_score"),
        F.coalesce(F.col(judged)["verdict"], F.when(score >= threshold, "block").otherwise("allow")).alias("verdict"),
    )


def seed_urls(spark: SparkSession) -> DataFrame:
    """A small labelled table to start from: hosts and paths of spam and of ordinary
    sites, combined by rule. A user's own table takes its place."""
    blocked = ["spam-farm", "cheap-pills", "casino-bonus", "free-slots", "hot-singles", "payday-loans", "replica-watches", "win-prizes"]
    allowed = ["library", "weather", "museum", "cityhall", "recipes", "astronomy", "gardening", "history"]
    ends = ["example.com", "example.net", "example.org"]
    paths = ["/en/12", "/de/481/", "/fr/77.html", "/es/905"]
    offers = ["/buy-now/12", "/bonus/481/", "/deals/77.html", "/en/905"]
    rows = [
        (f"https://{before}{name}.{end}{path}", label)
        for names, own, label in ((blocked, offers, 1), (allowed, paths, 0))
        for name, end, (before, path) in product(names, ends, zip(("", "www.", "m.", "blog."), own))
    ]
    return spark.createDataFrame(rows, "url string, blocked int")
