"""URL filters: an ordered rule list, then a logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pageloom.llm.base import quoted, written
from pageloom.llm.urltable import rows

# (host and path, verdict)
RULES = (
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
)

# The labelled table: 1 stands for addresses of advertising, spam and adult sites, 0 for ordinary ones. The model never learns from those held out.
LABELLED_URLS, HELD_OUT_URLS = rows(out=False), rows(out=True)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where the url is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the last one wins, so the longest comes last
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _featured(df: DataFrame, sizes: tuple[int, ...], buckets: int) -> DataFrame:
    """Adds `_grams`: the buckets of all character n-grams of `^host$` and `^path$`, with repeats.

    Both texts are cut into characters once, in columns of their own, so the work grows with the url's length.
    """

    def grams(chars: str, n: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(chars) - n, F.lit(0))),
            lambda i: F.pmod(F.xxhash64(F.lit(chars), *(F.get(F.col(chars), i + k) for k in range(n))), F.lit(buckets)).cast("int"),
        )

    marked = df.withColumns({c: F.split(F.concat(F.lit("^"), F.col(of), F.lit("$")), "") for c, of in (("_h", "_host"), ("_p", "_path"))})
    return marked.withColumn("_grams", F.concat(*(grams(c, n) for c in ("_h", "_p") for n in sizes))).drop("_h", "_p")


@dataclass(frozen=True)
class UrlModel:
    weights: tuple[float, ...]
    intercept: float
    sizes: tuple[int, ...]

    @property
    def buckets(self) -> int:
        return len(self.weights)

    def log_odds(self) -> Column:
        """Over `_grams`: sum of the weights of all n-grams, repeats included, as the model was trained."""
        weights = F.array(*(F.lit(w) for w in self.weights))
        return F.aggregate("_grams", F.lit(self.intercept), lambda acc, g: acc + F.get(weights, g))


def train(
    spark: SparkSession, labelled: DataFrame | None = None, sizes: tuple[int, ...] = (3, 4), buckets: int = 2048,
    max_rows: int = 10_000, reg: float = 0.001, iterations: int = 30,
) -> UrlModel:
    """Fit on a small table (url, label); at most `max_rows` rows of it, the first by url.

    The features are counts of n-grams by bucket, which are hashed with SQL expressions.
    """
    if labelled is None:
        labelled = spark.createDataFrame(list(LABELLED_URLS), "url string, label int")
    host, path = host_and_path(F.col("url"))
    table = labelled.filter("url is not null and label is not null").select("url", "label").orderBy("url", "label").limit(max_rows)
    table = _featured(table.select(F.col("label").cast("double").alias("label"), host.alias("_host"), path.alias("_path")), sizes, buckets)
    counter = CountVectorizerModel.from_vocabulary([str(b) for b in range(buckets)], inputCol="grams", outputCol="features")
    counts = counter.transform(table.select("label", F.col("_grams").cast("array<string>").alias("grams")))
    vectors = written(counts.select("label", "features").coalesce(1), "url-features")
    fitted = LogisticRegression(maxIter=iterations, regParam=reg, standardization=False).fit(vectors)
    return UrlModel(tuple(float(w) for w in fitted.coefficients.toArray()), float(fitted.intercept), sizes)


def url_filter(
    pages: DataFrame, model: UrlModel, rules: tuple[tuple[str, str], ...] = RULES, threshold: float = 0.75
) -> DataFrame:
    """One row for each page: page_id, host, path, rule, score (probability of unwanted), verdict.

    A fitting rule decides; else the model blocks from `threshold` on: of the steps of 0.05 the one with the best F0.5 on the held-out
    urls, where precision weighs more than recall, as a wrong block loses a page. Null urls and urls without `://` have empty host and path, fit no rule and are allowed with score 0. Very long urls take time in proportion to their length.
    Repeated rows are judged each for itself; columns other than page_id and url are ignored.
    """
    host, path = host_and_path(F.col("_url"))
    rows = pages.select(F.col(quoted("page_id")).alias("page_id"), F.col(quoted("url")).cast("string").alias("_url"))
    rows = _featured(rows.select("page_id", host.alias("_host"), path.alias("_path")), model.sizes, model.buckets)
    rule, says = matching_rule(F.col("_host"), F.col("_path"), rules)
    score = F.when((F.col("_host") == "") & (F.col("_path") == ""), F.lit(0.0)).otherwise(1 / (1 + F.exp(-model.log_odds())))
    judged = rows.select("page_id", "_host", "_path", rule.alias("rule"), says.alias("_says"), score.alias("score"))
    return judged.select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), "rule", "score",
        F.coalesce("_says", F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
