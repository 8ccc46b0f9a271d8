"""Trend and price analytics over records and articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pageloom.operators.scans import HOUR, lag_by_time, same_keys
from pageloom.session import new_folder

# Price bands (upper bounds, exclusive) and discount bands.
PRICE_BANDS = [
    (400, "<399"), (700, "400-699"), (1000, "700-999"), (1500, "1000-1499"), (2500, "1500-2499"), (5000, "2500-4999"),
]
TOP_PRICE_BAND = "5000+"
DISCOUNT_BANDS = [(20, "<20"), (35, "20-35"), (50, "35-50")]
TOP_DISCOUNT_BAND = ">50"


def band(value: Column, bands: Sequence[tuple[int, str]], top: str) -> Column:
    label = F.lit(top)
    for bound, name in reversed(bands):
        label = F.when(value < bound, name).otherwise(label)
    return F.when(value.isNotNull(), label)


def snapshots(df: DataFrame, order: Sequence[str] = ("scraped_at",), chunk_s: int = 30 * 24 * HOUR) -> DataFrame:
    """Price change of each product and site against its previous snapshot."""
    lagged = lag_by_time(df, ["product_id", "site"], list(order), "price", order[0], "prev_price", chunk_s)
    return lagged.withColumn("price_change", F.col("price") - F.col("prev_price"))


def price_bands(df: DataFrame, by: Sequence[str], price: str = "selling_price") -> DataFrame:
    return df.groupBy(*by, band(F.col(price), PRICE_BANDS, TOP_PRICE_BAND).alias("band")).agg(F.count("*").alias("n"))


def price_band_table(df: DataFrame, by: Sequence[str], price: str = "selling_price") -> DataFrame:
    """The same counts with one column for each band."""
    names = [name for _, name in PRICE_BANDS] + [TOP_PRICE_BAND]
    label = band(F.col(price), PRICE_BANDS, TOP_PRICE_BAND)
    return df.groupBy(*by).agg(*[F.count_if(label == n).alias(n) for n in names])


def discount_bands(df: DataFrame, by: Sequence[str], pct: str = "discount_percentage") -> DataFrame:
    label = band(F.col(pct), DISCOUNT_BANDS, TOP_DISCOUNT_BAND)
    names = [name for _, name in DISCOUNT_BANDS] + [TOP_DISCOUNT_BAND]
    return df.groupBy(*by).agg(
        F.avg(pct).alias("avg_discount"), *[F.count_if(label == n).alias(f"n_{i}") for i, n in enumerate(names)]
    )


def month_index(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def brand_growth(df: DataFrame, brand: str = "brand", product: str = "product_id", ts: str = "scraped_at") -> DataFrame:
    """Distinct SKUs of a brand by month and growth % over the month before (NULL if that month is absent)."""
    monthly = (
        df.select(brand, product, month_index(F.col(ts)).alias("month")).distinct()
        .groupBy(brand, "month").agg(F.count("*").alias("skus"))
    )
    before = monthly.select(brand, (F.col("month") + 1).alias("month"), F.col("skus").alias("prev_skus"))
    growth = F.try_divide((F.col("skus") - F.col("prev_skus")) * F.lit(100.0), F.col("prev_skus"))
    return same_keys(monthly, before, [brand, "month"], "left").withColumn("growth_pct", growth)


def size_gap(supply: DataFrame, demand: DataFrame, category: str = "category", size: str = "size") -> DataFrame:
    """Supply share of a size in its category against its demand index."""
    counts = supply.groupBy(category, size).agg(F.count("*").alias("skus"))
    totals = counts.groupBy(category).agg(F.sum("skus").alias("total"))
    share = F.col("skus") / F.col("total")
    return (
        same_keys(same_keys(counts, totals, [category]), demand, [size], "left")
        .select(category, size, "skus", share.alias("supply_share"), "demand_index",
                (F.col("demand_index") - share).alias("gap"))
    )


def tokens(text: Column) -> Column:
    """Lower-cased ASCII word tokens."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+)"), F.lit(1))


def mentions(df: DataFrame, text: str, vocab: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row for each document and single-word vocabulary term in it."""
    found = F.array_intersect(tokens(F.col(text)), F.array(*[F.lit(w.lower()) for w in vocab]))
    return df.select(*keep, F.explode(found).alias("term"))


def phrase_table(vocab: DataFrame, term: str = "term") -> DataFrame:
    """term, the number of its words, its words in lower case and their hash, one row for each term with a word."""
    words = tokens(F.col(term))
    rows = vocab.select(F.col(term).alias("term"), F.size(words).alias("n_words"), F.array_join(words, " ").alias("phrase")).filter("n_words > 0").distinct()
    return rows.withColumn("h", F.xxhash64("phrase"))


def vocabulary_mentions(df: DataFrame, text: str, vocab: DataFrame, keep: Sequence[str], term: str = "term") -> DataFrame:
    """One row for each row of `df` and term of the vocabulary table that stands in its text, as whole words in sequence.

    A text's word runs, of the lengths that terms have, are hashed inside its row and met with the hashed terms in one join, then compared. So the work
    follows the texts and the lengths, of which there are few, and not the number of terms; a vocabulary below Spark's broadcast limit leaves texts where they are.
    The hashed terms are written first, so that Spark plans the join by their size in files: of a vocabulary made in the session it knows none and takes it for huge.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, "phrases")
    phrase_table(vocab, term).write.parquet(path)
    phrases = spark.read.schema("term string, n_words int, phrase string, h bigint").parquet(path)
    lengths = sorted(r[0] for r in phrases.select("n_words").distinct().collect())
    words = F.col("__w")

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        found = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.array_distinct(F.when(F.size(words) >= n, found).otherwise(F.array().cast("array<string>")))

    found = F.concat(*[runs(n) for n in lengths]) if lengths else F.array().cast("array<string>")
    rows = df.select(*keep, tokens(F.col(text)).alias("__w")).select(*keep, F.explode(found).alias("__run"))
    hit = (F.xxhash64("__run") == F.col("h")) & (F.col("__run") == F.col("phrase"))
    return rows.join(phrases, hit).select(*keep, "term")


def week_of(ts: Column) -> Column:
    return F.date_trunc("week", ts)


def keyword_weeks(df: DataFrame, term: str = "term", ts: str = "ts") -> DataFrame:
    """Weekly counts of each term."""
    return df.groupBy(term, week_of(F.col(ts)).alias("week")).agg(F.count("*").alias("n"))


def keyword_peaks(weekly: DataFrame, now: Column, term: str = "term") -> DataFrame:
    """Peak week of each term (the earliest of equals) and its age in weeks at `now`."""
    peak = weekly.groupBy(term).agg(
        F.sum("n").alias("total"),
        F.min_by("week", F.struct((-F.col("n")).alias("a"), F.col("week").alias("b"))).alias("peak_week"),
    )
    days = F.datediff(week_of(now), F.col("peak_week"))
    return peak.withColumn("lag_weeks", F.floor(days / 7).cast("int"))


def heatmap(articles: DataFrame, products: DataFrame, on: Sequence[str]) -> DataFrame:
    """Articles and SKUs for each trend and platform, with their ratio."""
    keys = list(on)
    a = articles.groupBy(*keys).agg(F.count("*").alias("articles"))
    p = products.groupBy(*keys).agg(F.count("*").alias("skus"))
    zero = F.lit(0)
    return a.join(p, keys, "full_outer").select(
        *keys, F.coalesce("articles", zero).cast("bigint").alias("articles"),
        F.coalesce("skus", zero).cast("bigint").alias("skus"),
        F.try_divide(F.coalesce("articles", zero).cast("double"), F.col("skus").cast("double")).alias("ratio"),
    )


def period_delta(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Counts by period and the change from the period before; absent periods count zero."""
    counts = df.groupBy(*keys, period).agg(F.count("*").alias("n"))
    before = counts.select(*keys, (F.col(period) + 1).alias(period), F.col("n").alias("prev"))
    return same_keys(counts, before, [*keys, period], "left").select(
        *keys, period, "n", F.coalesce("prev", F.lit(0)).cast("bigint").alias("prev"),
        (F.col("n") - F.coalesce("prev", F.lit(0))).alias("delta"),
    )


def headline_ngrams(df: DataFrame, text: str, lo: int = 2, hi: int = 4, keep: Sequence[str] = ()) -> DataFrame:
    """Word n-grams as rows; made inside the row, so only counts are shuffled."""
    words = F.col("__w")

    def grams(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        found = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, found).otherwise(F.array().cast("array<string>"))

    return df.select(*keep, tokens(F.col(text)).alias("__w")).select(*keep, F.explode(F.concat(*[grams(n) for n in range(lo, hi + 1)])).alias("ngram"))


def lag_corr(a: DataFrame, b: DataFrame, key: str, step: str, value: str = "n", max_lag: int = 8) -> DataFrame:
    """Correlation of a(t) with b(t + lag) for lags 0..max_lag; `step` is a whole-number time index."""
    shifted = a.select(
        key, F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"), F.col(step).alias("__t"), F.col(value).alias("__a")
    ).withColumn(step, F.col("__t") + F.col("lag"))
    pairs = shifted.join(b.select(key, step, F.col(value).alias("__b")), [key, step])
    return pairs.groupBy(key, "lag").agg(
        F.corr(F.col("__a").cast("double"), F.col("__b").cast("double")).alias("corr"), F.count("*").alias("n_pairs")
    )


def repricing_corr(prices: DataFrame, pairs: DataFrame, max_lag: int = 8, site: str = "site", category: str = "category",
                   step: str = "step", value: str = "avg_price") -> DataFrame:
    """Cross-correlation of average-price changes of a leading and a following site, by category.

    `prices` has one average for each (category, site, step); `pairs` (leader,
    follower) names the site pairs to look at.
    """
    w = W.partitionBy(category, site).orderBy(step)
    deltas = prices.withColumn("d", F.col(value) - F.lag(value).over(w)).filter(F.col("d").isNotNull())
    lead = deltas.select(category, F.col(site).alias("leader"), F.col("d").alias("x"), F.col(step).alias("__t"),
                         F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag")).join(pairs, "leader")
    lead = lead.withColumn(step, F.col("__t") + F.col("lag"))
    follow = deltas.select(category, F.col(site).alias("follower"), F.col("d").alias("y"), step)
    return (
        lead.join(follow, [category, "follower", step])
        .groupBy(category, "leader", "follower", "lag")
        .agg(F.corr("x", "y").alias("corr"), F.count("*").alias("n_pairs"))
    )


def monthly_report(parts: dict[str, DataFrame]) -> DataFrame:
    """One JSON row for each section row. Sections are small aggregates; they stay distributed."""
    result = None
    for name, df in parts.items():
        rows = df.select(F.lit(name).alias("section"), F.to_json(F.struct(*df.columns)).alias("body"))
        result = rows if result is None else result.unionByName(rows)
    return result
