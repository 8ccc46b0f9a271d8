"""Price and trend analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import PRODUCTS_SQL, products, query
from pageloom.operators import trends as TR

SNAP_SQL = f"""
{PRODUCTS_SQL},
snaps AS (SELECT product_id, site, scraped_at, CAST(min(selling_price) AS DOUBLE) AS price FROM products GROUP BY 1, 2, 3)
"""


def snaps(t):
    return products(t).groupBy("product_id", "site", "scraped_at").agg(F.min("selling_price").cast("double").alias("price"))


@query("price_snapshots", f"""
WITH {SNAP_SQL}, l AS (SELECT *, lag(price) OVER (PARTITION BY product_id, site ORDER BY scraped_at) AS prev_price FROM snaps)
SELECT product_id, site, scraped_at, price, prev_price, round(price - prev_price, 2) AS price_change FROM l""")
def price_snapshots(t):
    return TR.snapshots(snaps(t)).withColumn("price_change", F.round("price_change", 2))


_BAND = "CASE WHEN p < 400 THEN '<399' WHEN p < 700 THEN '400-699' WHEN p < 1000 THEN '700-999' WHEN p < 1500 THEN '1000-1499' WHEN p < 2500 THEN '1500-2499' WHEN p < 5000 THEN '2500-4999' ELSE '5000+' END"


def _priced_parts(t):
    return t.part.select(F.col("p_brand").alias("platform"), F.col("p_type").alias("category"), (F.col("p_size") * 100 + F.col("p_retailprice") / 10).alias("selling_price"))


_PARTS_SQL = "parts AS (SELECT p_brand AS platform, p_type AS category, p_size * 100 + p_retailprice / 10 AS p FROM part)"


@query("price_bands", f"WITH {_PARTS_SQL} SELECT platform, category, {_BAND} AS band, count(*) AS n FROM parts GROUP BY ALL")
def price_bands(t):
    return TR.price_bands(_priced_parts(t), ["platform", "category"])


@query("price_band_table", f"WITH {_PARTS_SQL} SELECT category, " + ", ".join(
    f"count(*) FILTER (WHERE {_BAND} = '{b}') AS \"{b}\"" for b in ["<399", "400-699", "700-999", "1000-1499", "1500-2499", "2500-4999", "5000+"]
) + " FROM parts GROUP BY category")
def price_band_table(t):
    return TR.price_band_table(_priced_parts(t), ["category"])


@query("discount_bands", """
WITH d AS (SELECT l_suppkey AS site, l_returnflag AS category, CAST(round(l_discount * 1000) AS INTEGER) AS pct FROM lineitem)
SELECT site, category, avg(pct) AS avg_discount, count(*) FILTER (WHERE pct < 20) AS n_0, count(*) FILTER (WHERE pct >= 20 AND pct < 35) AS n_1,
  count(*) FILTER (WHERE pct >= 35 AND pct < 50) AS n_2, count(*) FILTER (WHERE pct >= 50) AS n_3 FROM d GROUP BY 1, 2""")
def discount_bands(t):
    rows = t.lineitem.select(F.col("l_suppkey").alias("site"), F.col("l_returnflag").alias("category"), F.round(F.col("l_discount") * 1000).cast("int").alias("discount_percentage"))
    return TR.discount_bands(rows, ["site", "category"])


@query("brand_growth", """
WITH m AS (SELECT CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand, year(l_shipdate) * 12 + month(l_shipdate) AS month, count(DISTINCT l_partkey) AS skus FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT a.brand, a.month, a.skus, b.skus AS prev_skus, round((a.skus - b.skus) * 100.0::DOUBLE / b.skus, 6) AS growth_pct
FROM m a LEFT JOIN m b ON b.brand IS NOT DISTINCT FROM a.brand AND b.month = a.month - 1""")
def brand_growth(t):
    """A seventh of the products has no brand."""
    parts = t.part.select(F.col("p_partkey").alias("product_id"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).alias("brand"))
    rows = products(t).select("product_id", "scraped_at").join(parts, "product_id")
    out = TR.brand_growth(rows)
    return out.withColumns({"month": F.col("month").cast("bigint"), "growth_pct": F.round(F.col("growth_pct").cast("double"), 6)})


@query("size_gap", """
WITH p AS (SELECT CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS category, CASE WHEN p_size <> 20 THEN p_size END AS size, p_retailprice FROM part),
c AS (SELECT category, size, count(*) AS skus FROM p GROUP BY 1, 2), tot AS (SELECT category, sum(skus) AS total FROM c GROUP BY 1),
d AS (SELECT size, avg(p_retailprice) / 1000 AS demand_index FROM p GROUP BY 1)
SELECT c.category, c.size, skus, round(skus / total::DOUBLE, 6) AS supply_share, round(demand_index, 6) AS demand_index, round(demand_index - skus / total::DOUBLE, 6) AS gap
FROM c JOIN tot ON tot.category IS NOT DISTINCT FROM c.category LEFT JOIN d ON d.size IS NOT DISTINCT FROM c.size""")
def size_gap(t):
    """Some products have no category, some no size."""
    supply = t.part.select(
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("category"), F.when(F.col("p_size") != 20, F.col("p_size")).alias("size"), "p_retailprice")
    demand = supply.groupBy("size").agg((F.avg("p_retailprice") / 1000).alias("demand_index"))
    out = TR.size_gap(supply, demand)
    return out.withColumns({c: F.round(c, 6) for c in ("supply_share", "demand_index", "gap")})


# ---- keywords: documents dated by their length ------------------------------------------------

VOCAB = ["the", "and", "que", "und", "les", "para", "with", "that", "not"]
_DATED = "dated AS (SELECT doc_id, source, lang, text, TIMESTAMP '2024-01-01' + to_days(CAST(least(n_chars // 25, 200) AS INTEGER)) AS ts FROM documents)"
_TOK = "regexp_extract_all(lower(text), '([a-z0-9]+)', 1)"
_TERMS = f"{_DATED}, terms AS (SELECT doc_id, source, lang, ts, term FROM (SELECT doc_id, source, lang, ts, unnest(list_distinct({_TOK})) AS term FROM dated) WHERE term IN ({', '.join(repr(v) for v in VOCAB)}))"


def dated(t):
    days = F.least(F.floor(F.col("n_chars") / 25), F.lit(200)).cast("int")
    return t.spread("documents").select("doc_id", "source", "lang", "text", (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days)).alias("ts"))


def terms(t):
    return TR.mentions(dated(t), "text", VOCAB, ["doc_id", "source", "lang", "ts"])


@query("keyword_weeks", f"WITH {_TERMS} SELECT term, CAST(date_trunc('week', ts) AS TIMESTAMP) AS week, count(*) AS n FROM terms GROUP BY 1, 2")
def keyword_weeks(t):
    return TR.keyword_weeks(terms(t)).withColumn("week", F.col("week").cast("timestamp_ntz"))


@query("keyword_peaks", f"""
WITH {_TERMS}, w AS (SELECT term, date_trunc('week', ts) AS week, count(*) AS n FROM terms GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY n DESC, week) AS rn, sum(n) OVER (PARTITION BY term) AS total FROM w)
SELECT term, CAST(total AS BIGINT) AS total, CAST(week AS TIMESTAMP) AS peak_week, CAST(date_diff('day', week, DATE '2024-09-02') // 7 AS INTEGER) AS lag_weeks FROM r WHERE rn = 1""")
def keyword_peaks(t):
    out = TR.keyword_peaks(TR.keyword_weeks(terms(t)), F.lit("2024-09-04 00:00:00").cast("timestamp_ntz"))
    return out.withColumn("peak_week", F.col("peak_week").cast("timestamp_ntz"))


_VOCAB_SQL = f"""
words AS (SELECT item_id, {_TOK} AS w FROM benchmark),
vocab AS (
  SELECT DISTINCT array_to_string(w[1:n], ' ') AS term, n FROM (SELECT w, unnest([1, 2, 3, 5]) AS n FROM words) WHERE len(w) >= n
  UNION SELECT 'of the', 2 UNION SELECT 'de la', 2),
padded AS (SELECT doc_id, lang, TIMESTAMP '2024-01-01' + to_days(CAST(least(n_chars // 25, 200) AS INTEGER)) AS ts, ' ' || array_to_string({_TOK}, ' ') || ' ' AS padded FROM documents),
hits AS (SELECT doc_id, nullif(lang, 'de') AS lang, ts, term FROM padded, vocab WHERE contains(padded, ' ' || term || ' '))
"""


def vocabulary(t):
    """The first one, two, three and five words of each benchmark item, and two common phrases, as a table."""
    words = F.col("w")
    heads = t.benchmark.select(TR.tokens(F.col("text")).alias("w")).select(
        "w", F.explode(F.array(*[F.lit(n) for n in (1, 2, 3, 5)])).alias("n")).filter(F.size("w") >= F.col("n")).select(
        F.initcap(F.array_join(F.slice(words, F.lit(1), F.col("n")), " ")).alias("term"))
    return heads.unionByName(t.spark.createDataFrame([("of the",), ("de la",)], "term string"))


@query("phrase_mentions", f"WITH {_VOCAB_SQL} SELECT doc_id, term FROM hits")
def phrase_mentions(t):
    """Phrases of a table in whole texts."""
    hits = TR.vocabulary_mentions(t.spread("documents", "doc_id", "text"), "text", vocabulary(t), ["doc_id"])
    return hits.select("doc_id", F.lower("term").alias("term"))


@query("vocab_delta_phrases", f"""
WITH {_VOCAB_SQL}, m AS (SELECT term, lang, year(ts) * 12 + month(ts) AS month, count(*) AS n FROM hits GROUP BY 1, 2, 3)
SELECT a.term, a.lang, a.month, a.n, coalesce(b.n, 0) AS prev, a.n - coalesce(b.n, 0) AS delta
FROM m a LEFT JOIN m b ON b.term = a.term AND b.lang IS NOT DISTINCT FROM a.lang AND b.month = a.month - 1""")
def vocab_delta_phrases(t):
    """Monthly counts of phrases by language, one of which is unknown."""
    docs = dated(t).withColumn("lang", F.nullif(F.col("lang"), F.lit("de")))
    hits = TR.vocabulary_mentions(docs, "text", vocabulary(t), ["doc_id", "lang", "ts"])
    rows = hits.select(F.lower("term").alias("term"), "lang", TR.month_index(F.col("ts")).cast("bigint").alias("month"))
    return TR.period_delta(rows, ["term", "lang"], "month")


@query("trend_heatmap", f"""
WITH {_TERMS}, a AS (SELECT term, lang AS platform, count(*) AS articles FROM terms GROUP BY 1, 2),
s AS (SELECT split_part(p_name, ' ', 2) AS term, CASE WHEN p_size > 25 THEN 'en' ELSE 'de' END AS platform, count(*) AS skus FROM part GROUP BY 1, 2)
SELECT coalesce(a.term, s.term) AS term, coalesce(a.platform, s.platform) AS platform, coalesce(articles, 0) AS articles, coalesce(skus, 0) AS skus,
  CASE WHEN skus > 0 THEN coalesce(articles, 0) / skus::DOUBLE END AS ratio FROM a FULL JOIN s ON s.term = a.term AND s.platform = a.platform""")
def trend_heatmap(t):
    articles = terms(t).select("term", F.col("lang").alias("platform"))
    skus = t.part.select(F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("term"), F.when(F.col("p_size") > 25, "en").otherwise("de").alias("platform"))
    return TR.heatmap(articles, skus, ["term", "platform"])


@query("vocab_delta", f"""
WITH {_TERMS}, m AS (SELECT term, year(ts) * 12 + month(ts) AS month, count(*) AS n FROM terms GROUP BY 1, 2)
SELECT a.term, a.month, a.n, coalesce(b.n, 0) AS prev, a.n - coalesce(b.n, 0) AS delta FROM m a LEFT JOIN m b ON b.term = a.term AND b.month = a.month - 1""")
def vocab_delta(t):
    rows = terms(t).select("term", TR.month_index(F.col("ts")).cast("bigint").alias("month"))
    return TR.period_delta(rows, ["term"], "month")


COLORS = ["red", "blue", "old", "hot", "new", "cold", "green", "small"]


@query("vocab_delta_products", f"""
WITH c AS (SELECT l_partkey, year(l_shipdate) AS year FROM lineitem), m AS (
  SELECT term, year, count(*) AS n FROM (SELECT split_part(p_name, ' ', 1) AS term, CAST(year AS BIGINT) AS year FROM c JOIN part ON p_partkey = l_partkey)
  WHERE term IN ({', '.join(repr(v) for v in COLORS)}) GROUP BY 1, 2)
SELECT a.term, a.year, a.n, coalesce(b.n, 0) AS prev, a.n - coalesce(b.n, 0) AS delta FROM m a LEFT JOIN m b ON b.term = a.term AND b.year = a.year - 1""")
def vocab_delta_products(t):
    """Counted by product first, so that names are matched once for each product and not for each line."""
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey"), F.year("l_shipdate").cast("bigint").alias("year")).agg(F.count("*").alias("c"))
    hits = TR.mentions(t.part.select("p_partkey", "p_name"), "p_name", COLORS, ["p_partkey"])
    counts = hits.join(per_part, "p_partkey").groupBy("term", "year").agg(F.sum("c").alias("n"))
    before = counts.select("term", (F.col("year") + 1).alias("year"), F.col("n").alias("prev"))
    return counts.join(before, ["term", "year"], "left").select(
        "term", "year", "n", F.coalesce("prev", F.lit(0)).alias("prev"), (F.col("n") - F.coalesce("prev", F.lit(0))).alias("delta")
    )


_LEADS = ["word", *[f"lead(word, {k}) OVER (PARTITION BY doc_id ORDER BY i)" for k in (1, 2, 3)]]
_GRAMS = " UNION ALL ".join("SELECT " + " || ' ' || ".join(_LEADS[:n]) + " AS ngram FROM tok" for n in (2, 3, 4))


@query("headline_ngrams", f"""
WITH heads AS (SELECT doc_id, regexp_extract_all(lower(split_part(text, '.', 1)), '([a-z0-9]+)', 1) AS w FROM documents),
tok AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM heads), g AS ({_GRAMS})
SELECT ngram, count(*) AS n FROM g WHERE ngram IS NOT NULL GROUP BY ngram HAVING count(*) > 1""")
def headline_ngrams(t):
    heads = t.spread("documents", "doc_id", "text").select("doc_id", F.split_part(F.col("text"), F.lit("."), F.lit(1)).alias("head"))
    return TR.headline_ngrams(heads, "head", keep=["doc_id"]).groupBy("ngram").agg(F.count("*").alias("n")).filter("n > 1")


@query("lag_correlation", """
WITH d AS (SELECT event_type, CAST(date_diff('day', TIMESTAMP '2024-01-01', ts) AS BIGINT) AS step, count(*) AS n FROM events GROUP BY ALL),
a AS (SELECT 'all' AS trend, step, sum(n) AS n FROM d WHERE event_type = 'view' GROUP BY step), b AS (SELECT 'all' AS trend, step, sum(n) AS n FROM d WHERE event_type = 'purchase' GROUP BY step)
SELECT a.trend, CAST(lag AS INTEGER) AS lag, round(corr(a.n, b.n), 6) AS corr, count(*) AS n_pairs
FROM a, (SELECT unnest(generate_series(0, 8)) AS lag) JOIN b ON b.trend = a.trend AND b.step = a.step + lag GROUP BY 1, 2""")
def lag_correlation(t):
    daily = lambda kind: t.events.filter(F.col("event_type") == kind).groupBy(
        F.lit("all").alias("trend"), F.datediff("ts", F.lit("2024-01-01").cast("date")).cast("bigint").alias("step")
    ).agg(F.count("*").alias("n"))
    return TR.lag_corr(daily("view"), daily("purchase"), "trend", "step").withColumn("corr", F.round("corr", 6))


@query("repricing_correlation", """
WITH s AS (SELECT l_returnflag AS category, n_regionkey AS site, CAST(date_diff('month', TIMESTAMP '1995-01-01', date_trunc('month', l_shipdate)) AS BIGINT) AS step,
                  avg(CAST(l_extendedprice AS DECIMAL(12,2))) AS avg_price FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2, 3),
d AS (SELECT *, avg_price - lag(avg_price) OVER (PARTITION BY category, site ORDER BY step) AS d FROM s)
SELECT a.category, a.site AS leader, b.site AS follower, CAST(lag AS INTEGER) AS lag, round(corr(a.d, b.d), 5) AS corr, count(*) AS n_pairs
FROM d a JOIN region ON r_regionkey = a.site, (SELECT unnest(generate_series(0, 8)) AS lag) JOIN d b ON b.category = a.category AND b.site = a.site + 1 AND b.step = a.step + lag
WHERE a.d IS NOT NULL AND b.d IS NOT NULL GROUP BY 1, 2, 3, 4""")
def repricing_correlation(t):
    where = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("site"))
    step = F.floor(F.months_between(F.trunc("l_shipdate", "month"), F.lit("1995-01-01").cast("date"))).cast("bigint")
    prices = t.lineitem.join(where, "l_suppkey").groupBy(F.col("l_returnflag").alias("category"), "site", step.alias("step")).agg(
        F.avg(F.col("l_extendedprice").cast("decimal(12,2)")).cast("double").alias("avg_price")
    )
    pairs = t.region.select(F.col("r_regionkey").alias("leader"), (F.col("r_regionkey") + 1).alias("follower"))
    return TR.repricing_corr(prices, pairs).withColumn("corr", F.round("corr", 5))


@query("monthly_report")
def monthly_report(t):
    return TR.monthly_report({
        "price_bands": price_bands(t), "discount_bands": discount_bands(t), "brand_growth": brand_growth(t), "size_gap": size_gap(t),
        "keyword_peaks": keyword_peaks(t), "heatmap": trend_heatmap(t), "vocab_delta": vocab_delta(t),
    })
