"""Links, ranks in listings, frontier expansion, dedup and resume."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import DOMAIN_LOG_SQL, domain_log, query
from pageloom.functions import html as H, urls as U
from pageloom.operators import frontier as FR
from pageloom.session import new_folder

_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
LINKS_SQL = f"""
links AS (
  SELECT page_id, url, CAST(i - 1 AS INTEGER) AS pos, replace(hs[i], '&amp;', '&') AS href, {_ORIGIN} || replace(hs[i], '&amp;', '&') AS link
  FROM (SELECT page_id, url, hs, unnest(generate_series(1, len(hs))) AS i
        FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages)))
"""


@query("extract_links", f"WITH {LINKS_SQL} SELECT page_id, pos, href, link FROM links")
def extract_links(t):
    return FR.extract_links(t.pages)


@query("first_seen_links", f"WITH {LINKS_SQL} SELECT page_id, link, min(pos) AS pos FROM links GROUP BY page_id, link")
def first_seen_links(t):
    return FR.first_seen(FR.extract_links(t.pages).select("page_id", "link", "pos"), ["page_id", "link"], ["pos"])


_RANKED = f"""
WITH {LINKS_SQL},
kept AS (SELECT page_id, link, min(pos) AS pos FROM links WHERE regexp_matches(link, '[a-e]$') GROUP BY page_id, link)
SELECT page_id, link, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) AS INTEGER) AS rank FROM kept"""


@query("rank_in_listing", _RANKED)
def rank_in_listing(t):
    return FR.ranked_links(t.pages, lambda u: u.rlike("[a-e]$"))


@query("rank_in_listing_rows", _RANKED)
def rank_in_listing_rows(t):
    links = FR.extract_links(t.pages).filter(F.col("link").rlike("[a-e]$"))
    return FR.rank_in_listing(links, ["page_id"], "pos", "link", width=2).select("page_id", "link", "rank")


@query("listing_pages_from_seeds", f"""
WITH {LINKS_SQL},
sites AS (SELECT page_id, url, CASE WHEN contains(url, '.org') THEN 'org' WHEN contains(url, '.net') THEN 'net' ELSE 'com' END AS site FROM pages),
level1 AS (
  SELECT DISTINCT s.site, s.url AS url FROM sites s WHERE s.site <> 'com'),
hits AS (
  SELECT l1.site, l.url AS parent_url, l.link AS url, min(l.pos) AS pos
  FROM level1 l1 JOIN links l ON l.url = l1.url
  WHERE (l1.site = 'org') OR regexp_matches(l.link, '[a-e]$') GROUP BY 1, 2, 3)
SELECT 'media_crawl' AS project, site, 's1' AS schedule_id, url,
       CAST(row_number() OVER (PARTITION BY parent_url ORDER BY pos) AS INTEGER) AS rank, parent_url, 2 AS depth
FROM hits""")
def listing_pages_from_seeds(t):
    """Seeds to listing pages to links. Site `com` has no second method and so yields nothing."""
    site = F.when(F.contains("url", F.lit(".org")), "org").when(F.contains("url", F.lit(".net")), "net").otherwise("com")
    seeds = t.pages.select(
        F.lit("media_crawl").alias("project"), site.alias("site"), F.lit("s1").alias("schedule_id"), "url"
    )
    methods = {
        "seed_only": FR.Method("pages", lambda c: F.array(c)),
        "wordpress": FR.METHODS["wordpress_pages"],
        "all": FR.Method("links", lambda c: F.lit(True)),
        "a_to_e": FR.Method("links", lambda c: c.rlike("[a-e]$")),
    }
    config = t.spark.createDataFrame(
        [("media_crawl", "org", 1, "wordpress"), ("media_crawl", "org", 2, "all"), ("media_crawl", "net", 1, "seed_only"),
         ("media_crawl", "net", 2, "a_to_e"), ("media_crawl", "com", 1, "seed_only")],
        "project string, site string, level int, method string",
    )
    return FR.expand_frontier(seeds, t.pages, config, list(methods), 2, methods)


@query("fallback_link_lists", """
SELECT page_id, CAST(i AS INTEGER) AS pos, xs[i] AS href FROM (
  SELECT page_id, xs, unnest(generate_series(1, len(xs))) AS i FROM (
    SELECT page_id, CASE WHEN len(regexp_extract_all(html, 'href="(/[T-Z][^"]*)"', 1)) > 0
      THEN regexp_extract_all(html, 'href="(/[T-Z][^"]*)"', 1) ELSE regexp_extract_all(html, 'href="([^"]*)"', 1) END AS xs FROM pages))""")
def fallback_link_lists(t):
    hrefs = H.hrefs(F.col("html"))
    chain = FR.first_non_empty_list(F.filter(hrefs, lambda h: h.rlike("^/[T-Z]")), hrefs)
    return t.pages.select("page_id", F.posexplode(chain).alias("p", "href")).select(
        "page_id", (F.col("p") + 1).alias("pos"), "href"
    )


@query("merge_id_sources", f"""
WITH {LINKS_SQL},
a AS (SELECT lower(regexp_extract(href, '^/([A-Za-z]+)', 1)) AS id, 1 AS source_no, min(page_id) AS page_id FROM links
      WHERE regexp_matches(href, '^/[A-Z]') GROUP BY 1),
b AS (SELECT lower(regexp_extract(href, '^/([A-Za-z]+)', 1)) AS id, 2 AS source_no, min(page_id) AS page_id FROM links
      WHERE regexp_matches(href, '^/[a-z]') GROUP BY 1)
SELECT id, source_no, page_id FROM a UNION ALL SELECT id, source_no, page_id FROM b WHERE id NOT IN (SELECT id FROM a)""")
def merge_id_sources(t):
    links = FR.extract_links(t.pages).select(
        F.lower(F.regexp_extract("href", r"^/([A-Za-z]+)", 1)).alias("id"), "page_id", "href"
    )
    first = links.filter(F.col("href").rlike("^/[A-Z]")).select("id", "page_id")
    second = links.filter(F.col("href").rlike("^/[a-z]")).select("id", "page_id")
    return FR.merge_id_sources(first, second, key="id", order="page_id")


@query("dedup_in_run", f"WITH {DOMAIN_LOG_SQL} SELECT DISTINCT endpoint, domain FROM dlog")
def dedup_in_run(t):
    return FR.dedup_in_run(domain_log(t).select("endpoint", "domain"), ["endpoint", "domain"])


@query("pending_urls", """
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def pending_urls(t):
    done = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return FR.pending(t.orders.select("o_orderkey"), done, "o_orderkey")


@query("stop_at_first_empty_page", """
WITH p AS (SELECT user_id, CAST(date_diff('day', TIMESTAMP '2024-01-01', ts) AS INTEGER) AS page, count(*) FILTER (WHERE event_type <> 'error') AS items
           FROM events GROUP BY 1, 2),
s AS (SELECT user_id, min(page) AS stop FROM p WHERE items = 0 GROUP BY user_id)
SELECT p.user_id, page, items FROM p LEFT JOIN s USING (user_id) WHERE stop IS NULL OR page < stop""")
def stop_at_first_empty_page(t):
    listed = t.events.groupBy("user_id", F.datediff("ts", F.lit("2024-01-01").cast("date")).alias("page")).agg(
        F.count_if(F.col("event_type") != "error").alias("items")
    )
    return FR.stop_at_empty(listed, ["user_id"], "page", "items")


_LISTED_SQL = """
listed AS (
  SELECT CASE WHEN user_id % 9 <> 0 THEN user_id % 40 END AS site, CAST(date_diff('day', TIMESTAMP '2024-01-01', ts) AS INTEGER) AS page,
         event_id, event_type <> 'error' AS item FROM events),
p AS (SELECT site, page, count(*) FILTER (WHERE item) AS items FROM listed GROUP BY 1, 2),
s AS (SELECT site, min(page) AS stop FROM p WHERE items = 0 GROUP BY site),
upto AS (SELECT p.* FROM p LEFT JOIN s ON p.site IS NOT DISTINCT FROM s.site WHERE stop IS NULL OR page < stop),
summed AS (SELECT *, coalesce(sum(items) OVER (PARTITION BY site ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM upto)
"""


def _listed(t):
    """Events as items of listing pages, a page a day; a ninth of the rows has no site."""
    return t.events.select(
        F.when(F.col("user_id") % 9 != 0, F.col("user_id") % 40).alias("site"), F.datediff("ts", F.lit("2024-01-01").cast("date")).alias("page"),
        "event_id", (F.col("event_type") != "error").alias("item"))


@query("stop_at_most_items", f"""
WITH {_LISTED_SQL} SELECT site, page, items, CAST(least(items, 100 - before) AS BIGINT) AS take FROM summed WHERE before < 100""")
def stop_at_most_items(t):
    """Both stop rules: the first empty page, and the page at which a site has a hundred items."""
    pages = _listed(t).groupBy("site", "page").agg(F.count_if("item").alias("items"))
    return FR.stop_at_total(FR.stop_at_empty(pages, ["site"], "page", "items"), ["site"], "page", "items", 100, width=3)


@query("first_items", f"""
WITH {_LISTED_SQL}
SELECT site, page, event_id FROM (SELECT site, page, event_id, row_number() OVER (PARTITION BY site ORDER BY page, event_id) AS n FROM listed WHERE item) WHERE n <= 50""")
def first_items(t):
    """The first fifty items of each site, exact inside the last page."""
    items = _listed(t).filter("item")
    ranked = FR.rank_by_number(items, ["site", "page"], "event_id", "rank")
    return FR.first_items(ranked, ["site"], "page", "rank", 50, width=4).select("site", "page", "event_id")


_SHOP_LINKS = """
shop AS (SELECT 's' || CAST(p_partkey % 3 AS VARCHAR) AS site, p_partkey AS k,
                [p_partkey // 2, p_partkey * 3 % 1999, p_size, p_partkey] AS ks FROM part),
links AS (SELECT site, 'https://shop.example/p/' || CAST(k AS VARCHAR) AS url, 'https://shop.example/p/' || CAST(unnest(ks) AS VARCHAR) AS link FROM shop),
l0 AS (SELECT DISTINCT site, 'https://shop.example/p/' || CAST(k AS VARCHAR) AS url FROM shop WHERE k % 100 = 0)"""
for _n in range(1, 7):
    _SHOP_LINKS += f""",
l{_n} AS (SELECT DISTINCT f.site, link AS url FROM l{_n - 1} f JOIN links USING (url)
  WHERE NOT EXISTS (SELECT 1 FROM ({' UNION ALL '.join(f'SELECT * FROM l{k}' for k in range(_n))}) b WHERE b.site = f.site AND b.url = link))"""
_SHOP_LEVELS = " UNION ALL ".join(f"SELECT site, url, {n} AS level FROM l{n}" for n in range(7))


@query("kept_frontier", f"WITH {_SHOP_LINKS} {_SHOP_LEVELS}")
def kept_frontier(t):
    """Pages that link in circles, followed for six levels; the crawl breaks off after the second and after a half-written third."""
    link = lambda k: F.concat(F.lit('<a href="/p/'), k.cast("string"), F.lit('">x</a>'))
    key, base = F.col("p_partkey"), F.lit("https://shop.example/p/")
    pages = t.part.select(
        F.concat(base, key.cast("string")).alias("url"), F.concat("p_brand", link(F.floor(key / 2)), link(key * 3 % 1999), link(F.col("p_size")), link(key)).alias("html"))
    seeds = t.part.filter(key % 100 == 0).select(
        F.lit("shop").alias("project"), F.concat(F.lit("s"), (key % 3).cast("string")).alias("site"), F.lit("1").alias("schedule_id"),
        F.concat(base, key.cast("string")).alias("url"))
    sites = t.part.select(F.lit("shop").alias("project"), F.concat(F.lit("s"), (key % 3).cast("string")).alias("site")).distinct()
    config = sites.select("*", F.lit(1).alias("level"), F.lit("all_links").alias("method"))
    path = new_folder(t.spark, "frontier")
    FR.KeptFrontier(t.spark, path, ["all_links"]).crawl(seeds, pages, config, follow=True, most_levels=2)
    FR.KeptFrontier(t.spark, path, ["all_links"]).read(2).limit(1).drop("level").write.parquet(f"{path}/level=3")
    return FR.KeptFrontier(t.spark, path, ["all_links"]).crawl(seeds, pages, config, follow=True, most_levels=4).select("site", "url", "level")


def _discovery(t):
    """Rules of three sites; pages of any other have none."""
    return t.spark.createDataFrame([
        ("com", "append", 2, 4, "p", "example.com", ["/T", "/a"], ["ing"], None, None), ("net", "wordpress", 2, 3, None, None, None, None, "[a-m]$", ["TH", "on"]),
        ("org", "seed", None, None, None, None, None, ["e"], None, None)], FR.DISCOVERY)


def _sited(t):
    return t.pages.select("page_id", "url", "html", F.regexp_extract(U.url_part(F.col("url"), "host"), r"\.([a-z]+)$", 1).alias("site"))


_HOST = "regexp_extract(link, '//([^/?#]*)', 1)"


@query("site_rule_links", f"""
WITH {LINKS_SQL},
sited AS (SELECT *, regexp_extract(regexp_extract(url, '//([^/?#]*)', 1), '\\.([a-z]+)$', 1) AS site FROM links),
taken AS (
  SELECT page_id, site, link, min(pos) AS pos FROM sited WHERE CASE site
    WHEN 'com' THEN contains({_HOST}, 'example.com') AND (contains(link, '/T') OR contains(link, '/a')) AND NOT contains(link, 'ing')
    WHEN 'net' THEN regexp_matches(link, '[a-m]$') AND (contains(lower(link), 'th') OR contains(lower(link), 'on'))
    WHEN 'org' THEN NOT contains(link, 'e') ELSE false END GROUP BY 1, 2, 3)
SELECT page_id, site, link, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) AS INTEGER) AS rank FROM taken""")
def site_rule_links(t):
    """Links that the rule row of a page's site takes."""
    return FR.links_by_rule(_sited(t), _discovery(t))


@query("site_rule_pages", """
WITH sited AS (SELECT page_id, url, regexp_extract(regexp_extract(url, '//([^/?#]*)', 1), '\\.([a-z]+)$', 1) AS site FROM pages),
g AS (SELECT *, unnest(generate_series(0, CASE site WHEN 'com' THEN 3 WHEN 'net' THEN 2 ELSE 0 END)) AS i FROM sited WHERE site IN ('com', 'net', 'org'))
SELECT page_id, site, CAST(i AS INTEGER) AS page_pos, CASE WHEN i = 0 THEN url
  WHEN site = 'com' THEN url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'p=' || CAST(i + 1 AS VARCHAR)
  ELSE regexp_replace(url, '/+$', '') || '/page/' || CAST(i + 1 AS VARCHAR) || '/' END AS url FROM g""")
def site_rule_pages(t):
    """Listing pages by the rule row of a seed's site."""
    return FR.page_lists_by_rule(_sited(t).drop("html"), _discovery(t), ["page_id"]).drop("seed_url")


@query("on_domain_links", f"""
WITH {LINKS_SQL}
SELECT n_name AS site, count(*) AS links FROM links JOIN nation ON contains(regexp_extract(link, '//([^/]*)', 1), 'example.' || CASE n_nationkey WHEN 0 THEN 'com' WHEN 1 THEN 'net' ELSE 'org' END)
WHERE n_nationkey < 3 GROUP BY n_name""")
def on_domain_links(t):
    """Links kept by the domain of their site's config row."""
    suffix = F.when(F.col("n_nationkey") == 0, "com").when(F.col("n_nationkey") == 1, "net").otherwise("org")
    config = t.nation.filter("n_nationkey < 3").select(F.col("n_name").alias("site"), suffix.alias("tld"))
    links = FR.extract_links(t.pages).select("link", F.regexp_extract(U.url_part(F.col("link"), "host"), r"\.([a-z]+)$", 1).alias("tld"))
    kept = links.join(config, "tld").filter(U.on_domain(F.col("link"), F.concat(F.lit("example."), F.col("tld"))))
    return kept.groupBy("site").agg(F.count("*").alias("links"))


@query("odd_links", """
SELECT p_partkey, 0 AS pos, '/a/' || CAST(p_partkey AS VARCHAR) AS href FROM part
UNION ALL SELECT p_partkey, 1, '/b?x=1&y=' || p_brand FROM part UNION ALL SELECT p_partkey, 2, '/c' FROM part""")
def odd_links(t):
    """Bare and single-quoted values count; links in comments and scripts do not."""
    html = F.concat(
        F.lit("<!-- <a href='/hidden'> --><script>var s = \"<a href='/script'>\";</script><a class=x href=/a/"), F.col("p_partkey").cast("string"),
        F.lit(">one</a> <a href='/b?x=1&#38;y="), F.col("p_brand"), F.lit("'>two</a><A\nHREF = \"/c\" rel=\"x\">three</A>"))
    rows = t.part.select("p_partkey", html.alias("html"))
    return rows.select("p_partkey", F.posexplode(H.hrefs(F.col("html"))).alias("pos", "href"))
