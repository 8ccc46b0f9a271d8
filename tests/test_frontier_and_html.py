"""Kept frontiers, stop rules, nested containers and vocabulary tables against plain versions."""

import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from pageloom.functions import html as H
from pageloom.operators import frontier as FR, trends as TR
from pageloom.session import new_folder

SITE = "https://x.example/"


def graph(spark, edges):
    pages = {}
    for a, b in edges:
        pages.setdefault(a, []).append(b)
    rows = [(f"{SITE}{a}", "".join(f'<a href="/{b}">x</a>' for b in bs)) for a, bs in pages.items()]
    return spark.createDataFrame(rows, "url string, html string")


def seeds(spark, *names):
    return spark.createDataFrame([("p", "s", "1", f"{SITE}{n}") for n in names], "project string, site string, schedule_id string, url string")


def config(spark, *methods):
    return spark.createDataFrame([("p", "s", k, m) for k, m in enumerate(methods, 1)], "project string, site string, level int, method string")


def found(df):
    return {(r.level, r.url.removeprefix(SITE), (r.parent_url or "").removeprefix(SITE)) for r in df.collect()}


def test_cycles_end_and_a_broken_crawl_goes_on(spark):
    pages = graph(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "c"), ("c", "d"), ("a", "a"), ("d", "gone")])
    methods, steps = ["all_links"], config(spark, "all_links")
    want = {(0, "a", ""), (1, "b", "a"), (2, "c", "b"), (3, "d", "c"), (4, "gone", "d")}
    whole = FR.KeptFrontier(spark, new_folder(spark, "frontier"), methods)
    assert found(whole.crawl(seeds(spark, "a"), pages, steps, follow=True)) == want
    assert whole.levels() == 6 and whole.read(5).count() == 0
    path = new_folder(spark, "frontier")
    broken = pages.withColumn("html", F.when(F.col("url") == f"{SITE}c", F.raise_error(F.lit("lost"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="lost"):
        FR.KeptFrontier(spark, path, methods).crawl(seeds(spark, "a"), broken, steps, follow=True)
    again = FR.KeptFrontier(spark, path, methods)
    assert again.levels() == 3
    assert found(again.crawl(seeds(spark, "a"), pages, steps, follow=True)) == want
    assert found(again.crawl(seeds(spark, "other"), pages, steps, follow=True)) == want  # done: nothing is read again


def test_levels_are_those_of_the_plain_expansion(spark):
    rng = random.Random(3)
    pages = graph(spark, [(rng.randrange(30), rng.randrange(30)) for _ in range(80)])
    registry = {"same": FR.Method("pages", lambda c: F.array(c)), "all": FR.METHODS["all_links"]}
    steps = config(spark, "same", "all", "all")
    kept = FR.KeptFrontier(spark, new_folder(spark, "frontier"), list(registry), registry)
    got = {(r.url, r.rank) for r in kept.crawl(seeds(spark, 1, 2, 2), pages, steps).filter("level = 3").collect()}
    plain = FR.expand_frontier(seeds(spark, 1, 2, 2), pages, steps, list(registry), 3, registry)
    assert {u for u, _ in got} == {r.url for r in plain.collect()} and kept.levels() == 4
    with pytest.raises(KeyError):
        FR.KeptFrontier(spark, new_folder(spark, "frontier"), ["nothing"])


def test_stop_rules(spark):
    rng = random.Random(5)
    rows = [(s, p, rng.choice([None, 0, 1, 4, 9])) for s in ("a", "b", None) for p in rng.sample(range(60), 25)]
    df = spark.createDataFrame(rows, "site string, page int, n int")
    for most in (1, 17, 10_000):
        want = set()
        for site in ("a", "b", None):
            total = 0
            for page, n in sorted((p, n or 0) for s, p, n in rows if s == site):
                if total < most:
                    want.add((site, page, min(n, most - total)))
                total += n
        for width in (1, 7, 1000):
            assert {(r.site, r.page, r["take"]) for r in FR.stop_at_total(df, ["site"], "page", "n", most, width).collect()} == want
    ends = spark.createDataFrame([(None, 1, 3), (None, 2, 0), (None, 3, 3), ("a", 1, 2)], "site string, page int, n int")
    assert {(r.site, r.page) for r in FR.stop_at_empty(ends, ["site"], "page", "n").collect()} == {(None, 1), ("a", 1)}
    items = spark.createDataFrame([(s, p, r, m) for s, m in ((None, 4), ("a", 7)) for p in range(5) for r in range(1, p + 2)], "site string, page int, rank int, most int")
    got = FR.first_items(items, ["site"], "page", "rank", "most", width=2).groupBy("site").count().collect()
    assert {(r.site, r["count"]) for r in got} == {(None, 4), ("a", 7)}


class Outermost(HTMLParser):
    """Text of the outermost div elements."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.depth, self.out, self.hidden = 0, [], 0
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if tag == "div":
            self.depth += 1
            if self.depth == 1:
                self.out.append([])

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        if tag == "div":
            self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        if self.depth and not self.hidden:
            self.out[-1].append(data)

    def texts(self):
        return [re.sub(r"\s+", " ", " ".join(t)).strip() for t in self.out]


def test_nested_containers_are_those_of_a_parser(spark):
    rng = random.Random(8)
    pieces = ["<div>", "<div class='x y'>", "</div>", "</div>", "<p>", "</p>", "word ", "two words", "<!-- <div> -->", "<script>if (a) '</div>'</script>", "<DIV\n>", "<div-x>"]
    pages = ["", "no tags", None, "<div>", "</div>", *("".join(rng.choices(pieces, k=rng.randint(1, 25))) for _ in range(400))]
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    rows = df.select("id", F.transform(H.sections(F.col("html"), "div"), H.visible_text).alias("all"), H.container_text(F.col("html"), "div").alias("first")).collect()
    for r in rows:
        want = Outermost(pages[r.id] or "").texts()
        assert [t for t in r["all"]] == want, pages[r.id]
        assert (r["first"] or "") == (want[0] if want else "")
    plan = df.select(H.container_text(F.col("html"), "div"))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_vocabulary_table(spark):
    rng = random.Random(1)
    texts = [(k, " ".join(rng.choices(["red", "Shoe", "of", "the", "x1"], k=rng.randint(0, 12)))) for k in range(60)] + [(60, None), (61, "")]
    terms = ["red", "Red shoe", "of the", "of the x1", "shoe shoe shoe", "no such", "", None, "--", "RED", "the  of"]
    df = spark.createDataFrame(texts, "id int, t string")
    vocab = spark.createDataFrame([(t,) for t in [*terms, "red"]], "term string")
    words = lambda s: " " + " ".join(re.findall(r"[a-z0-9]+", (s or "").lower())) + " "
    want = {(k, t) for k, text in texts for t in terms if words(t).strip() and words(t) in words(text)}
    rows = TR.vocabulary_mentions(df, "t", vocab, ["id"]).collect()
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    assert TR.vocabulary_mentions(df, "t", vocab.limit(0), ["id"]).count() == 0
    counts = TR.period_delta(spark.createDataFrame([(None, 1), (None, 1), (None, 2), ("a", 2)], "k string, m int"), ["k"], "m").collect()
    assert {(r.k, r.m, r.n, r.prev) for r in counts} == {(None, 1, 2, 0), (None, 2, 1, 2), ("a", 2, 1, 0)}


def test_rules_of_sites(spark):
    rules = spark.createDataFrame([
        ("a", "query", 1, 3, "p", "a.example", ["/x", "/y"], ["/x/no"], r"\d$", ["Shoe"]), ("b", "path", 2, 1, None, None, None, None, None, None),
        ("c", "seed", None, None, None, None, [], None, None, None), ("d", None, None, None, None, "b.example", None, [], None, None)], FR.DISCOVERY)
    hrefs = ["/x/shoe1", "/x/SHOES2?q=3", "/x/no/shoe4", "/y/hat5", "/z/shoe6", "https://b.example/x/shoe7", "/x/shoe1", "/y/shoe"]
    html = "".join(f'<a href="{h}">x</a>' for h in hrefs)
    pages = spark.createDataFrame([(k, s, "https://a.example/", html) for k, s in enumerate(["a", "b", "c", "d", "none", None])], "page_id int, site string, url string, html string")
    got = {}
    for r in FR.links_by_rule(pages, rules).orderBy("page_id", "rank").collect():
        got.setdefault(r.site, []).append(r.link.removeprefix("https://a.example"))
    assert got == {"a": ["/x/shoe1", "/x/SHOES2?q=3"], "b": list(dict.fromkeys(hrefs)), "d": ["https://b.example/x/shoe7"]}
    lists = {}
    for r in FR.page_lists_by_rule(pages, rules, ["page_id"]).orderBy("page_id", "page_pos").collect():
        lists.setdefault(r.site, []).append(r.url)
    root = "https://a.example/"
    assert lists == {"a": [root, *(f"{root}?p={k}" for k in (1, 2, 3))], "b": [root], "c": [root], "d": [root]}


def test_texts_stay_where_they_are_for_a_small_vocabulary(spark):
    """Also for one made in the session, whose size Spark does not know: its terms are sent to the texts, no word run is shuffled or sent."""
    df = spark.createDataFrame([(1, "of the x")], "id int, t string")
    hits = TR.vocabulary_mentions(df, "t", spark.createDataFrame([("of the",)], "term string"), ["id"])
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "Exchange hashpartitioning" not in plan and hits.count() == 1
