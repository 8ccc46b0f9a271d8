"""Host, path and rules against plain string code; the model against its weights."""

import inspect
import math
import re

import pytest

from pageloom.llm import urlfilter as U

URLS = [
    None, "", "no scheme", "http://", "http://Example.COM", "HTTP://WWW.Example.com/en/1?x#y", "http://example.com/en/", "http://a.b.example.com/en/x",
    "http://example.com/EN/", "http://x.net/es/9", "http://net/es/", "http://evilnet/es/", "http://x.net/fr", "http://x.net/fr/", "http://x.org?u=http://y.com/en/",
    "http://x.org#http://y", "http://İÄ.org/é/ü", "://host/p", "http://u:p@h.net:80/es/1", "http://x.com/" + "a/" * 5000, "http://cheap-pills.org/buy", "http://x.com\n/q",
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = None
    for rule, verdict in U.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


@pytest.fixture(scope="module")
def model(spark):
    return U.train(spark)


def test_pages(spark, model):
    df = spark.createDataFrame([(k, u, "x", 1.0) for k, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string, score double")
    rows = U.url_filter(df, model).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path = plain(([*URLS, *URLS])[r["page_id"]])
        rule, verdict = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.75 else "allow")) and 0 <= r["score"] <= 1
    assert U.url_filter(df.filter("false"), model).count() == 0
    plan = U.url_filter(df, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_model_fits_its_table_and_scores_by_its_weights(spark, model):
    df = spark.createDataFrame(list(U.LABELLED_URLS), "url string, label int").selectExpr("url", "label as page_id")
    rows = U.url_filter(df, model, rules=()).collect()
    assert sum((r["score"] >= 0.5) == bool(r["page_id"]) for r in rows) >= 0.97 * len(rows)

    def grams(mark, text):
        chars = f"^{text}$"
        return [(mark, chars[k:k + n]) for n in model.sizes for k in range(max(len(chars) - n, 0) + 1)]

    sample = rows[:6]
    for r in sample:
        pairs = [*grams("_h", r["host"]), *grams("_p", r["path"])]
        hashed = spark.createDataFrame([(m, list(g)) for m, g in pairs], "m string, g array<string>")
        numbered = hashed.selectExpr(
            "pmod(if(size(g) = 4, xxhash64(m, g[0], g[1], g[2], get(g, 3)), xxhash64(m, get(g, 0), get(g, 1), get(g, 2))), 2048) as b")
        odds = model.intercept + sum(model.weights[x["b"]] for x in numbered.collect())
        assert abs(r["score"] - 1 / (1 + math.exp(-odds))) < 1e-9


def test_training_table_may_be_odd(spark):
    rows = [(None, 1), ("http://a.org/x", None), ("http://spam.org/buy", 1), ("http://news.org/read", 0)] * 2
    model = U.train(spark, spark.createDataFrame(rows, "url string, label int"), buckets=64, iterations=5)
    assert len(model.weights) == 64


def test_threshold_on_urls_held_out(spark, model):
    assert not {plain(u)[0].removeprefix("www.") for u, _ in U.HELD_OUT_URLS} & {plain(u)[0].removeprefix("www.") for u, _ in U.LABELLED_URLS}
    df = spark.createDataFrame(list(U.HELD_OUT_URLS), "url string, label int").selectExpr("url", "label as page_id")
    rows = [(r["page_id"], r["score"]) for r in U.url_filter(df, model, rules=()).collect()]

    def figures(threshold):
        blocked = [label for label, score in rows if score >= threshold]
        return sum(blocked) / max(len(blocked), 1), sum(blocked) / sum(label for label, _ in rows)

    def weighed(threshold):
        precision, recall = figures(threshold)
        return 1.25 * precision * recall / (0.25 * precision + recall)

    threshold = inspect.signature(U.url_filter).parameters["threshold"].default
    precision, recall = figures(threshold)
    assert precision >= 0.9 and recall >= 0.5
    assert weighed(threshold) == max(weighed(k / 20) for k in range(1, 20))
