"""Chunked scans against plain loops, with chunks far shorter than the histories and one hot key."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pageloom.operators import frontier as FR, health as HE, scans

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def history():
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 12)
        rows.append((key, START + dt.timedelta(seconds=rng.randrange(0, 7200)), i, rng.random() < 0.45, rng.uniform(-5, 900)))
    return rows


@pytest.fixture(scope="module")
def log(spark, history):
    schema = "endpoint int, ts timestamp_ntz, event_id bigint, ok boolean, latency_ms double"
    return spark.createDataFrame(history, schema).withColumns({
        "domain": F.lit("www.d.example"), "blocked": ~F.col("ok") & (F.col("latency_ms") < 100), "status_code": F.lit(200), "strategy": F.lit(1),
    }).cache()


def by_key(history):
    groups = defaultdict(list)
    for row in sorted(history, key=lambda r: (r[1], r[2])):
        groups[row[0]].append(row)
    return groups


@pytest.mark.parametrize("chunk", [60, 600, 86400])
def test_ema(log, history, chunk):
    want, latency = {}, {}
    for key, rows in by_key(history).items():
        r, m = 1.0, 500.0
        for _, _, _, ok, ms in rows:
            r = 0.15 * ok + 0.85 * r
            if ok and ms > 0:
                m = 0.2 * ms + 0.8 * m
        want[key], latency[key] = r, m
    got = {r.endpoint: r.ema_rate for r in HE.ema(log, chunk_s=chunk).collect()}
    assert got == pytest.approx(want, abs=1e-12)
    got = {r.endpoint: r.ema_latency_ms for r in HE.latency_ema(log, chunk_s=chunk).collect()}
    assert got == pytest.approx(latency, abs=1e-9)


@pytest.mark.parametrize("chunk", [60, 600, 86400])
def test_fail_streak(log, history, chunk):
    want = {}
    for rows in by_key(history).values():
        n = 0
        for _, _, i, ok, _ in rows:
            n = 0 if ok else n + 1
            want[i] = n
    assert {r.event_id: r.fail_streak for r in HE.with_fail_streak(log, chunk_s=chunk).collect()} == want


def test_breaker_follows_the_state_machine(log, history):
    now = START + dt.timedelta(seconds=7300)
    want = {}
    for key, rows in by_key(history).items():
        fails, mult, until = 0, 1, START
        for _, ts, _, ok, _ in rows:
            if ok:
                fails, mult, until = 0, 1, START
            else:
                fails += 1
                if fails >= 4:
                    until = ts + dt.timedelta(seconds=min(120 * mult, 900))
                    mult = min(mult * 2, 8)
        want[key] = (fails, mult, "closed" if fails < 4 else "open" if now < until else "half_open")
    got = HE.breaker_state(log, F.lit(now).cast("timestamp_ntz")).collect()
    assert {r.endpoint: (r.consecutive_fails, r.cooldown_mult, r.cb_state) for r in got} == want


def test_long_streaks_cap_the_cooldown(spark):
    rows = [(k, START + dt.timedelta(seconds=i), i, False, 1.0) for k, n in ((1, 3), (2, 4), (3, 5), (4, 9), (5, 40)) for i in range(n)]
    log = spark.createDataFrame(rows, "endpoint int, ts timestamp_ntz, event_id bigint, ok boolean, latency_ms double")
    got = {r.endpoint: (r.cooldown_s, r.cooldown_mult) for r in HE.breaker_state(log, F.lit(START).cast("timestamp_ntz")).collect()}
    assert got == {1: (0.0, 1), 2: (120.0, 2), 3: (240.0, 4), 4: (900.0, 8), 5: (900.0, 8)}


@pytest.mark.parametrize("chunk", [60, 86400])
def test_lag(log, history, chunk):
    want = {}
    for rows in by_key(history).values():
        prev = None
        for _, _, i, _, ms in rows:
            want[i], prev = prev, ms
    got = scans.lag_by_time(log, ["endpoint"], ["ts", "event_id"], "latency_ms", "ts", "prev", chunk).collect()
    assert {r.event_id: r.prev for r in got} == want


@pytest.mark.parametrize("chunk", [300, 7200])
def test_rolling(log, history, chunk):
    want = {}
    for rows in by_key(history).values():
        for _, ts, i, _, _ in rows:
            seen = [ok for _, t, _, ok, _ in rows if ts - dt.timedelta(seconds=300) <= t <= ts]
            want[i] = 100 * sum(seen) / len(seen)
    got = HE.rolling_success(log, 300, by="endpoint", chunk_s=chunk).collect()
    assert len(got) == len(history)
    assert {r.event_id: r.success_pct for r in got} == pytest.approx(want)


def test_position(log, history):
    order = sorted(history, key=lambda r: (-r[0], r[1], r[2]))
    want = {r[2]: i for i, r in enumerate(order, 1)}
    got = scans.position_by_level(log, "endpoint", "ts", "event_id", "pos", 120).collect()
    assert {r.event_id: r.pos for r in got} == want


@pytest.mark.parametrize("limit", ["1000", "2"])
def test_top_per_group_with_and_without_salt(spark, log, history, limit):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        got = scans.top_per_group(log, ["endpoint"], [F.desc("latency_ms")], 5, spread_by=["event_id"]).collect()
    finally:
        spark.conf.set(key, before)
    want = {i for rows in by_key(history).values() for i in [r[2] for r in sorted(rows, key=lambda r: -r[4])[:5]]}
    assert {r.event_id for r in got} == want


def test_rank_and_stop(spark):
    rows = [(1, i, f"u{i % 7}") for i in range(50)]
    df = spark.createDataFrame(rows, "page int, pos int, link string")
    got = {r.link: r.rank for r in FR.rank_in_listing(df, ["page"], "pos", "link", width=3).collect()}
    assert got == {f"u{i}": i + 1 for i in range(7)}
    pages = spark.createDataFrame([(1, 1, 5), (1, 2, 0), (1, 3, 4), (2, 1, 3)], "seed int, page int, n int")
    assert {(r.seed, r.page) for r in FR.stop_at_empty(pages, ["seed"], "page", "n").collect()} == {(1, 1), (2, 1)}


def test_frontier_missing_method_and_dedup(spark):
    seeds = spark.createDataFrame([("p", s, "1", "https://a.example/l") for s in ("one", "two", "one")], "project string, site string, schedule_id string, url string")
    pages = spark.createDataFrame([("https://a.example/l", '<a href="/p/1">x</a><a href="/p/1">y</a><a href="/q">z</a>')], "url string, html string")
    config = spark.createDataFrame([("p", "one", 1, "seed_only"), ("p", "one", 2, "product_links"), ("p", "two", 1, "seed_only")],
                                   "project string, site string, level int, method string")
    got = FR.expand_frontier(seeds, pages, config, ["seed_only", "product_links"]).collect()
    assert [(r.site, r.url, r.rank, r.parent_url) for r in got] == [("one", "https://a.example/p/1", 1, "https://a.example/l")]
    with pytest.raises(KeyError):
        FR.expand_frontier(seeds, pages, config, ["nope"])


def test_rolling_counts_run_on(spark):
    """No frame is gone through again for each row; rows without a time share a frame, rows without a verdict do not count."""
    rows = [(1, 0, True), (1, 0, False), (1, 299, None), (1, 300, True), (1, 301, True), (1, 601, None), (1, 602, None), (None, 5, False), (1, None, True), (1, None, False)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "event_id int, endpoint int, s long, ok boolean").withColumn("ts", F.timestamp_seconds("s"))
    got = HE.rolling_success(df, 300, by="endpoint", chunk_s=300)
    want = {}
    for i, (k, s, _) in enumerate(rows):
        seen = [o for k2, s2, o in rows if k2 == k and o is not None and (s2 is None if s is None else s2 is not None and s - 300 <= s2 <= s)]
        want[i] = 100 * sum(seen) / len(seen) if seen else None
    assert {r.event_id: r.success_pct for r in got.collect()} == pytest.approx(want)
    assert "RangeFrame, -" not in got._jdf.queryExecution().toString()
