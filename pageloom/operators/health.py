"""Fetch-log analytics: endpoint health, breaker state, counters, latency, strategies.

`log` columns: ts, event_id (unique tie-break), endpoint, domain, ok, blocked,
status_code, strategy, latency_ms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pageloom.functions.classify import error_type
from pageloom.operators import scans

# Smoothing, breaker and label thresholds, histogram bounds.
EMA_ALPHA = 0.15
LATENCY_ALPHA = 0.2
LATENCY_START = 500.0
FAIL_THRESHOLD = 4
COOLDOWN_BASE_S = 120
COOLDOWN_MAX_S = 900
COOLDOWN_MULT_MAX = 8
MIN_WEIGHT = 0.05
DEGRADED_BELOW = 0.40
HEALTHY_FROM = 0.70
FETCH_BUCKETS = [0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 30.0]
PARSE_BUCKETS = [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0]
PUBLISH_BUCKETS = [0.001, 0.005, 0.01, 0.05, 0.1, 0.5]


def ema(log: DataFrame, key: str = "endpoint", order: Sequence[str] = ("ts", "event_id"), value: Column | None = None,
        alpha: float = EMA_ALPHA, init: float = 1.0, out: str = "ema_rate", chunk_s: int = scans.HOUR) -> DataFrame:
    x = F.col("ok").cast("double") if value is None else value
    return scans.decayed_fold(log, [key], list(order), x, alpha, init, order[0], out, chunk_s)


def latency_ema(log: DataFrame, key: str = "endpoint", order: Sequence[str] = ("ts", "event_id"),
                chunk_s: int = scans.HOUR) -> DataFrame:
    """Only successes with a positive latency count; an endpoint without any keeps the start value."""
    hits = log.filter(F.col("ok") & (F.col("latency_ms") > 0))
    folded = ema(hits, key, order, F.col("latency_ms"), LATENCY_ALPHA, LATENCY_START, "ema_latency_ms", chunk_s)
    return (
        scans.same_keys(log.select(key).distinct(), folded, [key], "left")
        .select(key, F.coalesce("ema_latency_ms", F.lit(LATENCY_START)).alias("ema_latency_ms"))
    )


def with_fail_streak(log: DataFrame, key: str = "endpoint", order: Sequence[str] = ("ts", "event_id"),
                     chunk_s: int = scans.HOUR) -> DataFrame:
    return scans.fail_streak(log, [key], list(order), F.col("ok"), order[0], "fail_streak", chunk_s)


def consecutive_failures(log: DataFrame, key: str = "endpoint",
                         order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Failures since the last success of each endpoint: two combined aggregates, no sort."""
    at = F.struct(*order)
    last_ok = log.filter("ok").groupBy(key).agg(F.max(at).alias("__ok"))
    return (
        scans.same_keys(log.select(key, *order), last_ok, [key], "left")
        .groupBy(key)
        .agg(
            F.count_if(F.col("__ok").isNull() | (at > F.col("__ok"))).alias("consecutive_fails"),
            F.max(order[0]).alias("last_ts"),
        )
    )


def breaker_state(log: DataFrame, now: Column, key: str = "endpoint", order: Sequence[str] = ("ts", "event_id"),
                  threshold: int = FAIL_THRESHOLD, base_s: int = COOLDOWN_BASE_S,
                  max_s: int = COOLDOWN_MAX_S) -> DataFrame:
    """closed / open / half_open at `now` for each endpoint of a log."""
    return with_breaker(consecutive_failures(log, key, order), now, threshold, base_s, max_s)


def with_breaker(streaks: DataFrame, now: Column, threshold: int = FAIL_THRESHOLD, base_s: int = COOLDOWN_BASE_S,
                 max_s: int = COOLDOWN_MAX_S) -> DataFrame:
    """Adds the breaker's columns to consecutive_fails and last_ts.

    Every failure from the threshold on trips the breaker and doubles the
    multiplier, a success resets both, so the streak alone fixes the cooldown.
    """
    fails = F.col("consecutive_fails")
    trips = F.least(fails - threshold, F.lit(16))
    used = F.least(F.pow(F.lit(2.0), trips), F.lit(float(COOLDOWN_MULT_MAX)))
    next_mult = F.least(used * 2, F.lit(float(COOLDOWN_MULT_MAX)))
    tripped = fails >= threshold
    cooldown = F.when(tripped, F.least(used * base_s, F.lit(float(max_s)))).otherwise(F.lit(0.0))
    until = F.unix_micros(F.col("last_ts").cast("timestamp")) + (cooldown * 1_000_000).cast("bigint")
    now_us = F.unix_micros(now.cast("timestamp"))
    state = F.when(~tripped, "closed").when(now_us < until, "open").otherwise("half_open")
    return streaks.select(
        "*",
        F.when(tripped, next_mult).otherwise(F.lit(1.0)).cast("int").alias("cooldown_mult"),
        cooldown.alias("cooldown_s"),
        state.alias("cb_state"),
    )


def health_label(df: DataFrame, healthy: float = HEALTHY_FROM, degraded: float = DEGRADED_BELOW) -> DataFrame:
    """Adds is_healthy, is_degraded and the sampling weight from cb_state and ema_rate."""
    rate, state = F.col("ema_rate"), F.col("cb_state")
    weight = (
        F.when(state == "open", F.lit(0.0))
        .when(state == "half_open", F.lit(MIN_WEIGHT))
        .otherwise(F.greatest(F.lit(MIN_WEIGHT), rate))
    )
    return df.withColumns({
        "is_healthy": (state == "closed") & (rate >= healthy),
        "is_degraded": rate < degraded,
        "weight": weight,
    })


def folded(log: DataFrame, key: str = "endpoint", chunk_s: int = scans.HOUR) -> DataFrame:
    """What a stretch of log does to each endpoint's health, as one small row: key, n, n_ok, b, fails, last_ts, n_hits, b_latency.

    A rate r before it is (1 - a)^n * r + b behind it, a latency likewise by n_hits and b_latency; `fails` are the failures behind the last success, all n if there is
    none. Rows of stretches that follow each other compose (`composed`). A piece of an endpoint's time keeps its share of these; the
    shares are added up from the last piece back, so no task holds an endpoint's rows.
    """
    keep, slow = 1.0 - EMA_ALPHA, 1.0 - LATENCY_ALPHA
    hit = F.col("ok") & (F.coalesce("latency_ms", F.lit(0.0)) > 0)
    pieces = log.select(
        key, "ts", "event_id", "ok", hit.alias("__hit"), "latency_ms", scans.time_chunk(F.col("ts"), chunk_s).alias(scans.CHUNK))
    backwards = W.partitionBy(key, scans.CHUNK).orderBy(F.desc("ts"), F.desc("event_id"))
    hits_behind = F.coalesce(F.sum(F.col("__hit").cast("int")).over(backwards.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = pieces.withColumns({"__back": F.row_number().over(backwards) - 1, "__hits": hits_behind}).groupBy(key, scans.CHUNK).agg(
        F.count("*").alias("__n"), F.count_if("ok").alias("__ok"), F.max("ts").alias("__ts"), F.count_if("__hit").alias("__nh"),
        F.sum(EMA_ALPHA * F.col("ok").cast("double") * F.pow(F.lit(keep), F.col("__back"))).alias("__b"),
        F.sum(F.when(F.col("__hit"), LATENCY_ALPHA * F.col("latency_ms") * F.pow(F.lit(slow), F.col("__hits"))).otherwise(0.0)).alias("__bl"),
        F.coalesce(F.min(F.when(F.col("ok"), F.col("__back"))), F.count("*")).alias("__tail"),
    )
    later = W.partitionBy(key).orderBy(F.desc(scans.CHUNK)).rowsBetween(W.unboundedPreceding, -1)
    after = lambda c: F.coalesce(F.sum(c).over(later), F.lit(0))
    return parts.withColumns({"__after": after("__n"), "__ok_after": after("__ok"), "__hits_after": after("__nh")}).groupBy(key).agg(
        F.sum("__n").alias("n"), F.sum("__ok").alias("n_ok"),
        F.sum(F.col("__b") * F.pow(F.lit(keep), F.col("__after"))).alias("b"),
        F.sum(F.when(F.col("__ok_after") == 0, F.col("__tail")).otherwise(0)).cast("bigint").alias("fails"),
        F.max("__ts").alias("last_ts"), F.sum("__nh").alias("n_hits"),
        F.sum(F.col("__bl") * F.pow(F.lit(slow), F.col("__hits_after"))).alias("b_latency"),
    )


def composed(state: DataFrame, stretch: DataFrame, key: str = "endpoint") -> DataFrame:
    """Health behind a stretch, from the health before it (`state`, may lack endpoints) and the `folded` stretch: one row for each endpoint of either.

    key, ema_rate, ema_latency_ms, consecutive_fails, total_requests, last_ts
    """
    s, d = state.alias("s"), stretch.alias("d")
    n, hits = F.coalesce("d.n", F.lit(0)), F.coalesce("d.n_hits", F.lit(0))
    return s.join(d, F.col(f"s.{key}").eqNullSafe(F.col(f"d.{key}")), "full_outer").select(
        F.coalesce(f"d.{key}", f"s.{key}").alias(key),
        (F.coalesce("s.ema_rate", F.lit(1.0)) * F.pow(F.lit(1.0 - EMA_ALPHA), n) + F.coalesce("d.b", F.lit(0.0))).alias("ema_rate"),
        (F.coalesce("s.ema_latency_ms", F.lit(LATENCY_START)) * F.pow(F.lit(1.0 - LATENCY_ALPHA), hits) + F.coalesce("d.b_latency", F.lit(0.0))).alias("ema_latency_ms"),
        (F.coalesce("d.fails", F.lit(0)) + F.when(F.coalesce("d.n_ok", F.lit(0)) == 0, F.coalesce("s.consecutive_fails", F.lit(0))).otherwise(0)).cast("bigint").alias("consecutive_fails"),
        (F.coalesce("s.total_requests", F.lit(0)) + n).cast("bigint").alias("total_requests"),
        F.coalesce("d.last_ts", "s.last_ts").alias("last_ts"),
    )


def endpoint_health(log: DataFrame, now: Column, key: str = "endpoint", chunk_s: int = scans.HOUR) -> DataFrame:
    """Smoothed rate, streak, breaker and totals of each endpoint in one pass over the log."""
    streaks = folded(log, key, chunk_s).select(
        key, (F.col("b") + F.pow(F.lit(1.0 - EMA_ALPHA), F.col("n"))).alias("ema_rate"), F.col("fails").alias("consecutive_fails"), "last_ts",
        F.col("n").alias("total_requests"), F.col("n_ok").alias("total_successes"))
    return health_label(with_breaker(streaks, now))


def pool_stats(health: DataFrame) -> DataFrame:
    closed = F.col("cb_state") == "closed"
    return health.agg(
        F.count("*").alias("total"),
        F.count_if("is_healthy").alias("healthy"),
        F.count_if(closed & F.col("is_degraded")).alias("degraded"),
        F.count_if(F.col("cb_state") == "open").alias("circuit_open"),
        F.count_if(F.col("cb_state") == "half_open").alias("circuit_half"),
        F.coalesce(F.bround(F.avg("ema_rate"), 3), F.lit(0.0)).alias("avg_ema_rate"),
    )


def blocked_domains(log: DataFrame, key: str = "endpoint") -> DataFrame:
    """The blocked set of each endpoint as rows, with how often and since when."""
    bare = F.regexp_replace("domain", r"^www\.", "")
    return (
        log.filter(F.col("blocked") & (F.col("domain") != ""))
        .groupBy(key, bare.alias("domain"))
        .agg(F.count("*").alias("hits"), F.min("ts").alias("first_ts"))
    )


def fetch_counters(log: DataFrame) -> DataFrame:
    """Counters by domain and error type in one pass; success rows have error_type 'none'."""
    kind = F.coalesce(error_type(F.col("status_code"), F.col("blocked")), F.lit("none"))
    return log.groupBy("domain", kind.alias("error_type")).agg(F.count("*").alias("n"))


def pipeline_counters(log: DataFrame, item: str, by: str = "domain") -> DataFrame:
    """Found, repeated, fetched and failed items of each domain.

    Counted by (domain, item) first: repeats collapse before the second shuffle.
    """
    per_item = log.groupBy(by, item).agg(F.count("*").alias("n"), F.count_if("ok").alias("good"))
    return per_item.groupBy(by).agg(
        F.sum("n").alias("urls_discovered"),
        (F.sum("n") - F.count("*")).alias("urls_deduplicated"),
        F.sum("good").alias("pages_fetched"),
        (F.sum("n") - F.sum("good")).alias("dead_letters"),
    )


def latency_histogram(log: DataFrame, buckets: Sequence[float] = FETCH_BUCKETS, by: str = "domain",
                      seconds: Column | None = None) -> DataFrame:
    """Cumulative `le` counts, one row for each bound and +Inf."""
    value = F.col("latency_ms") / 1000.0 if seconds is None else seconds
    bounds = [float(b) for b in buckets]
    slot = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        slot = F.when(value <= bounds[i], F.lit(i)).otherwise(slot)
    counts = log.groupBy(F.col(by), slot.alias("__slot")).agg(F.count("*").alias("__n"))
    per_key = counts.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("__slot", "__n"))).alias("__m"))
    labels = F.array(*[F.lit(str(b)) for b in bounds], F.lit("+Inf"))

    def upto(i: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), i), F.lit(0).cast("bigint"),
            lambda acc, j: acc + F.coalesce(F.try_element_at(F.col("__m"), j), F.lit(0)),
        )

    rows = F.transform(
        F.sequence(F.lit(0), F.lit(len(bounds))),
        lambda i: F.struct(F.element_at(labels, i + 1).alias("le"), upto(i).alias("n")),
    )
    return per_key.select(by, F.inline(rows))


def rolling_success(log: DataFrame, seconds: int = 300, by: str = "domain", chunk_s: int = scans.HOUR) -> DataFrame:
    """Success % over the last `seconds` at each fetch."""
    return scans.rolling_by_time(log, [by], "ts", seconds, {"success_pct": F.col("ok")}, chunk_s)


def domain_strategies(log: DataFrame) -> DataFrame:
    """Strategy floor (highest level that worked, 0 without one) and last success of each tried domain."""
    return log.groupBy("domain").agg(
        F.coalesce(F.max(F.when(F.col("ok"), F.col("strategy"))), F.lit(0)).alias("min_strategy"),
        F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_success"),
    )


def strategy_distribution(log: DataFrame) -> DataFrame:
    """How many domains sit at each strategy floor; highest first."""
    return (
        domain_strategies(log).groupBy("min_strategy").agg(F.count("*").alias("domains")).orderBy(F.desc("min_strategy"))
    )


def queue_depths(dlq: DataFrame, stages: DataFrame) -> DataFrame:
    """Dead letters for each stage, stages without any at zero."""
    counts = dlq.groupBy("stage").agg(F.count("*").alias("depth"))
    return stages.select("stage").join(counts, "stage", "left").select(
        "stage", F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth")
    )


