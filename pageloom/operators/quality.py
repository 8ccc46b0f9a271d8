"""Data-quality rules, alerts, log searches and dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pageloom.operators.scans import same_keys, top_per_group

# The searches of a run's log.
LOG_SEARCHES = {
    "failed_fetches": ("ERROR", "fetch"),
    "zero_url_discoveries": ("INFO", "0 URLs found"),
    "completed_runs": ("INFO", "completed"),
}
LEVELS = ["ERROR", "WARNING", "INFO", "DEBUG"]


def run_alerts(runs: DataFrame, min_fetch_ratio: float = 0.5) -> DataFrame:
    """One row for each run and rule that fires."""
    completed = F.col("status") == "completed"
    ratio = F.try_divide(F.col("retriever_fetched").cast("double"), F.col("retriever_total").cast("double"))
    hits = F.array_compact(F.array(
        F.when(F.col("status") == "failed", "run_failed"),
        F.when(completed & (F.coalesce("discovery_urls", F.lit(0)) == 0), "no_urls"),
        F.when(ratio < min_fetch_ratio, "low_fetch_rate"),
    ))
    return runs.select("project", "site", "schedule_id", F.explode(hits).alias("alert"))


def find_records(df: DataFrame, sites: Sequence[str] | None = None, days: int | None = None,
                 now: Column | None = None, ts: str = "crawled_at", missing: str | None = None) -> DataFrame:
    """Records of some sites, of the last days, with a field missing; each condition is optional."""
    if sites is not None:
        df = df.filter(F.col("site").isin(list(sites)))
    if days is not None:
        df = df.filter(F.col(ts) >= (F.current_timestamp() if now is None else now) - F.make_dt_interval(F.lit(days)))
    if missing is not None:
        df = df.filter(F.col(missing).isNull())
    return df


def price_sanity(df: DataFrame, by: str = "site") -> DataFrame:
    lp, sp, pct = F.col("list_price"), F.col("selling_price"), F.col("discount_percentage")
    return df.groupBy(by).agg(
        F.count("*").alias("rows"),
        F.count_if(sp > lp).alias("sell_above_list"),
        F.count_if(lp.isNull() | sp.isNull()).alias("price_missing"),
        F.count_if((pct < 0) | (pct > 100)).alias("discount_out_of_range"),
    )


def constant_columns(df: DataFrame, fields: Sequence[str], by: str = "site", min_rows: int = 5) -> DataFrame:
    """Fields with one and the same value in every row of a site: min = max, no distinct count needed."""
    aggs = []
    for c in fields:
        aggs += [F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}"), F.count(c).alias(f"__n_{c}")]
    text = lambda c: F.col(c).cast("string")
    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("field"), text(f"__lo_{c}").alias("value"), F.col(f"__n_{c}").alias("rows"),
            (F.col(f"__lo_{c}") == F.col(f"__hi_{c}")).alias("constant"),
        )
        for c in fields
    ])
    return (
        df.groupBy(by).agg(*aggs).select(by, F.inline(pairs))
        .filter(F.col("constant") & (F.col("rows") >= min_rows)).drop("constant")
    )


def _hit(what: str) -> Column:
    level, text = LOG_SEARCHES[what]
    return (F.col("level") == level) & F.contains(F.col("info"), F.lit(text))


def log_search(df: DataFrame, what: str) -> DataFrame:
    return df.filter(_hit(what))


def log_search_counts(df: DataFrame) -> DataFrame:
    """search, n for all searches in one pass over the log."""
    counts = df.agg(*[F.count_if(_hit(what)).alias(what) for what in LOG_SEARCHES])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(what).alias("search"), F.col(what).alias("n")) for what in LOG_SEARCHES])))


def log_tail(df: DataFrame, order: Sequence[str], level: str = "ALL", n: int = 200, line: str = "line") -> DataFrame:
    """Last n lines of a level; lines without any level are kept. Oldest of them first."""
    if level != "ALL":
        any_level = F.lit(False)
        for lv in LEVELS:
            any_level = any_level | F.contains(F.col(line), F.lit(f"[{lv}]"))
        df = df.filter(F.contains(F.col(line), F.lit(f"[{level}]")) | ~any_level)
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def parse_yield(metadata: DataFrame, records: DataFrame, key: str = "schedule_id") -> DataFrame:
    """Pages against records of each run."""
    p = metadata.groupBy(key).agg(F.count("*").alias("pages"))
    r = records.groupBy(key).agg(F.count("*").alias("records"))
    return same_keys(p, r, [key], "left").select(
        key, "pages", F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
        (F.coalesce("records", F.lit(0)) / F.col("pages")).alias("yield"),
    )


def config_report(sites: DataFrame, problems: DataFrame, by: Sequence[str]) -> DataFrame:
    """OK or FAIL for each site with its sorted problem list. `problems` holds config-sized rows."""
    keys = list(by)
    found = problems.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set("problem")), "; ").alias("reasons"), F.count("*").alias("n")
    )
    return sites.select(*keys).distinct().join(found, keys, "left").select(
        *keys,
        F.when(F.col("n").isNull(), "OK").otherwise("FAIL").alias("result"),
        F.coalesce("reasons", F.lit("")).alias("reasons"),
    )


def browse_dlq(dlq: DataFrame, n: int = 50, stage: str | None = None, tie: str = "url") -> DataFrame:
    """Newest n dead letters of each stage, or of one stage."""
    newest_first = [F.desc("failed_at"), F.desc(tie)]
    if stage is not None:
        return dlq.filter(F.col("stage") == stage).orderBy(*newest_first).limit(n)
    return top_per_group(dlq, ["stage"], newest_first, n, spread_by=[tie])


def requeue(dlq: DataFrame, priority: int = 3) -> DataFrame:
    """Dead letters rewritten for another try."""
    return dlq.drop("error", "failed_at").withColumns({
        "retry_count": F.lit(0),
        "priority": F.lit(priority),
        "routing_key": F.concat_ws(
            ".", "stage", F.coalesce("site", F.lit("unknown")), F.coalesce("project", F.lit("unknown"))
        ),
    })


def expire_dlq(dlq: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return dlq.filter(F.col("failed_at") > now - F.make_dt_interval(F.lit(0), F.lit(hours)))
