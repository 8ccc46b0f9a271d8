"""Run history analytics over the flattened `runs` table (see `pageloom.schemas`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

PROGRESS = [
    "discovery_urls", "retriever_total", "retriever_fetched", "parser_pages", "parser_pages_done", "parser_records",
]
STAGES = ["discovery", "retriever", "parser"]


def run_key(project: Column, site: Column, schedule_id: Column) -> Column:
    return F.concat_ws("__", project, site, schedule_id)


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def _pct(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double") * 100, whole.cast("double")), F.lit(0.0))


def run_kpis(runs: DataFrame) -> DataFrame:
    return runs.agg(
        _total("parser_records").alias("total_records"),
        _total("retriever_fetched").alias("total_pages"),
        _total("discovery_urls").alias("total_urls"),
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == "completed").alias("completed_runs"),
    ).withColumn("success_pct", _pct(F.col("completed_runs"), F.col("total_runs")))


def stage_counts(runs: DataFrame, project: str | None = None, site: str | None = None,
                 schedule_id: str | None = None) -> DataFrame:
    """Counts by stage; each filter is optional and reaches the scan."""
    for name, wanted in (("project", project), ("site", site), ("schedule_id", schedule_id)):
        if wanted is not None:
            runs = runs.filter(F.col(name) == wanted)
    return runs.agg(
        _total("discovery_urls").alias("discovery"),
        _total("retriever_fetched").alias("retriever"),
        _total("parser_records").alias("parser"),
        F.count("*").alias("runs"),
    )


def records_by_site(runs: DataFrame, k: int = 15) -> DataFrame:
    return (
        runs.groupBy("site", "project").agg(_total("parser_records").alias("records"))
        .orderBy(F.desc("records"), "site", "project").limit(k)
    )


def funnel(runs: DataFrame) -> DataFrame:
    """discovered -> fetched -> parsed with % of the step before and of the first."""
    totals = runs.agg(
        _total("discovery_urls").alias("u"), _total("retriever_fetched").alias("p"), _total("parser_records").alias("r")
    )
    step = lambda no, name, n, before: F.struct(
        F.lit(no).alias("step"), F.lit(name).alias("stage"), n.alias("n"),
        _pct(n, before).alias("pct_of_previous"), _pct(n, F.col("u")).alias("pct_of_first"),
    )
    return totals.select(F.inline(F.array(
        step(1, "discovered", F.col("u"), F.col("u")),
        step(2, "fetched", F.col("p"), F.col("u")),
        step(3, "parsed", F.col("r"), F.col("p")),
    )))


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    return newest(runs, ["completed_at", "schedule_id"], n).select(
        F.right(F.col("schedule_id"), F.lit(8)).alias("run"), "parser_records", "retriever_fetched", "site", "status"
    )


def status_counts(df: DataFrame, by: str = "status") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"))


def durations(runs: DataFrame) -> DataFrame:
    """Run time and time per page, by site."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    seconds = (micros("completed_at") - micros("started_at")) / F.lit(1e6)
    return (
        runs.withColumn("__s", seconds).groupBy("site")
        .agg(
            F.count("__s").alias("runs"),
            F.sum("__s").alias("total_s"),
            F.avg("__s").alias("avg_s"),
            F.sum("retriever_fetched").alias("pages"),
        )
        .withColumn("s_per_page", F.try_divide(F.col("total_s"), F.col("pages")))
    )


def doc_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("docs"))


def sites_per_project(config: DataFrame) -> DataFrame:
    """Distinct sorted sites; config tables hold one row for each site."""
    return config.groupBy("project").agg(
        F.array_sort(F.collect_set("site")).alias("sites"), F.countDistinct("site").alias("n_sites")
    )


def progress_pct(tasks: DataFrame, by: str = "phase", done: str = "done") -> DataFrame:
    """Whole-percent progress for each phase and, with a NULL phase, overall."""
    return tasks.rollup(by).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == done).alias("done"),
    ).withColumn("pct", F.floor(F.col("done") * 100 / F.col("total")).cast("int"))


def fill_rate(df: DataFrame, fields: Sequence[str], by: str = "site") -> DataFrame:
    """Share of non-NULL values for each site and field, in one pass."""
    rates = [F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in fields]
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("rate")) for c in fields])
    return df.groupBy(by).agg(*rates).select(by, F.inline(pairs))


def batch_totals(df: DataFrame, name: str = "product_name") -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_if(F.coalesce(F.col(name), F.lit("")) != "").alias("ok"))


def newest(df: DataFrame, order: Sequence[str], n: int = 50) -> DataFrame:
    """Newest first; `order` ends in a unique column. Runs as a distributed top-n."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def custom_order(df: DataFrame, column: str, ranks: Sequence[str], then: Sequence[str] = ()) -> DataFrame:
    """Order by the place in `ranks`; other values come last."""
    place = F.lit(len(ranks))
    for i in reversed(range(len(ranks))):
        place = F.when(F.col(column) == ranks[i], F.lit(i)).otherwise(place)
    return df.withColumn("sort_rank", place).orderBy("sort_rank", *then)
