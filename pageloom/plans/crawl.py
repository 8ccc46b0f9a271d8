"""Whole-flow plans: frontier to records, and the page digest used as the flagship."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pageloom.functions import classify as C, html as H, urls as U
from pageloom.operators import changes as CH, extraction as X, frontier as FR


def records_of_crawl(seeds: DataFrame, pages: DataFrame, config: DataFrame, methods: Sequence[str], rule_set: Column,
                     state: DataFrame | None = None, rule_sets: dict | None = None, min_len: int = C.MIN_PAGE_LENGTH) -> DataFrame:
    """Seeds to records. `rule_set` is a column over url.

    Only pages of the frontier's URLs are looked at; of these, blocked and unchanged ones are dropped before
    any page is parsed (`rejected_pages` tells the blocked ones), and records, not pages, are joined with the frontier.
    """
    found = FR.expand_frontier(seeds, pages, config, methods).select("project", "site", "schedule_id", "url")
    wanted = FR.dedup_in_run(found, ("project", "site", "schedule_id", "url"))
    asked = wanted.select("url").distinct()
    usable = pages.join(asked, "url", "left_semi").filter(~C.is_blocked(F.lit(200), F.col("html"), min_len))
    if state is not None:
        batch = usable.select("url", CH.content_hash(F.col("html")).alias("hash"))
        usable = CH.changed_pages(usable, CH.detect_changes(state, batch))
    records = X.extract_fields(usable.withColumn("rule_set", rule_set), rule_sets)
    return wanted.withColumnRenamed("url", "page_url").join(records, "page_url")


def rejected_pages(pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), min_len: int = C.MIN_PAGE_LENGTH) -> DataFrame:
    """The pages that the other plans leave out, with the reason: short, or block text."""
    reason = C.block_reason(F.lit(200), F.col("html"), min_len)
    return pages.select(*keep, reason.alias("reason")).filter(F.col("reason").isNotNull())


def domain_digest(pages: DataFrame, top: int = 20, min_len: int = C.MIN_PAGE_LENGTH) -> DataFrame:
    """Usable pages, one for each distinct content, counted by domain. `rejected_pages` are the others.

    Page text is reduced to a hash and two lengths before the only wide shuffle.
    """
    html = F.col("html")
    slim = pages.filter(~C.is_blocked(F.lit(200), html, min_len)).select(
        "page_id", U.domain(F.col("url")).alias("domain"), CH.content_hash(html).alias("hash"),
        F.length(H.title(html)).alias("title_len"), F.length(H.container_text(html, "article")).alias("text_len"),
    )
    firsts = slim.groupBy("hash").agg(
        F.min(F.struct("page_id", "domain", "title_len", "text_len")).alias("p")
    ).select("p.*")
    return (
        firsts.groupBy("domain")
        .agg(
            F.count("*").alias("docs"),
            F.sum("text_len").cast("bigint").alias("text_chars"),
            F.round(F.avg("title_len"), 6).alias("avg_title_len"),
        )
        .orderBy(F.desc("docs"), "domain").limit(top)
    )
