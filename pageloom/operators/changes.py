"""Content-change detection between crawls. Only hashes are joined, never page text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pageloom.operators.scans import lag_by_time, same_keys
from pageloom.sources.state import StateTable


def content_hash(c: Column) -> Column:
    return F.md5(F.encode(c, "UTF-8"))


def _change_type(old: Column, new: Column) -> Column:
    return F.when(old.isNull(), "new").when(old == new, "unchanged").otherwise("modified")


def detect_changes(state: DataFrame, batch: DataFrame, key: str = "url") -> DataFrame:
    """`state`: key, hash; `batch`: key, hash. One result row for each batch row."""
    known = state.select(key, F.col("hash").alias("old_hash"))
    kind = _change_type(F.col("old_hash"), F.col("new_hash"))
    return same_keys(batch.select(key, F.col("hash").alias("new_hash")), known, [key], "left").select(
        key, kind.alias("change_type"), "old_hash", "new_hash", (kind != "unchanged").alias("changed"))


def advance_state(state: DataFrame, batch: DataFrame, now: Column, key: str = "url") -> DataFrame:
    """State after a crawl: key, hash, first_seen, last_crawled, change_count."""
    s, b = state.alias("s"), batch.select(F.col(key), F.col("hash")).alias("b")
    seen = F.col("b.hash").isNotNull()
    moved = seen & F.col("s.hash").isNotNull() & (F.col("s.hash") != F.col("b.hash"))
    return s.join(b, F.col(f"s.{key}").eqNullSafe(F.col(f"b.{key}")), "full_outer").select(
        F.coalesce(f"s.{key}", f"b.{key}").alias(key),
        F.coalesce("b.hash", "s.hash").alias("hash"),
        F.coalesce(F.col("s.first_seen"), now).alias("first_seen"),
        F.when(seen, now).otherwise(F.col("s.last_crawled")).alias("last_crawled"),
        (F.coalesce(F.col("s.change_count"), F.lit(0)) + F.when(moved, 1).otherwise(0)).cast("bigint").alias("change_count"),
    )


STATE = "url string, hash string, first_seen timestamp, last_crawled timestamp, change_count bigint"


def merge_crawl(table: StateTable, batch: DataFrame, now: Column, number: int | str, ttl_days: int | None = None) -> bool:
    """Advance a state table by one crawl: only the buckets of the crawled URLs are read and written.

    A URL twice in the batch counts once, with its greatest hash. With `ttl_days`, rows of touched buckets that were not crawled for so long go.
    """
    key = table.key[0]

    def step(state: DataFrame, rows: DataFrame) -> DataFrame:
        live = state if ttl_days is None else expire_state(state, now, ttl_days)
        return advance_state(live, rows.groupBy(key).agg(F.max("hash").alias("hash")), now, key)

    return table.merge(batch.select(key, "hash"), step, number)


def expire_state(state: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Drop URLs not crawled for `days`, by event time. (The streaming form uses processing time.)"""
    return state.filter(F.col("last_crawled") > now - F.make_dt_interval(F.lit(days)))


def detect_changes_ordered(state: DataFrame, batch: DataFrame, ts: str, tie: str, key: str = "url",
                           chunk_s: int = 24 * 3600) -> DataFrame:
    """Several versions of a URL in one batch, applied in time order; the first meets the state."""
    lagged = lag_by_time(batch, [key], [ts, tie], "hash", ts, "__before", chunk_s)
    known = state.select(key, F.col("hash").alias("__state"))
    old = F.coalesce(F.col("__before"), F.col("__state"))
    kind = _change_type(old, F.col("hash"))
    return same_keys(lagged, known, [key], "left").select(
        key, ts, tie, kind.alias("change_type"), old.alias("old_hash"), F.col("hash").alias("new_hash"),
        (kind != "unchanged").alias("changed"),
    )


def changed_pages(pages: DataFrame, changes: DataFrame, key: str = "url") -> DataFrame:
    """Pages that need parsing."""
    return pages.join(changes.filter("changed").select(key), key, "left_semi")


def change_stats(state: DataFrame) -> DataFrame:
    return state.agg(
        F.count("*").alias("total_urls"), F.coalesce(F.sum("change_count"), F.lit(0)).cast("bigint").alias("total_changes")
    )
