"""Joins of the data model.

Data sides carry no broadcast hint: Spark's size threshold and its run-time
statistics decide, so a grown side falls back to a shuffle join, where skewed
keys are split. Config tables often come without size statistics; they are
broadcast once their row count is checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def attach_pages(metadata: DataFrame, pages: DataFrame, key: str = "url_key") -> DataFrame:
    """Fetch metadata with its page."""
    return metadata.join(pages, key)


def missing_pages(metadata: DataFrame, pages: DataFrame, key: str = "url_key") -> DataFrame:
    """Metadata rows of failed fetches: no page behind them."""
    return metadata.join(pages.select(key), key, "left_anti")


def with_config(df: DataFrame, config: DataFrame, on: Sequence[str] = ("project", "site")) -> DataFrame:
    """No hint: Spark broadcasts the configuration while it is below the size threshold, and shuffles it beyond."""
    return df.join(config, list(on))


def overlay(base: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Merge two sources; a key in `top` takes all its values from `top`. A NULL key is a key of its own."""
    rest = [c for c in base.columns if c != key]
    t = top.select(key, *rest, F.lit(True).alias("__t")).alias("t")
    b = base.alias("b")
    picked = [F.when(F.col("t.__t"), F.col(f"t.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in rest]
    source = F.when(F.col("t.__t"), "top").otherwise("base").alias("source")
    same = F.col(f"b.{key}").eqNullSafe(F.col(f"t.{key}"))
    return b.join(t, same, "full_outer").select(F.coalesce(f"b.{key}", f"t.{key}").alias(key), *picked, source)


def missing_rules(fields: DataFrame, rules: DataFrame, on: Sequence[str]) -> DataFrame:
    """Declared fields without a rule, and rules without a declared field."""
    keys = list(on)
    no_rule = fields.select(*keys).distinct().join(rules.select(*keys), keys, "left_anti")
    no_field = rules.select(*keys).distinct().join(fields.select(*keys), keys, "left_anti")
    return no_rule.withColumn("problem", F.lit("no_rule")).unionByName(no_field.withColumn("problem", F.lit("no_field")))


def site_matrix(sites: DataFrame, parts: dict[str, DataFrame], outputs: DataFrame, key: str = "site") -> DataFrame:
    """Which parts a site has, and how many output files."""
    result = sites.select(key).distinct()
    for name, part in parts.items():
        present = part.select(key).distinct().withColumn(f"has_{name}", F.lit(True))
        result = result.join(present, key, "left").withColumn(f"has_{name}", F.coalesce(f"has_{name}", F.lit(False)))
    counts = outputs.groupBy(key).agg(F.count("*").alias("outputs"))
    return result.join(counts, key, "left").withColumn("outputs", F.coalesce("outputs", F.lit(0)).cast("bigint"))


def resolve_refs(entities: DataFrame, targets: DataFrame, ref: str, target_key: str) -> DataFrame:
    """Follow an entity reference that is held as rows."""
    return entities.join(targets, F.col(ref) == F.col(target_key), "left")


def live_workers(heartbeats: DataFrame, now: Column, alive_s: int = 90) -> DataFrame:
    """Last heartbeat of each worker that is less than `alive_s` old at `now`."""
    last = heartbeats.groupBy("hostname", "worker_id").agg(F.max("ts").alias("last_seen"))
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_seen").cast("timestamp"))
    return last.filter(age < alive_s * 1_000_000)


def worker_view(heartbeats: DataFrame, jobs: DataFrame, now: Column, alive_s: int = 90) -> DataFrame:
    """Live workers with their latest job, if any."""
    latest = jobs.groupBy("hostname", "worker_id").agg(F.max_by("job", F.struct("ts", "job")).alias("job"))
    return (
        live_workers(heartbeats, now, alive_s)
        .join(latest, ["hostname", "worker_id"], "left")
        .orderBy("hostname", "worker_id")
    )
