"""Ordered scans over long groups, split into time chunks.

A window partitioned by one key puts the whole history of that key into one
task. Here a group is first cut into (key, chunk) pieces by time; each piece is
scanned on its own, one summary row is kept for each piece, and the summaries
are combined in order. The results are exact; only the summaries of a key, one
row for each chunk, meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

HOUR = 3600
CHUNK = "__chunk"
KEY = "__key"


def key_of(keys: Sequence[str]) -> Column:
    """The key columns as one text that is never NULL, so that rows with a NULL key meet in joins and windows like others."""
    return F.to_json(F.struct(*[F.col(k) for k in keys])).alias(KEY)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on key columns where NULL equals NULL; the columns of `right` come without the keys."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def time_chunk(ts: Column, width_s: int = HOUR) -> Column:
    """Number of the piece a time falls into; rows without a time share piece -1.

    Never NULL, so no join adds a filter on it and both sides can share one shuffle.
    """
    return F.coalesce(F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(width_s * 1_000_000)).cast("bigint"), F.lit(-1))


def decayed_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, alpha: float,
                 init: float, ts: str, out: str, chunk_s: int = HOUR) -> DataFrame:
    """r <- alpha*x + (1-alpha)*r in `order`, from `init`, for each key.

    The recurrence is linear, so a chunk of n rows maps r to (1-alpha)^n * r + b
    and chunks compose.
    """
    keep = 1.0 - alpha
    pieces = df.select(*keys, *order, value.cast("double").alias("__x"), time_chunk(F.col(ts), chunk_s).alias(CHUNK))
    back = F.row_number().over(W.partitionBy(*keys, CHUNK).orderBy(*[F.desc(c) for c in order])) - 1
    parts = (
        pieces.withColumn("__back", back)
        .groupBy(*keys, CHUNK)
        .agg(F.count("*").alias("__n"), F.sum(alpha * F.col("__x") * F.pow(F.lit(keep), F.col("__back"))).alias("__b"))
    )
    later = W.partitionBy(*keys).orderBy(F.desc(CHUNK)).rowsBetween(W.unboundedPreceding, -1)
    return (
        parts.withColumn("__after", F.coalesce(F.sum("__n").over(later), F.lit(0)))
        .groupBy(*keys)
        .agg(
            (
                F.sum(F.col("__b") * F.pow(F.lit(keep), F.col("__after")))
                + F.lit(float(init)) * F.pow(F.lit(keep), F.sum("__n"))
            ).alias(out)
        )
    )


def fail_streak(df: DataFrame, keys: Sequence[str], order: Sequence[str], ok: Column, ts: str, out: str,
                chunk_s: int = HOUR) -> DataFrame:
    """Add for each row the number of failures since the last success, itself included. Rows with a NULL key are a key of their own."""
    w = W.partitionBy(KEY, CHUNK).orderBy(*order)
    rows = (
        df.withColumn("__ok", ok)
        .withColumn(KEY, key_of(keys))
        .withColumn(CHUNK, time_chunk(F.col(ts), chunk_s))
        .withColumn("__rn", F.row_number().over(w))
        .withColumn("__last_ok", F.max(F.when(F.col("__ok"), F.col("__rn"))).over(w.rowsBetween(W.unboundedPreceding, 0)))
    )
    summary = rows.groupBy(KEY, CHUNK).agg(
        F.count("*").alias("__n"),
        F.max(F.when(F.col("__ok"), F.col("__rn"))).alias("__ok_at"),
    )
    by_chunk = W.partitionBy(KEY).orderBy(CHUNK)
    island = F.sum(F.col("__ok_at").isNotNull().cast("int")).over(by_chunk)
    ends = summary.withColumn("__g", island)
    trailing = F.sum(F.col("__n") - F.coalesce(F.col("__ok_at"), F.lit(0))).over(
        W.partitionBy(KEY, "__g").orderBy(CHUNK).rowsBetween(W.unboundedPreceding, 0)
    )
    carry = (
        ends.withColumn("__end", trailing)
        .withColumn("__carry", F.coalesce(F.lag("__end").over(by_chunk), F.lit(0)))
        .select(KEY, CHUNK, "__carry")
    )
    streak = F.col("__rn") - F.coalesce(F.col("__last_ok"), F.lit(0)) + F.when(
        F.col("__last_ok").isNull(), F.col("__carry")
    ).otherwise(F.lit(0))
    return (
        rows.join(carry, [KEY, CHUNK])
        .withColumn(out, streak.cast("bigint"))
        .drop("__ok", "__rn", "__last_ok", "__carry", CHUNK, KEY)
    )


def lag_by_time(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, ts: str, out: str,
                chunk_s: int = 24 * HOUR) -> DataFrame:
    """Add the value of the previous row of the key; the first row of a chunk looks into earlier chunks.

    Rows with a NULL key are a key of their own.
    """
    pieces = df.withColumn(KEY, key_of(keys)).withColumn(CHUNK, time_chunk(F.col(ts), chunk_s))
    w = W.partitionBy(KEY, CHUNK).orderBy(*order)
    rows = pieces.withColumn("__rn", F.row_number().over(w)).withColumn("__prev", F.lag(value).over(w))
    # from the windowed rows, which are partitioned for this already
    ends = rows.groupBy(KEY, CHUNK).agg(F.max_by(F.col(value), F.col("__rn")).alias("__end"))
    carry = ends.select(
        KEY, CHUNK, F.lag("__end").over(W.partitionBy(KEY).orderBy(CHUNK)).alias("__carry")
    )
    return (
        rows.join(carry, [KEY, CHUNK])
        .withColumn(out, F.when(F.col("__rn") == 1, F.col("__carry")).otherwise(F.col("__prev")))
        .drop("__rn", "__prev", "__carry", CHUNK, KEY)
    )


def rolling_by_time(df: DataFrame, keys: Sequence[str], ts: str, seconds_back: int, conditions: dict[str, Column],
                    chunk_s: int = HOUR) -> DataFrame:
    """For each row, the percentage of true among the rows of the last `seconds_back` seconds where a condition is not NULL, inclusive at both ends.

    A row enters the counts at its time and leaves them behind its last second, so counts run on from row to row and no frame is gone through again
    for each row. Rows near the end of a chunk are also sent to the next one as context, so no frame crosses a task.
    """
    if seconds_back > chunk_s:
        raise ValueError("the frame must not be longer than a chunk")
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    width, back = F.lit(chunk_s * 1_000_000), F.lit(seconds_back * 1_000_000)
    rows = df.withColumns({f"__is_{name}": c.cast("boolean") for name, c in conditions.items()}).withColumn("__us", micros)
    rows = rows.withColumn(CHUNK, F.floor(F.col("__us") / width).cast("bigint"))
    end, leaves = (F.col(CHUNK) + 1) * width, F.col("__us") + back + 1
    step = lambda own, at, later, sign: F.struct(
        F.lit(own).alias("own"), at.alias("at"), (F.col(CHUNK) + later).alias("chunk"), F.lit(sign).alias("sign"))
    # the row itself; where it leaves in its own chunk; or else, as context of the next chunk, where it enters there and leaves
    others = F.when(leaves < end, F.array(step(False, leaves, 0, -1))).otherwise(
        F.array(step(False, F.col("__us"), 1, 1), step(False, leaves, 1, -1)))
    steps = F.when(F.col("__us").isNull(), F.array(step(True, F.col("__us"), 0, 1))).otherwise(
        F.concat(F.array(step(True, F.col("__us"), 0, 1)), others))
    rows = rows.withColumn("__step", F.explode(steps)).withColumn(CHUNK, F.col("__step.chunk")).withColumn("__at", F.col("__step.at"))
    running = W.partitionBy(*keys, CHUNK).orderBy("__at").rangeBetween(W.unboundedPreceding, 0)
    sign = F.col("__step.sign")
    for name in conditions:
        is_so = F.col(f"__is_{name}")
        hits = F.sum(F.when(is_so, sign).otherwise(0)).over(running)
        seen = F.sum(F.when(is_so.isNotNull(), sign).otherwise(0)).over(running)
        rows = rows.withColumn(name, F.try_divide(hits * F.lit(100.0), seen.cast("double")))
    return rows.filter("__step.own").drop("__us", "__at", "__step", CHUNK, *[f"__is_{name}" for name in conditions])


def position_by_level(df: DataFrame, level: str, ts: str, tie: str, out: str, chunk_s: int = 24 * HOUR) -> DataFrame:
    """1-based place in the total order (level descending, NULL last, then time, then tie), computed piecewise."""
    local = F.row_number().over(W.partitionBy(KEY, CHUNK).orderBy(ts, tie))
    rows = df.withColumn(KEY, key_of([level])).withColumn(CHUNK, time_chunk(F.col(ts), chunk_s)).withColumn("__local", local)
    # from the numbered rows, which are partitioned for this already
    counts = rows.groupBy(KEY, CHUNK).agg(F.max("__local").cast("bigint").alias("__n"), F.first(level).alias("__level"))
    before_in_level = W.partitionBy(KEY).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    # one row for each level: the only step with a single task
    totals = counts.groupBy(KEY).agg(F.sum("__n").alias("__t"), F.first("__level").alias("__level"))
    higher = totals.select(
        KEY,
        F.coalesce(F.sum("__t").over(W.orderBy(F.desc("__level")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__h"),
    )
    offsets = (
        counts.withColumn("__b", F.coalesce(F.sum("__n").over(before_in_level), F.lit(0)))
        .join(higher, KEY)
        .select(KEY, CHUNK, (F.col("__b") + F.col("__h")).alias("__off"))
    )
    return (
        rows.join(offsets, [KEY, CHUNK])
        .withColumn(out, (F.col("__local") + F.col("__off")).cast("bigint"))
        .drop("__local", "__off", CHUNK, KEY)
    )


def rank_by_number(df: DataFrame, keys: Sequence[str], number: str, out: str, width: int = 10_000) -> DataFrame:
    """1-based rank by a numeric position that is unique in its group; long groups are cut every `width` positions."""
    rows = df.withColumn(KEY, key_of(keys)).withColumn(CHUNK, F.coalesce(F.floor(F.col(number) / F.lit(width)).cast("bigint"), F.lit(-1)))
    rows = rows.withColumn("__local", F.row_number().over(W.partitionBy(KEY, CHUNK).orderBy(number)))
    before = W.partitionBy(KEY).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(KEY, CHUNK).agg(F.max("__local").cast("bigint").alias("__n"))
        .select(KEY, CHUNK, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    )
    return (
        rows.join(offsets, [KEY, CHUNK])
        .withColumn(out, (F.col("__local") + F.col("__off")).cast("int"))
        .drop("__local", "__off", CHUNK, KEY)
    )


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int = 32,
                  spread_by: Sequence[str] = ()) -> DataFrame:
    """First n rows of each group.

    Up to Spark's limit for it, every map task drops all but its own first n rows
    of a group before the shuffle. Beyond that, groups are first cut into salted
    pieces, so a hot group uses many tasks.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        salt = F.pmod(F.xxhash64(*(spread_by or df.columns)), F.lit(salts))
        head = F.row_number().over(W.partitionBy(*keys, "__salt").orderBy(*order))
        df = df.withColumn("__salt", salt).withColumn("__r", head).filter(F.col("__r") <= n).drop("__salt")
    return df.withColumn("__r", place).filter(F.col("__r") <= n).drop("__r")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """One row for each key, the first (or last) in `order`, by a map-side combined aggregate."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)
