"""Chat formatting by rotation: each participant in turn is the assistant, the others are named users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pageloom.llm.base import quoted, written

SYSTEM = "system"  # speaks in every rendering, but is nobody's perspective
UNKNOWN = "unknown"  # name of a speaker without a role; nobody's perspective either
END = "<|end|>"


def header(speaker: Column, perspective: Column) -> Column:
    return F.when(speaker == SYSTEM, F.lit("<|system|>")).when(speaker == perspective, F.lit("<|assistant|>")).otherwise(
        F.concat(F.lit("<|user name="), F.replace(escaped(speaker), F.lit("|>"), F.lit("|\\>")), F.lit("|>")))


def escaped(text: Column) -> Column:
    """Markers inside a text are no markers."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def rotate(turns: DataFrame) -> DataFrame:
    """One row for each turn of each rendering: conv_id, perspective, turn, segment, start, stop, mask_start, mask_stop.

    A rendering of a conversation is its segments one after the other; `start` and `stop` are the segment's place in it, counted in characters. In the
    perspective's own turns text and end mark are to be learned: mask_start and mask_stop give their place, both are null elsewhere.

    Every speaker but `system` gets a rendering; a conversation of system turns alone has none. Markers in a text or a name are escaped. Turns without a role are spoken by the user
    `unknown`. Null texts are empty. Turns come in order of turn (null first), role and text; ties and repeated rows are all kept, one after the
    other. Turns without a conv_id make up one conversation. Columns other than conv_id, turn, role and text are ignored.

    A conversation may hold any share of all turns: rows are dealt by range of (conversation, perspective, turn), offsets are running sums within
    a range, and what a conversation has in earlier ranges is added from one total for each range.
    """
    rows = turns.select(
        F.col(quoted("conv_id")).alias("conv_id"), F.col(quoted("turn")).cast("long").alias("turn"),
        F.coalesce(F.col(quoted("role")).cast("string"), F.lit(UNKNOWN)).alias("speaker"), F.col(quoted("text")).cast("string").alias("text"))
    perspectives = rows.filter(~F.col("speaker").isin(SYSTEM, UNKNOWN)).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    rendered = rows.join(perspectives, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    top = header(F.col("speaker"), F.col("perspective"))
    rendered = rendered.select(
        "conv_id", "perspective", "turn", "speaker", F.concat(top, F.lit("\n"), escaped(F.col("text")), F.lit(f"{END}\n")).alias("segment"),
        (F.length(top) + 1).alias("_top"))
    order = ("conv_id", "perspective", "turn", "speaker", "segment", "_row")
    ranged = written(
        rendered.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id()).withColumn("_length", F.length("segment").cast("long")), "segments")
    group = ("conv_id", "perspective")
    totals = ranged.groupBy(*group, "_range").agg(F.sum("_length").alias("_total"))
    before = totals.withColumn("_before", F.sum("_total").over(
        Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.filter("_before is not null").select(
        F.col("conv_id").alias("_conv"), F.col("perspective").alias("_by"), F.col("_range").alias("_of"), "_before")
    here = Window.partitionBy(*group, "_range").orderBy("turn", "speaker", "segment", "_row").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_stop", F.sum("_length").over(here)).join(
        before, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("perspective") == F.col("_by")) & (F.col("_range") == F.col("_of")), "left")
    stop = F.col("_stop") + F.coalesce("_before", F.lit(0))
    start, own = stop - F.col("_length"), F.col("speaker") == F.col("perspective")
    return summed.select(
        "conv_id", "perspective", "turn", "segment", start.alias("start"), stop.alias("stop"),
        F.when(own, start + F.col("_top")).alias("mask_start"), F.when(own, stop - 1).alias("mask_stop"))
