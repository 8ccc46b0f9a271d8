"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pageloom.llm.base import id_and_text, quoted

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from has he in is it its of on or that the this to was were will with you "
    "das dem den der des die ein eine er es für ich im ist mit nicht sie sich und von zu auf als auch "
    "au aux avec ce ces dans de du elle en est et il la le les ne pas pour que qui sur un une "
    "al como con del el las lo los más no para por se su una y o"
).split()


@dataclass(frozen=True)
class Threshold:
    """`percent_min <= 100 * numerator / denominator <= percent_max`, asked of texts of `from_words` words or more."""

    name: str
    numerator: str
    denominator: str
    percent_min: int | None = None
    percent_max: int | None = None
    from_words: int = 10


THRESHOLDS = (
    Threshold("word_length", "word_chars", "n_words", percent_min=150, percent_max=2000),
    Threshold("symbols_per_word", "n_symbols", "n_words", percent_max=40),
    Threshold("bangs_per_word", "n_bangs", "n_words", percent_max=40),
    Threshold("stop_words", "n_stop_words", "n_words", percent_min=2, from_words=60),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", percent_max=50),
)


def failed(rule: Threshold) -> Column:
    """True where the text breaks the rule; integer arithmetic, so no rounding decides."""
    top, bottom = 100 * F.col(rule.numerator), F.col(rule.denominator)
    breaks = F.lit(False)
    if rule.percent_min is not None:
        breaks = breaks | (top < rule.percent_min * bottom)
    if rule.percent_max is not None:
        breaks = breaks | (top > rule.percent_max * bottom)
    return (F.col("n_words") >= rule.from_words) & breaks


def _window_hashes(size: int) -> Column:
    hashes = F.col("_hashes")
    return F.when(F.size(hashes) >= size, F.transform(
        F.slice(hashes, F.lit(1), F.size(hashes) - size + 1),
        lambda h, i: F.xxhash64(h, *(F.get(F.col("_hashes"), i + k) for k in range(1, size))),
    ))


def _with_counts(rows: DataFrame, stop_words: list[str], window: int) -> DataFrame:
    """`rows` has `_row` (whatever is to be kept) and `text`; the counts are added, the text is dropped."""
    text = F.col("text")
    words = F.col("_words")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def removed(chars: str) -> Column:
        return F.length(text) - F.length(F.translate(text, chars, ""))

    def near(k: int):
        return lambda x, i: F.get(F.col("_sorted"), i + k)["h"].eqNullSafe(x["h"])

    same_as_neighbour = lambda x, i: near(1)(x, i) | ((i > 0) & near(-1)(x, F.greatest(i, F.lit(1))))
    covered = F.aggregate(
        F.transform("_places", lambda p, i: F.least(
            F.lit(window), F.coalesce(F.get(F.col("_places"), i + 1) - p, F.lit(window)))),
        F.lit(0).cast("long"), lambda total, n: total + n.cast("long"),
    )
    return (
        rows.withColumn("text", F.coalesce("text", F.lit("")))
        .select("_row", "text", F.regexp_extract_all("text", F.lit(WORD), 0).alias("_words"), lines.alias("_lines"))
        .select(
            "_row", F.size(words).cast("long").alias("n_words"),
            (F.length(text) - removed_spaces(text)).cast("long").alias("word_chars"),
            removed(SYMBOLS).cast("long").alias("n_symbols"), removed("!").cast("long").alias("n_bangs"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(stop_words))).cast("long").alias("n_stop_words"),
            F.transform(words, lambda w: F.xxhash64(w)).alias("_hashes"),
        )
        .withColumn("_windows", _window_hashes(window))
        .withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows"))
        .withColumn("_sorted", F.when(F.col("_repeats"), F.sort_array(
            F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("_places", F.when(F.col("_repeats"), F.sort_array(
            F.transform(F.filter("_sorted", same_as_neighbour), lambda x: x["i"]))))
        .withColumn("n_repeat_words", F.when(F.col("_repeats"), covered).otherwise(F.lit(0)).cast("long"))
        .drop("_hashes", "_windows", "_repeats", "_sorted", "_places")
    )


def removed_spaces(text: Column) -> Column:
    """Number of white-space characters."""
    return F.length(text) - F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))


def _with_verdict(counts: DataFrame, thresholds: tuple[Threshold, ...]) -> DataFrame:
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    broken = F.filter(
        F.array(*(F.when(failed(rule), F.lit(rule.name)) for rule in thresholds)), lambda name: name.isNotNull()
    ) if thresholds else F.array().cast("array<string>")
    return counts.withColumn("base_failed", base).withColumn("broken", broken).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0))


def quality_rules(
    docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS, stop_words: list[str] = STOP_WORDS, window: int = 5
) -> DataFrame:
    """One row for each document: doc_id, the counts, `base_failed`, the names of the broken rules and `kept`.

    A document is kept if it has ten words or more, at most a fifth of its words lie in repeated windows,
    and it breaks no rule of the table. Null and empty texts have no words and all counts 0, and fail the base.
    Repeated rows are judged each for itself; a null doc_id stays null; an empty table gives no rows. Columns other
    than doc_id and text are ignored. Repeated windows are told apart by 64-bit hashes, and only texts that
    repeat one are put in order.
    """
    rows = id_and_text(docs).select(F.struct("doc_id").alias("_row"), "text")
    judged = _with_verdict(_with_counts(rows, stop_words, window), thresholds)
    return judged.select("_row.doc_id", *(c for c in judged.columns if c != "_row"))


def keep_good(
    docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS, stop_words: list[str] = STOP_WORDS, window: int = 5
) -> DataFrame:
    """The documents that the rules keep, with all columns they came with, whatever their names.

    The row number keeps the filter above the projection: pushed below, each use of a count would work it out again.
    """
    rows = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("_row"))
    rows = rows.withColumn("text", F.col("_row.text").cast("string"))
    judged = _with_verdict(_with_counts(rows, stop_words, window), thresholds).select(
        "_row", "kept", F.monotonically_increasing_id().alias("_number"))
    return judged.filter("kept and _number >= 0").select(*(F.col(f"_row.{quoted(c)}").alias(c) for c in docs.columns))
