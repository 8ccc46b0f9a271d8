"""Token counts as rollups maintained by deltas: signed changes, additive totals, batches that commit once."""

from __future__ import annotations

from functools import reduce

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from pageloom.llm.base import file_system, put, written

CHANGE = "kind string, doc_id long, version string, source string, lang string, n_tokens long, seq long"
LEDGER = "doc_id long, version string, source string, lang string, n_tokens long, live boolean"
DELTA = "source string, lang string, version string, documents long, tokens long"


class TokenRollup:
    """Totals of documents and tokens by source, language and tokenizer version, in a folder all executors reach.

    `ledger/<batch>` holds the new state of each (document, version) that the batch changed, `deltas/<batch>` what the
    batch adds to each total, `commits/<batch>` is written last. A batch without a commit is not read, and is overwritten when it
    comes again; a batch with a commit is not applied again. Totals are sums of committed deltas, so old rows are never rewritten.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def committed(self) -> list[int]:
        fs, folder = file_system(f"{self.folder}/commits")
        found = fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        return sorted(int(f.base_name) for f in found if f.base_name.isdigit())

    def _read(self, part: str, schema: str) -> DataFrame:
        """Rows of all committed batches, with their `batch`."""
        frames = [
            self.spark.read.schema(schema).parquet(f"{self.folder}/{part}/{b}").withColumn("batch", F.lit(b)) for b in self.committed()]
        return reduce(DataFrame.unionAll, frames) if frames else self.spark.createDataFrame([], f"{schema}, batch int")

    def state(self) -> DataFrame:
        """The documents that count now: doc_id, version, source, lang, n_tokens."""
        latest = self._read("ledger", LEDGER).groupBy("doc_id", "version").agg(
            F.max_by(F.struct("source", "lang", "n_tokens", "live"), "batch").alias("last"))
        return latest.filter("last.live").select("doc_id", "version", "last.source", "last.lang", "last.n_tokens")

    def totals(self) -> DataFrame:
        """source, lang, version, documents, tokens; groups without a document are left out. Null sources and languages are groups of their own."""
        sums = self._read("deltas", DELTA).groupBy("source", "lang", "version").agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.filter("documents != 0")

    def apply(self, changes: DataFrame, batch: int) -> bool:
        """Apply a batch of changes (kind, doc_id, version, source, lang, n_tokens, seq) once; False if it was committed before.

        `insert` sets the state of a (doc_id, version), whether it is there or not; `revise` does so only if it is there, and `delete` takes it
        away if it is there. Of several changes of one (doc_id, version) in a batch the one with the highest seq counts, of equal seq the
        greatest by kind and values; repeated rows change nothing more. A null count is 0; null ids, versions, sources and languages are
        values like others; rows of any other kind, or none, are ignored. Batches have to come in ascending order of their numbers, so that the latest state is that of
        the highest batch. Other columns are ignored.
        """
        done = self.committed()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after {done[-1]}")
        values = F.struct(
            F.col("seq").cast("long").alias("seq"), "kind", F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens"), "source", "lang")
        asked = changes.filter(F.col("kind").isin("insert", "delete", "revise")).groupBy("doc_id", "version").agg(F.max(values).alias("new"))
        keys = asked.select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"))
        same = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("version").eqNullSafe(F.col("_version"))
        before = self._read("ledger", LEDGER).join(keys, same, "left_semi").groupBy("doc_id", "version").agg(
            F.max_by(F.struct("source", "lang", "n_tokens", "live"), "batch").alias("old")).filter("old.live")
        before = before.select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), "old")
        was = F.col("old").isNotNull()
        kind = F.col("new.kind")
        resolved = asked.join(before, same, "left").filter((kind == "insert") | was).select("doc_id", "version", "new", "old", (kind != "delete").alias("live"))
        resolved.select("doc_id", "version", "new.source", "new.lang", "new.n_tokens", "live", "old").write.mode("overwrite").parquet(
            f"{self.folder}/ledger/{batch}")
        rows = self.spark.read.parquet(f"{self.folder}/ledger/{batch}")
        plus = rows.filter("live").select("source", "lang", "version", F.lit(1).alias("d"), F.col("n_tokens").alias("t"))
        minus = rows.filter("old is not null").select("old.source", "old.lang", "version", F.lit(-1).alias("d"), (-F.col("old.n_tokens")).alias("t"))
        plus.unionAll(minus).groupBy("source", "lang", "version").agg(
            F.sum("d").alias("documents"), F.sum("t").alias("tokens")).write.mode("overwrite").parquet(f"{self.folder}/deltas/{batch}")
        fs, folder = file_system(f"{self.folder}/commits")
        fs.create_dir(folder, recursive=True)
        put(fs, f"{folder}/{batch}", [b""], "tmp")
        return True


WORDS = r"[^\x20\x09-\x0D]+"
RUNS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def counted(docs: DataFrame) -> DataFrame:
    """Each document's tokens under both versions, as it is and without repeated lines, and a digest of its text."""
    text = F.coalesce("text", F.lit(""))
    unique = F.array_join(F.array_distinct(F.split(text, "\n")), "\n")
    return docs.select(
        "doc_id", "source", "lang", F.md5(text.cast("binary")).alias("digest"),
        F.explode(F.array(*(
            F.struct(F.lit(name).alias("version"), F.regexp_count(text, F.lit(pattern)).cast("long").alias("n_tokens"),
                     F.regexp_count(unique, F.lit(pattern)).cast("long").alias("n_unique"))
            for name, pattern in (("words-1", WORDS), ("runs-1", RUNS))))).alias("count"),
    ).select("doc_id", "source", "lang", "digest", "count.*")


def corpus_batches(counts: DataFrame) -> list[DataFrame]:
    """A corpus' changes: all documents come in, exact copies of a document with a lower id go, repeated lines go from the rest."""
    def change(df: DataFrame, kind: str, tokens: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), "doc_id", "version", "source", "lang", F.col(tokens).alias("n_tokens"), F.lit(0).alias("seq"))

    # written, so that both sides of the join are dealt anew and a digest of very many copies can be split
    first = written(counts.groupBy("digest").agg(F.min("doc_id").alias("first")), "firsts")
    copies = counts.join(first, "digest").filter(F.col("doc_id") > F.col("first"))
    return [
        change(counts, "insert", "n_tokens"), change(copies, "delete", "n_tokens"),
        change(counts.filter("n_unique < n_tokens"), "revise", "n_unique")]
