"""Streams whose state is a bucketed table: each micro-batch is folded by built-ins first, and what reaches the state is one small row for each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pageloom.operators import changes as CH, health as HE
from pageloom.operators.scans import first_per_key
from pageloom.sources.state import StateTable

CHANGE_STATE = "url string, hash string, last_seen timestamp"
HEALTH_STATE = "endpoint bigint, ema_rate double, ema_latency_ms double, consecutive_fails bigint, total_requests bigint, last_ts timestamp"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def _replaced(key: str):
    """State with the rows of the given keys in place of their own."""

    def step(state: DataFrame, rows: DataFrame) -> DataFrame:
        others = state.alias("s").join(rows.select(F.col(key).alias("__k")), F.col(f"s.{key}").eqNullSafe(F.col("__k")), "left_anti")
        return others.unionByName(rows.select(*state.columns))

    return step


def _stateful(df: DataFrame, purpose: str, schema: str, key: str, buckets: int, fold) -> tuple[DataFrame, DataFrame]:
    """Run `fold(state of the touched buckets, batch) -> (output, new state rows)` over all input there is; all outputs, and the state.

    A batch first writes its output and its state rows to folders of its own, then the state table takes the rows under the batch's number. A replayed batch
    finds its number there and does nothing, or else starts from the state as it was before.
    """
    from pageloom.streaming.streams import run_batches

    spark = df.sparkSession

    def handle(batch: DataFrame, batch_id: int, out: str) -> None:
        table = StateTable(batch.sparkSession, f"{out}/state", schema, key, buckets)
        if table.holds(batch_id):
            return
        output, rows = fold(table.read_for(batch), batch)
        output.write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")
        saved = batch.sparkSession.read.schema(table.schema).parquet(f"{out}/rows/batch_id={batch_id}")
        table.merge(saved, _replaced(key), batch_id)
        table.vacuum()

    out = run_batches(df, purpose, handle)
    return spark.read.parquet(f"{out}/data"), StateTable(spark, f"{out}/state", schema, key, buckets).read()


def stream_changes(df: DataFrame, ttl_days: int = 30, purpose: str = "changes", buckets: int = 32) -> DataFrame:
    """`df`: url, ts, tie, hash. One change row for each input row, with the `batch_id` it came in.

    Versions of a URL in one micro-batch meet in time order, the first of them the state; only a URL's last version reaches it. State that is `ttl_days`
    older than the first row of a batch does not count, and leaves its bucket when that is written again.
    """

    def fold(state: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        since = batch.agg(F.min("ts")).first()[0]
        live = state if since is None else state.filter(F.col("last_seen") > F.lit(since) - F.make_dt_interval(F.lit(ttl_days)))
        rows = batch.select("url", "ts", "tie", "hash")
        last = first_per_key(rows, ["url"], ["ts", "tie"], last=True)
        return CH.detect_changes_ordered(live, rows, "ts", "tie"), last.select("url", "hash", F.col("ts").alias("last_seen"))

    return _stateful(df, purpose, CHANGE_STATE, "url", buckets, fold)[0]


def stream_health(log: DataFrame, purpose: str = "health", buckets: int = 32) -> tuple[DataFrame, DataFrame]:
    """Endpoint health behind each micro-batch (one row for each endpoint seen in it, with `batch_id`), and behind the last."""

    def fold(state: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        stretch = HE.folded(batch)
        known = state.alias("s").join(stretch.select(F.col("endpoint").alias("__k")), F.col("s.endpoint").eqNullSafe(F.col("__k")), "left_semi")
        rows = HE.composed(known, stretch)
        return rows.withColumn("cb_tripped", F.col("consecutive_fails") >= HE.FAIL_THRESHOLD), rows

    return _stateful(log.select("endpoint", "ts", "event_id", "ok", "latency_ms"), purpose, HEALTH_STATE, "endpoint", buckets, fold)
