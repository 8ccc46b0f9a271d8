"""Several micro-batches: the stream gives what the batch form gives."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pageloom.operators import changes as CH, health as HE
from pageloom.streaming import stateful as SF, streams as ST

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events as three files in time order, one micro-batch each."""
    path = str(tmp_path_factory.mktemp("events"))
    events = spark.read.parquet(f"{FOLDER}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    n = events.count()
    ranked = events.orderBy("ts").limit(n).coalesce(1)
    for i, (lo, hi) in enumerate([(0, n // 3), (n // 3, 2 * n // 3), (2 * n // 3, n)]):
        rows = ranked.collect()[lo:hi]
        spark.createDataFrame(rows, events.schema).coalesce(1).write.parquet(f"{path}/part{i}")
    return path, events


def stream(spark, parts, files=1):
    path, events = parts
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True).parquet(path)


def versions(df):
    return df.select(F.col("user_id").cast("string").alias("url"), "ts", F.col("event_id").alias("tie"), F.col("event_type").alias("hash"))


def log_of(df):
    return df.select("ts", "event_id", F.col("user_id").alias("endpoint"), F.lit("d").alias("domain"), (F.col("event_type") != "error").alias("ok"),
                     F.col("value").alias("latency_ms"))


def test_stream_changes_equal_batch(spark, parts):
    got = SF.stream_changes(versions(stream(spark, parts)))
    nothing = spark.createDataFrame([], "url string, hash string")
    want = CH.detect_changes_ordered(nothing, versions(parts[1]), "ts", "tie")
    cols = ["url", "tie", "change_type", "old_hash", "new_hash", "changed"]
    assert sorted(map(tuple, got.select(cols).fillna("-").collect())) == sorted(map(tuple, want.select(cols).fillna("-").collect()))


def test_stream_health_equals_batch(spark, parts):
    updates, health = SF.stream_health(log_of(stream(spark, parts)))
    assert updates.select("batch_id").distinct().count() == 3
    got = {r.endpoint: r.ema_rate for r in health.collect()}
    want = {r.endpoint: r.ema_rate for r in HE.ema(log_of(parts[1])).collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_windows_and_late_rows(spark, parts):
    rates = ST.drain(ST.success_rate(log_of(stream(spark, parts)), "1 day"), "t-rate")
    want = log_of(parts[1]).groupBy(F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n")).select("w.start", "n").collect()
    got = {r.window_start: r.n for r in rates.collect()}
    assert got and all(dict(map(tuple, want))[k] == n for k, n in got.items())


def test_dedup_across_batches(spark, parts):
    rows = stream(spark, parts).select("ts", "user_id")
    got = ST.drain(ST.stream_dedup(rows, ["user_id"], "ts", "90 days"), "t-dedup")
    assert got.count() == parts[1].select("user_id").distinct().count()


def test_index_load_has_one_document_per_key(spark, parts):
    docs = stream(spark, parts).select(F.col("user_id").cast("string").alias("uniq_id"), "event_type")
    got = ST.stream_index(docs, "web", purpose="t-index")
    assert got.count() == parts[1].select("user_id").distinct().count() == got.select("doc_id").distinct().count()


def test_tables_in_several_files_as_streams(spark, tmp_path):
    """A table is one file or a folder of files; both come whole."""
    from pageloom.catalog import load

    docs = [(i, f"text {i}", "en", "web", 6) for i in range(30)]
    events = [(i, dt.datetime(2024, 1, 1 + i), i % 4, "view", 1.0, '{"k": 3}') for i in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    queries = load()[0]
    assert queries["stream_index"](spark, str(tmp_path)).select("doc_id").distinct().count() == 30
    assert {r.event_id for r in queries["stream_drain"](spark, str(tmp_path)).collect()} == set(range(20))


def test_slices_are_written_and_read_by_many_tasks(spark, monkeypatch):
    from types import SimpleNamespace

    from pageloom.catalog.streams import in_slices

    rows = spark.range(2000).select("id", F.when(F.col("id") < 3, 0).when(F.col("id") < 1500, 1).otherwise(3).alias("part"))
    seen, taken, table = {}, [], ST.stream_table
    monkeypatch.setattr(ST, "stream_table", lambda spark, path, schema, files=None: taken.append((path, files)) or table(spark, path, schema, files))

    def save(batch, batch_id, out):
        seen[batch_id] = (sorted({r.part for r in batch.select("part").distinct().collect()}), batch.count())

    ST.run_batches(in_slices(SimpleNamespace(spark=spark), rows, F.col("part"), 4), "t-slices", save)
    assert [seen[k] for k in sorted(seen)] == [([0], 3), ([1], 1497), ([], 0), ([3], 500)]
    (path, files), = taken
    assert files >= spark.sparkContext.defaultParallelism and len(spark.read.parquet(path).inputFiles()) == 4 * files


def test_shop_stream_takes_a_file_for_each_core(spark, tmp_path, monkeypatch):
    from pageloom.catalog import load

    parts = [(k, "a b", "Brand#1", ["SMALL", "PROMO"][k % 2], k % 50, 10.5) for k in range(200)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    taken, table = [], ST.stream_table
    monkeypatch.setattr(ST, "stream_table", lambda spark, path, schema, files=None, **kw: taken.append(files) or table(spark, path, schema, files, **kw))
    queries = load()[0]
    got = {tuple(r) for r in queries["field_accounts_stream"](spark, str(tmp_path)).collect()}
    assert taken[-1] >= spark.sparkContext.defaultParallelism and got == {tuple(r) for r in queries["field_accounts"](spark, str(tmp_path)).collect()}
