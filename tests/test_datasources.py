"""The page store and the bulk index as data sources: pruning, streams, commit, abort, back-off, rejects."""

import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from pageloom.session import new_folder
from pageloom.sources import bulkindex as BI, pagestore as PS
from pageloom.streaming import streams as ST


def pages(spark, rows):
    return spark.createDataFrame(rows, "project string, url string, fetched string, html string").withColumn("fetched_at", F.to_timestamp("fetched"))


ROWS = [
    ("news", "https://www.a.example/1", "2026-03-11 10:00:00", "<p>é 1</p>"), ("news", "https://a.example/2", "2026-03-11 10:00:00", None),
    ("news", "https://b.example/1", "2026-03-12 10:00:00", "x"), ("shop", "https://b.example/1", "2026-03-11 10:00:00", "old"),
    ("shop", "https://b.example/1", "2026-03-11 11:00:00", "new"), ("shop", "https://b.example/1", "2026-03-12 11:00:00", "day two"),
]


def files(root):
    return sorted(p[len(root) + 1:] for p in glob.glob(f"{root}/*/*/*/*"))


def test_store_layout_and_pruned_reads(spark, tmp_path):
    root = str(tmp_path / "store")
    PS.write_page_store(pages(spark, ROWS).repartition(3), root)
    assert len(files(root)) == 5 and all(f.endswith(".html.gz") for f in files(root))
    store = lambda **o: spark.read.format("pagestore").options(**o).load(root)
    assert {(r.project, r.domain, r.date, r.html) for r in store().collect()} == {
        ("news", "a.example", "2026-03-11", "<p>é 1</p>"), ("news", "a.example", "2026-03-11", ""), ("news", "b.example", "2026-03-12", "x"),
        ("shop", "b.example", "2026-03-11", "new"), ("shop", "b.example", "2026-03-12", "day two")}
    assert store(splits="16").count() == 5 and store(splits="17").filter("domain = 'b.example'").count() == 3
    assert store().filter("project = 'shop' AND date IN ('2026-03-12', '2026-03-13') AND html LIKE 'day%'").count() == 1
    assert store().filter("domain = 'none'").count() == 0 and store().filter("domain = 'a.example' AND domain = 'b.example'").count() == 0
    reader = PS.PageReader(root, 1)
    kept = list(reader.pushFilters([PS.EqualTo(("domain",), "b.example"), PS.In(("date",), ("2026-03-12",)), PS.EqualTo(("html",), "x")]))
    assert [f.attribute for f in kept] == [("html",)]
    assert [p.folder for p in reader.partitions()] == ["news/b.example/2026-03-12", "shop/b.example/2026-03-12"]


def test_store_of_another_writer(spark, tmp_path):
    folder = tmp_path / "web" / "a.example" / "2026-03-11"
    folder.mkdir(parents=True)
    (folder / "0123.html.gz").write_bytes(gzip.compress("ü".encode()))
    (folder / "0123.tmp").write_bytes(b"half")
    PS.register(spark)
    got = spark.read.format("pagestore").load(str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("web", "a.example", "2026-03-11", "0123", "ü")]
    assert spark.read.format("pagestore").load(str(tmp_path / "nothing")).count() == 0


def test_stream_of_loads_goes_on_where_it_ended(spark, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "out")
    PS.register(spark)

    def run():
        query = spark.readStream.format("pagestore").load(root).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(r.html for r in spark.read.schema(PS.SCHEMA).parquet(out).collect())

    PS.write_page_store(pages(spark, ROWS[:2]), root)
    assert run() == ["", "<p>é 1</p>"]
    assert run() == ["", "<p>é 1</p>"]
    PS.write_page_store(pages(spark, ROWS[2:4]), root)
    PS.write_page_store(pages(spark, ROWS[4:]), root)
    assert run() == sorted(["", "<p>é 1</p>", "x", "new", "day two", "new"])  # the page of two loads is read as it is now, once for each


def test_aborted_load_leaves_the_store_as_it_was(spark, tmp_path):
    root = str(tmp_path / "store")
    PS.write_page_store(pages(spark, ROWS[:2]), root)
    before = files(root)
    bad = pages(spark, [*ROWS[2:], ("shop", "https://c.example/", None, "no date"), ROWS[0]])
    with pytest.raises(Exception, match="needs project"):
        bad.select("project", "url", F.date_format("fetched_at", "yyyy-MM-dd").alias("date"), "html").repartition(4).write.format(
            "pagestore").mode("append").save(root)
    assert files(root) == before and len([n for n in os.listdir(f"{root}/_loads") if n.endswith(".json")]) == 1
    PS.write_page_store(pages(spark, ROWS).limit(0), root)
    assert spark.read.format("pagestore").load(root).count() == 2


def docs(spark, n, load="1"):
    return spark.range(n).select(F.lit("web").alias("index"), F.col("id").cast("string").alias("doc_id"), F.concat(
        F.lit('{"load":"' + load + '","n":'), F.col("id").cast("string"), F.lit("}")).alias("doc"))


def sender(spark, send=None):
    """A client whose requests go through `send(number, docs)` before the file client."""

    def connect(path, batch, task):
        store, calls = BI.FileClient(path, batch, task), [0]

        def request(batch_docs):
            calls[0] += 1
            errors = send(calls[0], batch_docs) if send else {}
            store([d for d in batch_docs if d["doc_id"] not in errors])
            return errors

        return request

    spark.dataSource.register(BI.bulk_index(connect))


def load(df, path, batch, **options):
    df.write.format("bulkindex").mode("append").options(wait=0.01, **options).option("batch", batch).save(path)


def test_requests_are_tried_again_then_refused(spark):
    path = new_folder(spark, "bulk")

    def send(number, batch_docs):
        if any(int(d["doc_id"]) % 20 == 7 for d in batch_docs):
            raise ConnectionError("down")  # each time: the whole request is refused
        if number % 3 == 1:
            raise TimeoutError("slow")     # the next try goes through
        return {d["doc_id"]: "odd" for d in batch_docs if d["doc_id"] == "3"}

    sender(spark, send)
    load(docs(spark, 100).coalesce(1), path, "1", chunk=5)
    refused = {r.doc_id: (r.error, r.batch) for r in BI.rejects(spark, path).collect()}
    down = {str(i) for i in range(100) if i % 20 // 5 == 1}
    assert refused == {**dict.fromkeys(down, ("ConnectionError: down", "1")), "3": ("odd", "1")}
    assert {r.doc_id for r in BI.documents(spark, path).collect()} == {str(i) for i in range(100)} - set(refused)
    assert BI.commits(spark, path).first()["sent"] == 100 - len(refused)


def test_a_batch_counts_once_and_a_failed_one_is_sent_again(spark):
    path = new_folder(spark, "bulk")
    sender(spark)
    with pytest.raises(Exception, match="stop"):
        load(docs(spark, 40).withColumn("doc_id", F.when(F.col("doc_id") == "33", F.raise_error(F.lit("stop"))).otherwise(F.col("doc_id"))).repartition(4), path, "1", chunk=3)
    assert not os.path.exists(f"{path}/commits/1.json")
    load(docs(spark, 40).repartition(3), path, "1", chunk=3)
    load(docs(spark, 60, "again"), path, "1")
    load(docs(spark, 10, "2"), path, "2")
    got = {r.doc_id: json.loads(r.doc)["load"] for r in BI.documents(spark, path).collect()}
    assert got == {str(i): "2" if i < 10 else "1" for i in range(40)}
    assert {(r.batch, r.sent, r.rejects) for r in BI.commits(spark, path).collect()} == {("1", 40, 0), ("2", 10, 0)}
    assert BI.rejects(spark, path).count() == 0


def test_stream_into_the_sink(spark, tmp_path):
    path, source = new_folder(spark, "bulk"), str(tmp_path / "in")
    sender(spark, lambda number, batch_docs: {d["doc_id"]: "no" for d in batch_docs if d["doc_id"] == "4"})
    for k in range(3):
        docs(spark, 6 + k, str(k)).coalesce(1).write.mode("append").parquet(source)
    BI.load_stream(ST.stream_table(spark, source, docs(spark, 1).schema, 1), path)
    assert {r.doc_id: json.loads(r.doc)["load"] for r in BI.documents(spark, path).collect()} == {str(i): "2" for i in range(8) if i != 4}
    assert [r.batch for r in BI.rejects(spark, path).orderBy("batch").collect()] == [f"{k:012d}" for k in range(3)]
