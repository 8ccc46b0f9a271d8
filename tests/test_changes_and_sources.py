"""State upkeep properties, file sources and sinks."""

import datetime as dt
import gzip
import json

from pyspark.sql import functions as F

from pageloom.operators import changes as CH
from pageloom.sources import pages as SP, records as SR

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 15)
STATE = "url string, hash string, first_seen timestamp_ntz, last_crawled timestamp_ntz, change_count bigint"


def test_advance_twice_changes_nothing_more(spark):
    state = spark.createDataFrame([("a", "1", T0, T0, 0), ("b", "1", T0, T0, 2), ("c", "1", T0, T0, 0)], STATE)
    batch = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "9")], "url string, hash string")
    now = F.lit(T1).cast("timestamp_ntz")
    once = CH.advance_state(state, batch, now)
    got = {r.url: (r.hash, r.first_seen, r.last_crawled, r.change_count) for r in once.collect()}
    assert got == {"a": ("1", T0, T1, 0), "b": ("2", T0, T1, 3), "c": ("1", T0, T0, 0), "d": ("9", T1, T1, 0)}
    twice = CH.advance_state(once, batch, now)
    assert sorted(twice.collect()) == sorted(once.collect())
    kinds = {r.url: r.change_type for r in CH.detect_changes(once, batch).collect()}
    assert set(kinds.values()) == {"unchanged"}
    assert {r.url for r in CH.expire_state(once, now).collect()} == {"a", "b", "d"}


def test_gzip_page_store(spark, tmp_path):
    folder = tmp_path / "web" / "a.example" / "2026-03-11"
    folder.mkdir(parents=True)
    for i in range(3):
        with gzip.open(folder / f"{i:032x}.html.gz", "wt", encoding="utf-8") as f:
            f.write(f"<h1>é {i}</h1>\nline")
    rows = SP.read_pages(spark, str(tmp_path)).orderBy("url_md5").collect()
    assert [(r.project, r.domain, r.date, r.html) for r in rows] == [
        ("web", "a.example", "2026-03-11", f"<h1>é {i}</h1>\nline") for i in range(3)]


def test_second_write_of_a_day_replaces_only_that_day(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("https://a.example/1", "x", "web", T0), ("https://a.example/2", "y", "web", T1)]
    schema = "url string, html string, project string, fetched_at timestamp_ntz"
    SP.write_pages(spark.createDataFrame(rows, schema), path)
    SP.write_pages(spark.createDataFrame([("https://a.example/2", "z", "web", T1)], schema), path)
    assert {r.url: r.html for r in SP.read_page_table(spark, path).collect()} == {"https://a.example/1": "x", "https://a.example/2": "z"}


def test_run_status_forms(spark, tmp_path):
    run = {"project": "p", "site": "s", "schedule_id": "1", "stage": "parser", "started_at": "2026-04-26T09:13:39Z", "status": "failed",
           "progress": {"discovery_urls": 1600}}
    (tmp_path / "new.json").write_text(json.dumps({"current_runs": {"k": run}, "last_runs": [run]}, indent=1))
    (tmp_path / "old.json").write_text(json.dumps({"current_run": run, "last_runs": []}))
    rows = SR.read_run_status(spark, str(tmp_path)).collect()
    assert sorted((r.place, r.run_key, r.discovery_urls) for r in rows) == [
        ("current", "k", 1600), ("current", "p__s__1", 1600), ("history", "p__s__1", 1600)]


def test_site_config(spark, tmp_path):
    (tmp_path / "shop").mkdir()
    (tmp_path / "shop" / "a_b_shop.yml").write_text("depth0:\n  seed_url: [x, y]\ndepth2:\n  method_name: m2\ndepth1:\n  method_name: m1\n")
    (tmp_path / "shop" / "bad_shop.yml").write_text("a: [")
    (tmp_path / "shop" / "unrelated.yml").write_text("a: 1")
    rows = {r.site: r for r in SR.read_site_config(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a_b", "bad"}
    assert rows["a_b"].seed_url == ["x", "y"] and [(d.level, d.method) for d in rows["a_b"].depths] == [(1, "m1"), (2, "m2")]
    (tmp_path / "shop" / "f_shop.yml").write_text("domain: f.example\nfields:\n  uniq_id:\n  page_url:\n  name:\n")
    fields = SR.read_field_config(spark, str(tmp_path)).filter("site = 'f'").orderBy("ord").collect()
    assert [(r.domain, r.field) for r in fields] == [("f.example", "uniq_id"), ("f.example", "page_url"), ("f.example", "name")]


def test_csv_keeps_line_breaks_quotes_and_long_fields(spark, tmp_path):
    text = 'a "quoted"\nline, ' + "x" * 200_000
    SR.write_records_csv(spark.createDataFrame([("1", text)], "id string, t string"), str(tmp_path / "c"), ["t", "id"])
    back = SR.read_records_csv(spark, str(tmp_path / "c"))
    assert back.columns == ["t", "id"] and back.first().t == text


def test_writer_failures_become_rejects(spark):
    docs = spark.createDataFrame([("i", str(k), "{}") for k in range(7)], "index string, doc_id string, doc string").coalesce(1)

    def broken(batch):
        raise IOError("down")

    got = SR.send_batches(docs, broken, chunk=3, retries=2).collect()
    assert len(got) == 7 and all(r.error == "OSError: down" for r in got)
    unkeyed = SR.split_unkeyed(spark.createDataFrame([("i", None, "{}"), ("i", "a", "{}")], "index string, doc_id string, doc string"))
    assert [d.count() for d in unkeyed] == [1, 1]


def test_log_lines_keep_file_order(spark, tmp_path):
    lines = [f"2026-01-01 00:00:0{i},000 [INFO] " + json.dumps({"info": f"n{i}"}) for i in range(5)] + ["no level"]
    (tmp_path / "p.log").write_text("\n".join(lines))
    rows = SP.read_pipeline_log(spark, str(tmp_path)).orderBy("file", "block_start", "line_no").collect()
    assert [r.info for r in rows] == ["n0", "n1", "n2", "n3", "n4", "no level"]


def test_csv_files_of_several_headers(spark, tmp_path):
    root = tmp_path / "web"
    texts = {
        "a_web_1/x.csv": 'uniq_id,name,price\n1,"two\nlines, quoted ""x""",\n2,,5\n', "b_web_1/x.csv": "price,uniq_id\n7,3\nprice,uniq_id\n",
        "b_web_1/empty.csv": "", "c_web_1/only_header.csv": "uniq_id,color\n", "d_web_1/odd.csv": ",uniq_id\nfirst,4\n",
        "d_web_1/other.txt": "uniq_id\n9\n",
    }
    for name, text in texts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    rows = SR.backfill_records(spark, str(tmp_path))
    assert set(rows.columns) == {"project", "site", "schedule_id", "uniq_id", "name", "price", "color", "_c0"}
    got = {r.uniq_id: (r.site, r.name, r.price, r.color, r._c0) for r in rows.select("site", "uniq_id", F.col("name"), "price", "color", "_c0").toLocalIterator()}
    assert got == {
        "1": ("a", 'two\nlines, quoted "x"', None, None, None), "2": ("a", None, "5", None, None), "3": ("b", None, "7", None, None),
        "4": ("d", None, None, None, "first")}
    (tmp_path / "nothing").mkdir()
    assert SR.read_csv_by_header(spark, str(tmp_path / "nothing")).count() == 0
    assert SR.backfill_records(spark, str(tmp_path / "nothing")).count() == 0
    out = str(tmp_path / "index")
    assert SR.backfill_index(spark, str(tmp_path / "nothing"), out).count() == 0 and spark.read.parquet(out).count() == 0
    assert SR.merge_site_files(spark, str(root), "web", "1").filter("site_name = 'a'").count() == 2
