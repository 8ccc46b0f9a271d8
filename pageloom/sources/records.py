"""Record files: CSV, merge of sites, index documents, run status, site configs."""

from __future__ import annotations

import csv
import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pageloom import schemas
from pageloom.functions import cleaning as K
from pageloom.operators.scans import first_per_key

CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
OUTPUT_PATH = r"([^/]+)/([^/]+)_([A-Za-z0-9-]+)/[^/]+$"


def read_records_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header, quoted line breaks and very long fields; all text unless a schema is given."""
    reader = spark.read.options(**CSV).option("maxCharsPerColumn", -1)
    return (reader.schema(schema) if schema else reader).csv(path)


def write_records_csv(df: DataFrame, path: str, fields: Sequence[str]) -> None:
    """Columns in configured order."""
    text = [F.col(c) if not df.schema[c].dataType.typeName() == "array" else F.array_join(c, ", ").alias(c) for c in fields]
    df.select(*text).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def merge_sites(parts: dict[str, DataFrame], schedule_id: str) -> DataFrame:
    """Union of site tables by column name, with site_name and schedule_id in front."""
    merged = None
    for site, df in parts.items():
        tagged = df.select(F.lit(site).alias("site_name"), F.lit(schedule_id).alias("schedule_id"), "*")
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    return merged


def merge_site_files(spark: SparkSession, root: str, project: str, schedule_id: str) -> DataFrame:
    """The same from `{root}/{site}_{project}_{schedule_id}/*.csv`, whatever the order of their columns; the site comes from the path."""
    suffix = f"_{project}_{schedule_id}"
    rows = read_csv_by_header(spark, f"{root.rstrip('/')}/*{suffix}")
    folder = F.regexp_extract("__path", r"([^/]+)/[^/]+$", 1)
    site = F.substring(folder, F.lit(1), F.length(folder) - len(suffix))
    return rows.select(site.alias("site_name"), F.lit(schedule_id).alias("schedule_id"), *[c for c in rows.columns if c != "__path"])


def index_docs(df: DataFrame, project: Column | str, prefix: str = "") -> DataFrame:
    """One JSON document for each record: non-empty fields, site_name and @timestamp, keyed on uniq_id."""
    body = K.drop_empty(df)
    stamp = K.parse_timestamp_multi(F.col("crawl_timestamp")) if "crawl_timestamp" in df.columns else F.lit(None).cast("string")
    name = F.lit(project) if isinstance(project, str) else project
    doc = F.struct(*[F.col(c) for c in body.columns], stamp.alias("@timestamp"))
    return body.select(K.index_name(name, prefix).alias("index"), F.col("uniq_id").alias("doc_id"), F.to_json(doc).alias("doc"))


def send_batches(docs: DataFrame, writer: Callable[[list[dict]], dict[str, str]], chunk: int = 500,
                 retries: int = 3) -> DataFrame:
    """Give documents to `writer` in batches; returns the rejects.

    `writer` gets dicts of index, doc_id and doc, must upsert on doc_id (a task
    can run twice) and returns errors by doc_id. A batch that raises is tried
    again, then rejected as a whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), chunk):
                part = pdf.iloc[at : at + chunk]
                errors: dict[str, str] = {}
                for attempt in range(retries):
                    try:
                        errors = writer(part.to_dict("records"))
                        break
                    except Exception as exc:
                        if attempt == retries - 1:
                            errors = {i: f"{type(exc).__name__}: {exc}" for i in part["doc_id"]}
                bad = part[part["doc_id"].isin(list(errors))]
                yield bad.assign(error=bad["doc_id"].map(errors))

    return docs.mapInPandas(run, "index string, doc_id string, doc string, error string")


def split_unkeyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with a key, and rejects without one."""
    ok = F.coalesce(F.col("doc_id"), F.lit("")) != ""
    return docs.filter(ok), docs.filter(~ok).withColumn("error", F.lit("no uniq_id"))


INDEX_LINE = "_id string, _index string, _source string, _at string, load string"


def write_index_docs(df: DataFrame, project: str, path: str, prefix: str = "", load: str = "0") -> DataFrame:
    """File-backed sink: JSON lines, one document for each key; a repeated load replaces its own files, other loads stay.

    Of repeated keys in a load the one with the latest `@timestamp` counts, then the greatest document. Returns the rejects.
    `read_index` gives each key's document of the latest load.
    """
    keyed, rejects = split_unkeyed(index_docs(df, project, prefix))
    keyed = keyed.withColumn("at", F.coalesce(F.get_json_object("doc", "$['@timestamp']"), F.lit("")))
    unique = first_per_key(keyed, ["doc_id"], ["at", "doc"], last=True)
    lines = F.to_json(F.struct(
        F.col("index").alias("_index"), F.col("doc_id").alias("_id"), F.col("doc").alias("_source"), F.col("at").alias("_at")))
    unique.select(lines.alias("value"), F.lit(load).alias("load")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("load").text(path)
    return rejects


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """index, doc_id, doc: one row for each key, of the load that comes last by name."""
    lines = spark.read.schema(INDEX_LINE).json(path)
    newest = first_per_key(lines, ["_id"], ["load", "_at", "_source"], last=True)
    return newest.select(F.col("_index").alias("index"), F.col("_id").alias("doc_id"), F.col("_source").alias("doc"))


def upsert_index(spark: SparkSession, path: str, docs: DataFrame, new_path: str) -> DataFrame:
    """Merge a load into an index table: a key in the load replaces the stored document; a key twice in the load counts once.

    Loads without a key are left to `split_unkeyed`; stored rows without one stay.
    """
    stored = spark.read.parquet(path)
    unique = first_per_key(docs.select(*stored.columns), ["doc_id"], ["doc"], last=True)
    kept = stored.join(unique.select("doc_id"), "doc_id", "left_anti").select(*stored.columns)
    kept.unionByName(unique).write.mode("overwrite").parquet(new_path)
    return spark.read.parquet(new_path)


def read_csv_by_header(spark: SparkSession, files: str, pattern: str = "*.csv") -> DataFrame:
    """All CSV files under a folder with the column names of each file's own header, and its path as `__path`.

    One read takes the fields by position; a file's header, met by its path, says which position a name has in it. What comes to the driver is the
    different headers (record shapes), no paths. Columns a file lacks are NULL, as are empty fields; a row that repeats its file's header is not a record.
    Files without any line, and a folder without files, give no rows.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(files)
    first = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                         F.monotonically_increasing_id().alias("n"))
    headers = first.filter("at = 0").groupBy("path").agg(F.min_by("value", "n").alias("header"))
    known = {line: next(csv.reader([line])) for line, in headers.select("header").distinct().collect()}
    named = {line: [n or f"_c{k}" for k, n in enumerate(row)] for line, row in known.items()}
    names = list(dict.fromkeys(n for line in sorted(named) for n in named[line]))
    if not names:
        return spark.createDataFrame([], "__path string")
    width = max(map(len, known.values()))
    shapes = spark.createDataFrame([(line, row, named[line]) for line, row in known.items()], "header string, __header array<string>, __names array<string>")
    options = {**CSV, "header": False, "maxCharsPerColumn": -1, "recursiveFileLookup": True, "pathGlobFilter": pattern}
    fields = spark.read.options(**options).schema(", ".join(f"c{k} string" for k in range(width))).csv(files).select(
        F.array(*[F.col(f"c{k}") for k in range(width)]).alias("__fields"), F.col("_metadata.file_path").alias("path"))
    rows = fields.join(headers.join(shapes, "header").select("path", "__header", "__names"), "path")
    as_text = F.transform(F.slice("__fields", F.lit(1), F.size("__names")), lambda v: F.coalesce(v, F.lit("")))
    rows = rows.filter(~as_text.eqNullSafe(F.col("__header")))
    place = lambda n: F.array_position("__names", n).cast("int")
    return rows.select(*[F.when(place(n) > 0, F.get("__fields", place(n) - 1)).alias(n) for n in names], F.col("path").alias("__path"))


def backfill_records(spark: SparkSession, root: str) -> DataFrame:
    """All record CSVs under `{root}/{project}/{site}_{project}_{schedule_id}/`, keys taken from the path, columns from each file's header."""
    rows = read_csv_by_header(spark, root)
    path = F.col("__path")
    project = F.regexp_extract(path, r"([^/]+)/[^/]+/[^/]+$", 1)
    folder = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return rows.select(
        project.alias("project"),
        F.regexp_replace(folder, F.concat(F.lit("_"), project, F.lit("_[^_]+$")), F.lit("")).alias("site"),
        F.regexp_extract(folder, r"_([^_]+)$", 1).alias("schedule_id"),
        *[c for c in rows.columns if c != "__path"],
    )


def backfill_index(spark: SparkSession, root: str, path: str, prefix: str = "", key: str = "uniq_id") -> DataFrame:
    """Backfill down to the index: every record of every run as a document of its project's index; returns the rejects."""
    rows = backfill_records(spark, root)
    rows = rows.withColumn("uniq_id", F.col(key) if key in rows.columns else F.lit(None).cast("string"))
    keyed, rejects = split_unkeyed(index_docs(rows, F.col("project"), prefix))
    first_per_key(keyed, ["doc_id"], ["doc"], last=True).write.mode("overwrite").parquet(path)
    return rejects


def flatten_runs(df: DataFrame) -> DataFrame:
    """Status documents (current map, history list, old single-run form) to one row for each run."""
    runs = F.concat(
        F.transform(
            F.coalesce(F.map_entries("current_runs"), F.array()),
            lambda e: F.struct(F.lit("current").alias("place"), e["key"].alias("run_key"), e["value"].alias("run")),
        ),
        F.transform(
            F.when(F.col("current_runs").isNull() & F.col("current_run.site").isNotNull(), F.array("current_run"))
            .otherwise(F.slice(F.array("current_run"), 1, 0)),
            lambda r: F.struct(F.lit("current").alias("place"), _key(r).alias("run_key"), r.alias("run")),
        ),
        F.transform(
            F.coalesce("last_runs", F.array()),
            lambda r: F.struct(F.lit("history").alias("place"), _key(r).alias("run_key"), r.alias("run")),
        ),
    )
    rows = df.select(F.inline(runs)).select("place", "run_key", "run.*")
    counters = {
        name: F.col("progress").getItem(name)
        for name in ("discovery_urls", "retriever_total", "retriever_fetched", "parser_pages", "parser_pages_done",
                     "parser_records")
    }
    times = {c: F.col(c).try_cast("timestamp") for c in ("started_at", "updated_at", "completed_at")}
    return rows.withColumns({**counters, **times}).drop("progress")


def _key(r: Column) -> Column:
    return F.concat_ws("__", r["project"], r["site"], r["schedule_id"])


def read_run_status(spark: SparkSession, path: str) -> DataFrame:
    return flatten_runs(spark.read.option("multiLine", True).schema(schemas.RUN_STATUS).json(path))


def _yaml_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    for pdf in batches:
        out = []
        for path, text in zip(pdf["path"], pdf["text"]):
            try:
                config, error = yaml.safe_load(text) or {}, None
            except yaml.YAMLError as exc:
                config, error = {}, type(exc).__name__
            out.append((path, json.dumps(config, default=str), error))
        yield pd.DataFrame(out, columns=["path", "config", "error"])


def read_config_files(spark: SparkSession, root: str) -> DataFrame:
    """YAML files as JSON text, with project and site from `{project}/{site}_{project}.yml`."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.yml")
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).mapInPandas(
        _yaml_rows, "path string, config string, error string"
    )
    project = F.regexp_extract("path", r"([^/]+)/[^/]+\.yml$", 1)
    stem = F.regexp_extract("path", r"([^/]+)\.yml$", 1)
    named = rows.withColumns({"project": project, "__stem": stem})
    suffix = F.concat(F.lit("_"), F.col("project"))
    return (
        named.filter(F.endswith(F.col("__stem"), suffix) & (F.length("__stem") > F.length(suffix)))
        .withColumn("site", F.left(F.col("__stem"), F.length("__stem") - F.length(suffix)))
        .select("project", "site", "config", "error")
    )


def read_site_config(spark: SparkSession, root: str) -> DataFrame:
    """Discovery configs: seeds, the method of each level, request parameters."""
    files = read_config_files(spark, root)
    tree = F.from_json("config", "map<string,string>")
    levels = F.array_sort(F.transform(
        F.filter(F.map_entries("__t"), lambda e: e["key"].rlike(r"^depth[1-9]\d*$")),
        lambda e: F.struct(
            F.regexp_extract(e["key"], r"(\d+)", 1).cast("int").alias("level"),
            F.get_json_object(e["value"], "$.method_name").alias("method"),
        ),
    ))
    return files.withColumn("__t", tree).select(
        "project", "site",
        F.from_json(F.get_json_object("config", "$.depth0.seed_url"), "array<string>").alias("seed_url"),
        levels.alias("depths"),
        F.from_json(F.try_element_at("__t", F.lit("request_params")), "map<string,string>").alias("request_params"),
    )


def read_field_config(spark: SparkSession, root: str) -> DataFrame:
    """Record configs: the fields of each site in configured order."""
    files = read_config_files(spark, root)
    fields = F.map_keys(F.from_json(F.get_json_object("config", "$.fields"), "map<string,string>"))
    return files.select(
        "project", "site", F.get_json_object("config", "$.domain").alias("domain"), F.posexplode(fields).alias("ord", "field")
    )


def site_levels(config: DataFrame) -> DataFrame:
    """One row for each site and level, as frontier expansion needs it."""
    return config.select("project", "site", F.inline("depths"))
