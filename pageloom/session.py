"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "pageloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    A local temporary folder is used only when nothing is set and the master is local.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="pageloom-")
    spark.conf.set(CHECKPOINT_KEY, base)
    return base


def pin_utc(spark: SparkSession) -> None:
    """Times are compared and formatted in UTC, whatever the machine's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    sc = spark.sparkContext
    if getattr(sc, "_pageloom_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="pageloom-"), "pageloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    sc._pageloom_shipped = True


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/pageloom/{purpose}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Repartition only when a scan gives fewer tasks than there are cores.

    Meant for small inputs ahead of a CPU-heavy step. A large scan already has
    enough splits and keeps them, so pages are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 512 rows and 8 MB instead of 10,000 rows and 64 MB: whole pages pass through the Python workers, and each batch is held several times."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
