"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "recordtide", **conf: str) -> SparkSession:
    """A session with the settings the plans in this package are tuned for.

    On a cluster leave ``master`` unset and let the submitter choose it, together
    with the shuffle width: adaptive execution merges small shuffle partitions, so
    a generous width costs little.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up for a local master, where driver and
    executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder. Nothing is created yet."""
    return f"{shared_folder(spark)}/recordtide/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Keeps plans of iterative jobs short, survives the loss of any executor, and
    tells the planner the true size, so that a small result is broadcast by the next
    join without shuffling the other side. ``codec`` zstd takes less room for texts, and some more time.
    """
    spark = df.sparkSession
    folder = work_folder(spark, "stage")
    df.write.option("compression", codec).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
