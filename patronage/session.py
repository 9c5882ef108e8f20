"""Session settings and the folder in which jobs may cut their lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "patronage", master: str | None = None, **settings: str) -> SparkSession:
    """Session for jobs, tests and the benchmark; a cluster sets `master` itself."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Naive timestamps are read as UTC, so day differences have no clock changes."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by the session.

    A temporary folder is used only when nothing is configured and driver and executors are one
    process, and goes when that ends; on a cluster a machine-local folder would lose data with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="patronage-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, under the application's name so that it can be cleared."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet below the shared folder and continue from the file.

    Used where a frame feeds several jobs, or where two consumers must see the same partitions. The rows
    survive the loss of executors, and readers take only the columns and row groups they need.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, column: str, buckets: int, sort: list[str]) -> DataFrame:
    """Like `materialize`, in buckets by a column, so that windows and groupings by it need no shuffle.

    The catalog entry, which the writer needs, is dropped at once; the files stay below the shared folder.
    """
    spark, name = df.sparkSession, f"rows_{uuid.uuid4().hex}"
    path = scratch_path(spark, "buckets")
    df.write.option("path", path).bucketBy(buckets, column).sortBy(*sort).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table
