"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "matchwright", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by the executors, as named by the cluster.

    Only a session that names none (a local run) gets a folder of its own, which is then
    stored in the session so that later calls agree on it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="matchwright-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = (), **options: str) -> DataFrame:
    """Write to the shared scratch folder and read back: ends the lineage, survives lost executors.

    The folder goes with the returned frame as `scratch_path`, for `discard`.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**{"compression": "zstd", **options}).parquet(path, partitionBy=list(partition_by) or None)
    out = df.sparkSession.read.schema(df.schema).parquet(path) if partition_by else df.sparkSession.read.parquet(path)
    out.scratch_path = path
    return out


def _folder(spark: SparkSession, path: str):
    """The path and its Hadoop file system: Spark itself has no call to look for a folder or to delete one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, store = _folder(spark, path)
    return store.exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it lies."""
    folder, store = _folder(spark, path)
    store.delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, each by the folder `stage` gave it."""
    for table in tables:
        delete(table.sparkSession, table.scratch_path)
