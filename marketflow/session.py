"""Session settings, the shared folder and materialised intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# folders of local sessions that name none, by application
_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "marketflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every plan here relies on; `conf` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: bars, weekdays and date texts are all UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from `spark.checkpoint.dir`.

    Only a local session may go without: it gets a folder of its own, once.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="marketflow-")
    return _LOCAL_DIRS[application]


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled", partition_by: tuple[str, ...] = (), compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used for a frame that several branches read, so that the scan below it runs
    once; it cuts the lineage, survives lost executors, and gives Spark the true
    size, so a small frame is broadcast and a large one is not. `compression` is the
    session's unless given.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
