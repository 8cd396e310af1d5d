"""Session options and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from paperlake.settings import SESSION_OPTIONS

_LOCAL_SCRATCH = "paperlake.local.scratch"


def build_session(app_name: str = "paperlake", **options: str) -> SparkSession:
    """A session in UTC with adaptive execution and dynamic partition overwrite.

    Keyword names may use ``__`` for the dots of an option name.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = {
        **SESSION_OPTIONS,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **{k.replace("__", "."): v for k, v in options.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it.

    Only a local session without ``spark.checkpoint.dir`` gets a temporary
    folder, one per session; on a cluster executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL_SCRATCH, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="paperlake-")
    spark.conf.set(_LOCAL_SCRATCH, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the scratch root; never reused."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, which cuts its lineage.

    ``codec`` replaces the session's compression of Parquet files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
