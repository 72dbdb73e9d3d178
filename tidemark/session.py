"""Session settings, and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the work that depends on data sizes: it coalesces small shuffle
# partitions, turns joins into broadcasts when a side proves small, and splits hot join keys.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword names use `__` where the setting has a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a session whose executor is the driver itself (`local`, `local[…]`) may go without the
    setting; it then gets a new temporary folder. All others, `local-cluster` too, must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
