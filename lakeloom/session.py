"""Session factory and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "lakeloom", warehouse: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with adaptive execution, snappy Parquet and a UTC clock.

    ``warehouse`` is the folder that ``saveAsTable`` uses; ``conf`` wins over
    the defaults, so a cluster can set its own shuffle and memory sizes.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session in one process (``local`` or ``local[...]``) without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or context.getConf().get("spark.checkpoint.dir")
            or context.getCheckpointDir())
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="lakeloom-")
    context.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_work(spark: SparkSession, path: str) -> None:
    """Delete one work path, once nothing reads it any more."""
    if not path.startswith(shared_root(spark) + "/"):
        raise ValueError(f"{path} is not a work path")
    delete_path(spark, path)


def materialise(df, purpose: str):
    """Write ``df`` once as a shared Parquet table and read it back.

    Cuts the lineage, survives lost executors and gives Spark true sizes for
    everything planned on top of it.
    """
    spark = df.sparkSession
    path = work_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
