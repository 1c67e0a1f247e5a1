"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where that is unset, a session in one process gets a temporary one, which is then set; a cluster gets an error,
    since its machines would each write to a disk of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomgraph-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/loomgraph/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, *folders: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder, a folder a value of the columns ``folders``, and read it back, so that
    no later plan repeats what came before."""
    path = scratch(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*folders) if folders else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns]), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
