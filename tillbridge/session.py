"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options that results depend on.

    Partition counts, memory and the adaptive advisory size stay with the cluster.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a session that is a single process and lacks the setting, as in tests, gets a
    temporary folder; on a cluster such a folder would be visible to one machine only.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tillbridge-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def write_and_read(df, label: str, partition_by=()):
    """Store ``df`` in the shared folder and return a frame that reads it back.

    Cuts lineage like a checkpoint, but stays columnar: later reads prune columns and
    partitions, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.partitionBy(*partition_by).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate folder, wherever it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def stored(frames: dict, partition_by=()):
    """Frames kept as tables while the block runs: ``label -> frame`` becomes
    ``label -> frame that reads the table``. The tables are deleted at its end."""
    spark = next(iter(frames.values())).sparkSession
    folders = {label: new_folder(spark, label) for label in frames}
    try:
        read = {}
        for label, frame in frames.items():
            frame.write.partitionBy(*partition_by).parquet(folders[label])
            read[label] = spark.read.schema(frame.schema).parquet(folders[label])
        yield read
    finally:
        for folder in folders.values():
            drop_folder(spark, folder)
