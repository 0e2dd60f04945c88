"""What still has to be landed: local inventory against landed inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbridge.errors import SourceError
from tillbridge.sources import paths
from tillbridge.sources.files import file_hashes, list_files


def landing_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``kind``, ``object_name``, ``path``, ``length``, ``sha256`` of all local sources.

    Transactions, FX files and both manifests must exist; a file that has no canonical
    landing name fails the job.
    """
    sources = {
        "transaction": (f"{root}/data/daily_regional_sales/business_date=*/*.csv.gz",
                        r"daily_regional_sales/(.*)\z"),
        "fx": (f"{root}/fx/fx_daily/*/*/fx_*.csv", r"fx/(fx_daily/.*)\z"),
        **{f"manifest {n}": (f"{root}/{local}", rf"({local})\z")
           for n, local in enumerate(paths.MANIFEST_NAMES)},
    }
    inventory = None
    for label, (pattern, relative) in sources.items():
        files = list_files(spark, pattern)
        if files.isEmpty():
            raise SourceError(f"nothing to land at {pattern}")
        kind = label.split()[0]
        part = file_hashes(spark, pattern).select(
            F.lit(kind).alias("kind"),
            paths.landing_name(F.lit(kind), F.regexp_extract("path", relative, 1)).alias("object_name"),
            "path", "length", "sha256")
        inventory = part if inventory is None else inventory.unionByName(part)
    named = F.coalesce(
        "object_name", F.raise_error(F.concat(F.lit("unsupported source path: "), "path")))
    return inventory.withColumn("object_name", named).orderBy("object_name")


def smoke_subset(inventory: DataFrame) -> DataFrame:
    """The first transaction file, the first FX file and the manifests."""
    first = inventory.groupBy("kind").agg(F.min("object_name").alias("first_name"))
    return inventory.join(F.broadcast(first), "kind").where(
        (F.col("kind") == "manifest") | (F.col("object_name") == F.col("first_name")),
    ).drop("first_name").orderBy("object_name")


def landing_decision(local: DataFrame, landed: DataFrame) -> DataFrame:
    """Add ``action`` to the local inventory.

    ``landed`` has ``object_name`` and ``sha256``. An absent object is an ``UPLOAD``, an
    equal one a ``SKIP``; a landed object without a checksum, or with another one, is a
    conflict and must not be replaced.
    """
    remote = landed.select("object_name", F.col("sha256").alias("landed_sha256"),
                           F.lit(True).alias("_landed"))
    return local.join(remote, "object_name", "left").withColumn(
        "action",
        F.when(F.col("_landed").isNull(), "UPLOAD")
        .when(F.coalesce("landed_sha256", F.lit("")) == "", "CONFLICT_NO_CHECKSUM")
        .when(F.col("landed_sha256") == F.col("sha256"), "SKIP")
        .otherwise("CONFLICT_CHECKSUM")).drop("_landed")


def landing_summary(decided: DataFrame) -> DataFrame:
    return decided.groupBy("action").agg(F.count("*").alias("files"))
