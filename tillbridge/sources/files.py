"""Source files as rows: discovery, completeness and checksums."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from datetime import date

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbridge.contracts import REGIONS
from tillbridge.errors import SourceError
from tillbridge.sources import paths

# Longer files are streamed through the digest; a row of the binary source ends at 2 GiB.
STREAMED_BYTES = 1 << 30
_PIECE = 1 << 22


def date_frame(spark: SparkSession, dates: Iterable[date]) -> DataFrame:
    """One row per requested business date."""
    return spark.createDataFrame([(d,) for d in sorted(set(dates))], "batch_date date")


def list_files(spark: SparkSession, *patterns: str, recursive: bool = False) -> DataFrame:
    """``path``, ``length`` of the files under the given globs; none is no error.

    All patterns are one scan. The content column is never selected here, so no file is
    opened. Names that start with a dot or an underscore are not files to Spark.
    """
    found = _binary(spark, patterns, recursive)
    if found is None:
        return spark.createDataFrame([], "path string, length long")
    return found.select("path", "length")


def _binary(spark: SparkSession, patterns, recursive=False) -> DataFrame | None:
    present = [p for p in patterns if _exists(spark, p)]
    if not present:
        return None
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(present)


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, pattern: str) -> bool:
    path, filesystem = _filesystem(spark, pattern)
    found = filesystem.globStatus(path)
    return found is not None and len(found) > 0


def list_everything(spark: SparkSession, folders: Iterable[str]) -> DataFrame:
    """``path``, ``length`` of every file below the folders, at any depth and of any name.

    The listing is the driver's, one call per folder, through the file system Spark uses.
    """
    found = []
    for folder in folders:
        path, filesystem = _filesystem(spark, folder)
        if filesystem.exists(path):
            files = filesystem.listFiles(path, True)
            while files.hasNext():
                status = files.next()
                found.append((status.getPath().toString(), status.getLen()))
    return spark.createDataFrame(found, "path string, length long")


def move_file(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file; the target must not exist."""
    source, filesystem = _filesystem(spark, path)
    goal, _ = _filesystem(spark, target)
    filesystem.mkdirs(goal.getParent())
    if filesystem.exists(goal) or not filesystem.rename(source, goal):
        raise SourceError(f"cannot write {target}")


def discover_transactions(spark: SparkSession, root: str, dates: Iterable[date]) -> DataFrame:
    """All files below the folders of the requested dates: ``source_file``, ``path``,
    ``length``. Nested, hidden and undotted names count, so that none goes unseen."""
    found = list_everything(
        spark, [f"{root}/{paths.transaction_folder(d)}" for d in sorted(set(dates))])
    return found.select(paths.below_landing(F.col("path")).alias("source_file"), "path", "length")


def discover_fx(spark: SparkSession, root: str, dates: Iterable[date]) -> DataFrame:
    """The optional FX file of each requested date."""
    months = sorted({(d.year, d.month) for d in dates})
    found = list_files(
        spark, *[f"{root}/fx/{year:04}/{month:02}/fx_*.csv" for year, month in months])
    named = found.select(paths.source_name(F.col("path")).alias("source_file"), "path", "length")
    return named.withColumn("batch_date", paths.fx_day_of(F.col("source_file"))).join(
        F.broadcast(date_frame(spark, dates)), "batch_date", "left_semi")


def expected_transactions(dates: DataFrame) -> DataFrame:
    """``batch_date``, ``region`` for every file a date must have."""
    return dates.select(
        "batch_date", F.explode(F.array(*map(F.lit, REGIONS))).alias("region"))


def completeness(dates: DataFrame, discovered: DataFrame) -> DataFrame:
    """Differences between the files a date must have and those that exist.

    ``discovered`` needs ``source_file``. Columns: ``batch_date``, ``region``,
    ``source_file``, ``problem`` (``MISSING``, ``UNEXPECTED``, ``DUPLICATE``). A date is
    complete when it has no row here.
    """
    name = F.col("source_file")
    files = discovered.groupBy("source_file").agg(F.count("*").alias("copies")).select(
        "source_file", "copies",
        paths.day_of(name).alias("batch_date"),
        paths.region_of(name).alias("region"),
        name.contains("/region=").alias("split_form"))
    # One landed file, or one or more parts of the split form, per date and region.
    slots = files.where("region is not null").groupBy("batch_date", "region").agg(
        F.max("source_file").alias("source_file"),
        F.max("copies").alias("copies"),
        F.count_if(~F.col("split_form")).alias("landed"),
        F.count_if("split_form").alias("parts"))
    compared = expected_transactions(dates).join(
        slots, ["batch_date", "region"], "full_outer")
    problem = (
        F.when(F.col("source_file").isNull(), "MISSING")
        .when((F.col("copies") > 1) | (F.col("landed") > 1)
              | ((F.col("landed") > 0) & (F.col("parts") > 0)), "DUPLICATE"))
    slot_problems = compared.select(
        "batch_date", "region", "source_file", problem.alias("problem"),
    ).where("problem is not null")
    unexpected = files.where("region is null").select(
        "batch_date", "region", "source_file", F.lit("UNEXPECTED").alias("problem"))
    return slot_problems.unionByName(unexpected)


def fx_status(dates: DataFrame, discovered_fx: DataFrame) -> DataFrame:
    """``LOADED`` for dates with an FX file of their own, else ``NO_NEW_RATE``."""
    present = discovered_fx.groupBy("batch_date").agg(F.count("*").alias("files"))
    return dates.join(present, "batch_date", "left").select(
        "batch_date",
        F.when(F.col("files").isNull(), "NO_NEW_RATE").otherwise("LOADED").alias("fx_status"))


def file_hashes(spark: SparkSession, *patterns: str, streamed_bytes: int = STREAMED_BYTES) -> DataFrame:
    """SHA-256 over the stored bytes of the files under the globs in ``patterns``, of any length.

    Files of up to ``streamed_bytes`` are rows of the binary source, with Spark's own file system
    and credentials; the filter on the length reaches that source, which then does not open
    the others. Larger files are read piece by piece by the task that has their path, through
    pyarrow's file systems. Spark's scans leave out empty files, and so does this.
    """
    files = _binary(spark, patterns)
    if files is None:
        return spark.createDataFrame([], "path string, length long, sha256 string")
    large = F.col("length") > streamed_bytes
    whole = files.where(~large).select("path", "length", F.sha2("content", 256).alias("sha256"))
    # A number of its own keeps adaptive execution from gathering the few short rows in one task.
    streamed = files.where(large).select("path", "length").repartition(
        spark.sparkContext.defaultParallelism, "path").mapInArrow(_streamed, whole.schema)
    return whole.unionByName(streamed)


def _streamed(batches):
    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            with open_stream(path) as stream:
                while piece := stream.read(_PIECE):
                    digest.update(piece)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], ["path", "length", "sha256"])


def open_stream(path: str):
    """A file that Spark has listed, opened for reading on an executor."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        filesystem, name = pafs.LocalFileSystem(), "/" + (rest or scheme).lstrip("/")
    else:
        filesystem, name = pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return filesystem.open_input_stream(name, compression=None)


def verify_checksums(hashed: DataFrame, registered: DataFrame) -> DataFrame:
    """Compare actual with registered checksums.

    ``hashed`` has ``source_file`` and ``sha256``, ``registered`` has ``source_file``
    and ``source_checksum``. Adds ``source_checksum`` and ``problem``, which is NULL for
    an unaltered file, else ``MISSING_CHECKSUM`` or ``CHECKSUM_MISMATCH``.
    """
    known = registered.groupBy("source_file").agg(
        F.max("source_checksum").alias("source_checksum"),
        F.min("source_checksum").alias("_least"))
    expected = F.coalesce("source_checksum", F.lit(""))
    return hashed.join(known, "source_file", "left").withColumn(
        "problem",
        F.when(expected == "", "MISSING_CHECKSUM")
        .when((expected != F.col("sha256")) | (F.col("_least") != F.col("sha256")),
              "CHECKSUM_MISMATCH")).drop("_least")
