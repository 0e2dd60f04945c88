"""Monthly-to-daily re-partitioning, and checks and manifest of the daily files."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbridge.contracts import REGIONS, SOURCE_MANIFEST, TRANSACTION_HEADER
from tillbridge.errors import SourceError
from tillbridge.session import drop_folder
from tillbridge.functions.dates import with_source_datetime
from tillbridge.sources import paths
from tillbridge.sources.files import file_hashes, list_files, move_file
from tillbridge.sources.scan import scan_csv

# Business dates, files, rows, first and last date of the full corpus.
FULL_CORPUS = (360, 1800, 3_672_845, "2025-07-22", "2026-07-16")


def file_name(path):
    return F.element_at(F.split(path, "/"), -1)


def daily_rows(monthly: DataFrame) -> DataFrame:
    """Give each monthly row its business date and region.

    ``monthly`` has the source columns and ``path``. A row whose ``dtts`` is no
    timestamp, or a file that is not named for a region, fails the job.
    """
    day = F.to_date("row_time")
    region = paths.matched(file_name(F.col("path")), paths.MONTHLY_NAME)
    return with_source_datetime(monthly, "dtts", "row_time").withColumns({
        "business_date": F.coalesce(
            day, F.raise_error(F.concat(F.lit("invalid dtts: "), "dtts")).cast("date")),
        "region": F.coalesce(
            region, F.raise_error(F.concat(F.lit("unsupported source file: "), "path"))),
    }).drop("row_time")


def split_to_daily(spark: SparkSession, monthly_root: str, out: str) -> DataFrame:
    """Split monthly regional files into ``business_date=D/sales_{region}_{yyyymmdd}.csv.gz``,
    the layout that validation, manifest, landing and raw load read.

    The rows of a date and region meet in one task, which writes them unchanged and in
    source order. Spark picks file names, so the files are renamed afterwards, one call
    per file. Returns one row: ``input_files``, ``output_files``, ``rows_written``,
    ``business_dates``.
    """
    files = list_files(spark, monthly_root, recursive=True).where(
        file_name(F.col("path")).rlike(r"\Asales_.*\.csv\.gz\z"))
    locations = [r.path for r in files.select("path").toLocalIterator()]
    if not locations:
        raise SourceError(f"no regional gzip CSV files below {monthly_root}")
    columns = TRANSACTION_HEADER.names
    written = f"{out.rstrip('/')}/_split-{uuid.uuid4().hex}"
    daily_rows(scan_csv(spark, locations, TRANSACTION_HEADER)).repartition(
        "business_date", "region").sortWithinPartitions(
        "business_date", "region", "path", "source_row_number",
    ).select(*columns, "business_date", "region").write.partitionBy("business_date", "region").options(
        header=True, compression="gzip", escape='"', emptyValue="", encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(written)
    days, outputs = set(), []
    for path in [r.path for r in list_files(spark, f"{written}/*/*/*.csv.gz").select("path").toLocalIterator()]:
        day, region = re.search(r"/business_date=([^/]+)/region=([^/]+)/", path).groups()
        target = f"{out.rstrip('/')}/business_date={day}/sales_{region}_{day.replace('-', '')}.csv.gz"
        move_file(spark, path, target)
        days.add(day)
        outputs.append(target)
    drop_folder(spark, written)
    rows = scan_csv(spark, outputs, TRANSACTION_HEADER, numbered=False).count()
    return spark.createDataFrame(
        [(len(locations), len(outputs), rows, len(days))],
        "input_files long, output_files long, rows_written long, business_dates long")


def file_statistics(rows: DataFrame, *keys) -> DataFrame:
    """Row count and least and greatest ``dtts`` text per file."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.min("dtts").alias("min_dtts"),
        F.max("dtts").alias("max_dtts"))


def row_violations(rows: DataFrame) -> DataFrame:
    """Rows of daily files whose ``dtts`` is no timestamp or lies on another date.

    ``rows`` has ``dtts``, ``file_path`` and ``business_date`` (text).
    """
    text, target = F.col("dtts"), F.col("business_date")
    # Nearly every row passes this test and is parsed no further.
    plainly_right = text.startswith(F.concat(target, F.lit(" "))) & text.substr(11, 99).rlike(
        r"^ ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z") & target.try_cast("date").isNotNull()
    day = F.date_format("row_time", "yyyy-MM-dd")
    rule = (
        F.when(day.isNull(), "INVALID_DTTS")
        .when(day != F.col("business_date"), "WRONG_DATE"))
    doubtful = rows.where(~F.coalesce(plainly_right, F.lit(False)))
    return with_source_datetime(doubtful, "dtts", "row_time").select(
        "file_path", rule.alias("rule"), F.col("dtts").alias("detail"),
    ).where("rule is not null")


def file_violations(files: DataFrame) -> DataFrame:
    """Folder, file name and region-set rules over a listing with ``file_path``
    (relative to the corpus root, ``business_date=.../name``)."""
    folder = F.split("file_path", "/")[0]
    name = file_name(F.col("file_path"))
    day = paths.matched(folder, paths.DAY_FOLDER)
    region = paths.matched(name, paths.DAILY_NAME, 1)
    named_day = paths.matched(name, paths.DAILY_NAME, 2)
    parsed = files.select(
        "file_path", folder.alias("folder"), region.alias("region"),
        F.when(day.try_cast("date").isNull(), "BAD_FOLDER")
        .when(region.isNull(), "BAD_FILE_NAME")
        .when(named_day != F.regexp_replace(day, "-", ""), "NAME_DATE_MISMATCH")
        .alias("rule"))
    single = parsed.where("rule is not null").select(
        "file_path", "rule", F.lit(None).cast("string").alias("detail"))
    regions = parsed.groupBy("folder").agg(
        F.count("*").alias("files"),
        *[F.max(F.col("region") == r).alias(f"has_{r}") for r in REGIONS])
    missing = F.array_compact(F.array(*[
        F.when(~F.coalesce(f"has_{r}", F.lit(False)), F.lit(r)) for r in REGIONS]))
    per_day = regions.select(
        F.col("folder").alias("file_path"),
        F.when(F.size(missing) > 0, "MISSING_REGION")
        .when(F.col("files") != len(REGIONS), "FILE_COUNT").alias("rule"),
        F.array_join(missing, "|").alias("detail")).where("rule is not null")
    return single.unionByName(per_day)


def _corpus(spark: SparkSession, root: str):
    pattern = f"{root}/business_date=*/sales_*.csv.gz"
    files = list_files(spark, pattern).withColumn(
        "file_path", F.regexp_extract("path", r"([^/]+/[^/]+)\z", 1))
    return pattern, files


def validate_daily(spark: SparkSession, root: str) -> DataFrame:
    """All violations of the daily source contract below ``root``; empty when valid."""
    pattern, files = _corpus(spark, root)
    if files.isEmpty():
        raise SourceError(f"no daily batch directories below {root}")
    rows = scan_csv(spark, pattern, TRANSACTION_HEADER, numbered=False).withColumns({
        "file_path": F.regexp_extract("path", r"([^/]+/[^/]+)\z", 1),
        "business_date": F.regexp_extract("path", r"business_date=([^/]+)/", 1),
    })
    return file_violations(files).unionByName(row_violations(rows))


def source_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per daily file, ordered by date and region."""
    pattern, files = _corpus(spark, root)
    relative = F.regexp_extract("path", r"([^/]+/[^/]+)\z", 1)
    rows = scan_csv(spark, pattern, TRANSACTION_HEADER, numbered=False).withColumn("file_path", relative)
    stats = file_statistics(rows, "file_path")
    hashed = file_hashes(spark, pattern).withColumn("file_path", relative)
    return hashed.join(stats, "file_path", "left").select(
        F.regexp_extract("file_path", paths.DAY_FOLDER, 1).alias("business_date"),
        paths.matched(file_name(F.col("file_path")), paths.DAILY_NAME).alias("region"),
        "file_path",
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.coalesce("min_dtts", F.lit("")).alias("min_dtts"),
        F.coalesce("max_dtts", F.lit("")).alias("max_dtts"),
        F.col("length").alias("compressed_bytes"),
        "sha256",
    ).orderBy("business_date", "region").to(SOURCE_MANIFEST)


def corpus_summary(manifest: DataFrame) -> DataFrame:
    """One row: business dates, files, rows, first and last date."""
    return manifest.agg(
        F.countDistinct("business_date").alias("business_dates"),
        F.count("*").alias("files"),
        F.sum("rows").alias("rows"),
        F.min("business_date").alias("start_date"),
        F.max("business_date").alias("end_date"))


def enforce_corpus(manifest: DataFrame, expected=FULL_CORPUS) -> None:
    """Fail unless the corpus totals equal the expected five values."""
    actual = tuple(corpus_summary(manifest).first())
    if actual != tuple(expected):
        raise SourceError(f"corpus differs: expected {tuple(expected)}, found {actual}")
