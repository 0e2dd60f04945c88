"""CSV scans that keep every byte of text, with row numbers, identities and lineage."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillbridge.contracts import FX_HEADER, RAW_FX_RATES, RAW_TRANSACTIONS, TRANSACTION_HEADER
from tillbridge.sources import paths


def scan_csv(spark: SparkSession, files: str | Sequence[str], header: T.StructType,
             numbered: bool = True) -> DataFrame:
    """Read CSV files as text, exactly as written, plus ``path`` and, if ``numbered``, the
    row's number. Without numbers the scan runs in the JVM alone.

    A header that differs, or a row with a field too many or too few, fails the job. An
    empty field stays the empty string; CSV cannot express NULL.
    """
    rows = (
        spark.read.schema(header)
        .options(header=True, enforceSchema=False, mode="FAILFAST", escape='"',
                 multiLine=True, encoding="UTF-8")
        .csv(files)
        .select(*[F.coalesce(name, F.lit("")).alias(name) for name in header.names],
                F.col("_metadata.file_path").alias("path"))
    )
    return number_rows(rows, "path", "source_row_number") if numbered else rows


def scan_checked(spark: SparkSession, files: str | Sequence[str], header: T.StructType) -> DataFrame:
    """Read CSV files as text like :func:`scan_csv`, but judge them instead of failing.

    Header lines come as row 0. ``malformed`` says that a header line differs from ``header``,
    or that a row has a field too many or too few. One pass gives the rows and the verdicts.
    """
    schema = T.StructType([*header.fields, T.StructField("_malformed", T.StringType())])
    rows = (
        spark.read.schema(schema)
        .options(header=False, mode="PERMISSIVE", columnNameOfCorruptRecord="_malformed", escape='"',
                 multiLine=True, encoding="UTF-8")
        .csv(files)
        .select(*[F.coalesce(name, F.lit("")).alias(name) for name in header.names],
                F.col("_malformed").isNotNull().alias("malformed"), F.col("_metadata.file_path").alias("path"))
    )
    differs = F.array(*header.names) != F.array(*map(F.lit, header.names))
    return number_rows(rows, "path", "source_row_number").withColumns({
        "source_row_number": F.col("source_row_number") - 1,
        "malformed": F.col("malformed") | (F.col("source_row_number") == 1) & differs})


def file_verdicts(checked: DataFrame, *file_columns: str) -> DataFrame:
    """``rows``, ``malformed_rows`` and ``header_ok`` of each file of checked rows. An empty file
    has no row, so it has no verdict either."""
    row = F.col("source_row_number") > 0
    return checked.groupBy(*file_columns).agg(
        F.count_if(row).alias("rows"), F.count_if(row & F.col("malformed")).alias("malformed_rows"),
        (F.count_if(~row & F.col("malformed")) == 0).alias("header_ok"))


def number_rows(rows: DataFrame, file_column: str, number_column: str) -> DataFrame:
    """Number the rows of each file from 1, in file order, without a shuffle.

    Gzip and multi-line files are never split, so one task reads a file from start to
    end and a running count over its batches is the row number. A window over the file
    would send a large file through one sort instead. Apply straight after the scan.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField(number_column, T.LongType())])
    position = rows.columns.index(file_column)

    def run(batches):
        last, count = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            codes = batch.column(position).dictionary_encode()
            index = codes.indices.to_numpy(zero_copy_only=False)
            starts = np.concatenate(([0], np.flatnonzero(np.diff(index)) + 1))
            lengths = np.diff(np.append(starts, len(index)))
            numbers = np.arange(1, len(index) + 1, dtype=np.int64) - np.repeat(starts, lengths)
            names = codes.dictionary.to_pylist()
            if names[index[0]] == last:
                numbers[: lengths[0]] += count
            last, count = names[index[-1]], int(numbers[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers)], names=schema.names)

    return rows.mapInArrow(run, schema)


def row_identity(file: Column, checksum: Column, number: Column) -> Column:
    """SHA-256 over file name, checksum and row number."""
    return F.sha2(F.concat_ws("|", file, checksum, number.cast("string")), 256)


def instant(value: datetime) -> Column:
    """One UTC instant, in whole seconds, as a literal for all rows of a run."""
    if value.tzinfo is None:
        raise ValueError("the instant must carry a time zone")
    return F.lit(value.astimezone(timezone.utc).replace(microsecond=0)).cast("timestamp")


def _with_identity(rows: DataFrame, files: DataFrame, at: datetime) -> DataFrame:
    return rows.withColumn("source_file", paths.source_name(F.col("path"))).join(
        files, "source_file",
    ).withColumns({
        "source_row_id": row_identity(
            F.col("source_file"), F.col("source_checksum"), F.col("source_row_number")),
        "ingested_at": instant(at),
    })


def read_transactions(spark, locations: Sequence[str], files: DataFrame, at: datetime,
                      checked: bool = False) -> DataFrame:
    """Raw transaction rows. ``files`` has ``source_file`` and ``source_checksum``; the
    caller marks it for broadcast when its size allows. ``checked`` rows include header lines and
    tell whether they are ``malformed``."""
    rows = (scan_checked if checked else scan_csv)(spark, locations, TRANSACTION_HEADER)
    name = F.col("source_file")
    return _with_identity(rows, files, at).withColumns({
        "region": paths.region_of(name),
        "batch_date": paths.day_of(name),
    }).select(*RAW_TRANSACTIONS.columns, *["malformed"] * checked)


def read_fx(spark, locations: Sequence[str], files: DataFrame, at: datetime,
            checked: bool = False) -> DataFrame:
    """Raw FX rows. The partition date is that of the file; the row's own date text is
    kept next to it for the resolver to compare."""
    rows = (scan_checked if checked else scan_csv)(spark, locations, FX_HEADER).withColumnRenamed(
        "rate_date", "rate_date_raw")
    return _with_identity(rows, files, at).withColumn(
        "rate_date", paths.fx_day_of(F.col("source_file"))).select(
        *RAW_FX_RATES.columns, *["malformed"] * checked)
