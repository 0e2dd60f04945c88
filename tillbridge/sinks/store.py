"""Namespaces and partitioned tables: create or verify, append once, count."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbridge.contracts import NAMESPACES, TABLES, TableContract
from tillbridge.errors import ContractError

_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
# File tables keep no NOT NULL; the comment of a column records it.
_REQUIRED = "required"
# Largest row count of a stored frame that is broadcast, checked by counting it.
BROADCAST_ROWS = 50_000
# Splits the output of one task, so that a large source file is not one large table file.
_RECORDS_PER_FILE = 20_000_000


@dataclass(frozen=True)
class Store:
    """Where the tables live: database name prefix and, optionally, a base location."""

    prefix: str = "sales"
    location: str | None = None

    def database(self, namespace: str) -> str:
        return f"{self.prefix}_{namespace}"

    def table(self, contract: TableContract) -> str:
        return f"{self.database(contract.namespace)}.{contract.name}"

    def folder(self, namespace: str) -> str | None:
        return None if self.location is None else f"{self.location.rstrip('/')}/{namespace}"


def ensure_namespace(spark: SparkSession, store: Store, namespace: str) -> str:
    """``created``, or ``verified`` when it exists at the expected location."""
    name, folder = store.database(namespace), store.folder(namespace)
    if not spark.catalog.databaseExists(name):
        at = "" if folder is None else f" LOCATION '{folder}'"
        spark.sql(f"CREATE DATABASE {name}{at}")
        return "created"
    if folder is not None:
        actual = spark.catalog.getDatabase(name).locationUri or ""
        if _path(actual) != _path(folder):
            raise ContractError(f"{name}: location {actual}, expected {folder}")
    return "verified"


def _path(uri: str) -> str:
    return uri.removeprefix("file:").replace("//", "/").rstrip("/").lower()


def _shape(spark: SparkSession, table: str):
    columns = spark.catalog.listColumns(table)
    shape = [(c.name, c.dataType, c.description == _REQUIRED) for c in columns]
    return shape, [c.name for c in columns if c.isPartition]


def ensure_table(spark: SparkSession, store: Store, contract: TableContract) -> str:
    """``created``, or ``verified`` when columns in their order, types, required columns
    and partition column equal the contract. Nothing that exists is altered."""
    table = store.table(contract)
    ordered = [*[n for n in contract.columns if n != contract.partition_column],
               contract.partition_column]
    if not spark.catalog.tableExists(table):
        columns = ", ".join(
            f"{n} {contract.schema[n].dataType.simpleString()}"
            + ("" if contract.schema[n].nullable else f" COMMENT '{_REQUIRED}'")
            for n in ordered)
        folder = store.folder(contract.namespace)
        at = "" if folder is None else f" LOCATION '{folder}/{contract.name}'"
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet "
            f"PARTITIONED BY ({contract.partition_column}){at}")
        # An empty append makes the folder; partitions of an earlier session that are
        # already there are picked up again.
        spark.table(table).limit(0).write.insertInto(table)
        spark.catalog.recoverPartitions(table)
        return "created"
    shape, partition = _shape(spark, table)
    required = set(contract.required)
    expected = [(n, contract.schema[n].dataType.simpleString(), n in required) for n in ordered]
    if shape != expected:
        raise ContractError(f"{table}: columns differ from the contract")
    if partition != [contract.partition_column]:
        raise ContractError(
            f"{table}: partitioned by {partition}, expected {contract.partition_column}")
    return "verified"


def ensure_store(spark: SparkSession, store: Store) -> dict[str, str]:
    """Create or verify the four namespaces and every table."""
    done = {store.database(n): ensure_namespace(spark, store, n) for n in NAMESPACES}
    done.update({store.table(c): ensure_table(spark, store, c) for c in TABLES})
    return done


def read_partitions(spark: SparkSession, store: Store, contract: TableContract,
                    dates: Iterable[date], columns: Iterable[str] | None = None) -> DataFrame:
    """Rows of the given partition dates, only the named columns."""
    columns = contract.columns if columns is None else list(columns)
    if not columns:
        raise ValueError("columns must not be empty")
    return spark.table(store.table(contract)).where(
        F.col(contract.partition_column).isin(sorted(set(dates)))).select(*columns)


def read_through(spark: SparkSession, store: Store, contract: TableContract,
                 last: date, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows of all partitions up to and including ``last``."""
    columns = contract.columns if columns is None else list(columns)
    if not columns:
        raise ValueError("columns must not be empty")
    return spark.table(store.table(contract)).where(
        F.col(contract.partition_column) <= F.lit(last)).select(*columns)


def scalar(frame: DataFrame) -> int:
    """First cell of a one-row result as an integer."""
    return int(frame.first()[0])


def partition_counts(spark: SparkSession, store: Store, contract: TableContract,
                     dates: Iterable[date]) -> dict[date, int]:
    """Stored rows per requested date, zero included. Reads file footers only."""
    counts = read_partitions(spark, store, contract, dates, [contract.partition_column]).groupBy(
        contract.partition_column).agg(F.count("*"))
    return {**dict.fromkeys(dates, 0), **{d: n for d, n in counts.collect()}}


def checked(frame: DataFrame, contract: TableContract) -> DataFrame:
    """Project to the contract; a NULL in a required column fails the write."""
    columns = []
    for field in contract.schema:
        value = F.col(field.name)
        if not field.nullable:
            message = f"{contract.name}.{field.name} is required"
            value = F.coalesce(value, F.raise_error(F.lit(message)).cast(field.dataType))
        columns.append(value.cast(field.dataType).alias(field.name))
    return frame.select(*columns)


def append(frame: DataFrame, store: Store, contract: TableContract) -> None:
    """Append rows in contract form, by column name: they are put into the order the
    table itself has, as an insert goes by position. Files of one date are written by few
    tasks only if the caller clusters the rows, see :func:`clustered`."""
    table = store.table(contract)
    checked(frame, contract).select(*frame.sparkSession.table(table).columns).write.option(
        "maxRecordsPerFile", _RECORDS_PER_FILE).insertInto(table)


def replace_partitions(frame: DataFrame, store: Store, contract: TableContract) -> None:
    """Put the rows of ``frame`` in place of the partitions it has rows for; others stay as they are."""
    spark, table = frame.sparkSession, store.table(contract)
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        checked(frame, contract).select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE, before)


def clustered(frame: DataFrame, contract: TableContract) -> DataFrame:
    """Bring the rows of a date together before a write, so a date gets few files.

    A rebalance splits a date that holds many rows over several tasks and merges small
    ones, both by size at run time.
    """
    return frame.hint("rebalance", contract.partition_column)


def append_new(frame: DataFrame, store: Store, contract: TableContract,
               dates: Iterable[date], spread: bool = False) -> dict[date, int]:
    """Append the rows whose ``source_row_id`` is not stored yet; inserted rows per date.

    Dates without stored rows skip the look-up of ids, so a first load shuffles nothing
    for it. Other dates read the ids of their own partitions only. ``spread`` says that
    the rows of a date are scattered over many tasks. One writer per date is assumed:
    look-up and append are two steps.
    """
    spark = frame.sparkSession
    dates = sorted(set(dates))
    before = partition_counts(spark, store, contract, dates)
    day = contract.partition_column
    fresh = [d for d in dates if before[d] == 0]
    known = [d for d in dates if before[d] > 0]
    if fresh:
        rows = frame.where(F.col(day).isin(fresh))
        append(clustered(rows, contract) if spread else rows, store, contract)
    if known:
        ids = read_partitions(spark, store, contract, known, [day, "source_row_id"])
        rows = anti_filter(frame.where(F.col(day).isin(known)), ids, day)
        append(clustered(rows, contract), store, contract)
    after = partition_counts(spark, store, contract, dates)
    return {d: after[d] - before[d] for d in dates}


def anti_filter(rows: DataFrame, stored: DataFrame, day: str = "batch_date") -> DataFrame:
    """Rows whose ``(day, source_row_id)`` is not in ``stored``."""
    return rows.join(stored.select(day, "source_row_id"), [day, "source_row_id"], "left_anti")


def broadcast_if_small(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a stored frame after counting it; a larger one joins by shuffle, where
    adaptive execution splits skewed partitions."""
    return F.broadcast(frame) if frame.limit(limit + 1).count() <= limit else frame


def write_manifest(manifest: DataFrame, folder: str) -> None:
    """One CSV file with header, in date and region order; one row per source file."""
    manifest.orderBy("business_date", "region").coalesce(1).write.options(
        header=True, emptyValue="").csv(folder)


def as_json(frame: DataFrame) -> DataFrame:
    """Rows as JSON text: decimals plain, dates and times ISO, NULL fields kept."""
    text = [
        F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "decimal"
        else F.col(f.name)
        for f in frame.schema]
    return frame.select(
        F.to_json(F.struct(*text), {"ignoreNullFields": "false"}).alias("json"))
