"""Publication gate: consumers see the rows of successful batches only, as the last successful run left them."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbridge.contracts import FACT, MART_DAILY_SALES, PUBLISHED, PUBLISHED_VERSIONS
from tillbridge.session import stored as stored_frames
from tillbridge.sinks.store import Store, append, clustered, read_partitions, replace_partitions
from tillbridge.sources.scan import instant

SUCCESS = "SUCCESS"


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last run of each date, by ``run_sequence``, which every run raises by one."""
    return runs.groupBy("batch_date").agg(
        F.max_by("status", "run_sequence").alias("status"),
        F.max_by("run_id", "run_sequence").alias("run_id"))


def published(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of dates whose last run succeeded. There is one such row per date, so the
    gate is broadcast and prunes partitions of a stored fact at run time."""
    gate = latest_runs(runs).where(F.col("status") == SUCCESS).select("batch_date")
    return rows.join(F.broadcast(gate), "batch_date", "left_semi")


def current_versions(versions: DataFrame) -> DataFrame:
    """The published version of each date: the last one a successful run recorded."""
    return versions.groupBy("batch_date").agg(F.max("version").alias("version"))


def publish(rows: DataFrame, store: Store, run_id: str, version: int, at: datetime) -> list[date]:
    """Make ``rows``, in the form of the fact, the published state of their dates.

    The rows are stored as a version first, and the version is recorded in one append after
    that: readers go by the record, so until then, and if this or a later run fails, they see
    the state before. The fact only grows, so a date with as many rows as its published version
    is unchanged and is left alone. Returns the dates with a new version.
    """
    spark = rows.sparkSession
    versions = spark.table(store.table(PUBLISHED_VERSIONS))
    known = versions.groupBy("batch_date").agg(F.max_by("rows", "version").alias("known"))
    counts = rows.groupBy("batch_date").agg(F.count("*").alias("rows"))
    changed = [r.batch_date for r in counts.join(known, "batch_date", "left").where(
        "known IS NULL OR known <> rows").collect()]
    if changed:
        new = rows.where(F.col("batch_date").isin(changed))
        append(clustered(new.withColumn("version", F.lit(version).cast("long")), PUBLISHED), store, PUBLISHED)
        stored = spark.table(store.table(PUBLISHED)).where((F.col("version") == version) & F.col("batch_date").isin(changed))
        append(stored.groupBy("batch_date").agg(F.count("*").alias("rows")).select(
            F.lit(version).cast("long").alias("version"), F.lit(run_id).alias("run_id"), "rows",
            instant(at).alias("published_at"), "batch_date"), store, PUBLISHED_VERSIONS)
    return changed


def last_good(spark: SparkSession, store: Store) -> DataFrame:
    """The published rows: of each date those of its published version."""
    current = current_versions(spark.table(store.table(PUBLISHED_VERSIONS)))
    return spark.table(store.table(PUBLISHED)).join(
        F.broadcast(current), ["batch_date", "version"], "left_semi").select(*FACT.columns)


def expire_versions(spark: SparkSession, store: Store, dates: Iterable[date]) -> None:
    """Remove the rows of all but the published version of the given dates."""
    rows = read_partitions(spark, store, PUBLISHED, dates)
    current = current_versions(spark.table(store.table(PUBLISHED_VERSIONS)))
    with stored_frames({"published": rows.join(F.broadcast(current), ["batch_date", "version"], "left_semi")}) as kept:
        replace_partitions(kept["published"], store, PUBLISHED)


def create_public_views(spark: SparkSession, store: Store) -> list[str]:
    """``published_transactions`` over the published versions, and ``published_daily_sales`` over the stored
    mart, which is refreshed with them: it reads no transaction."""
    rows, versions = store.table(PUBLISHED), store.table(PUBLISHED_VERSIONS)
    public, columns = store.database("public"), ", ".join(FACT.columns)
    transactions, daily = f"{public}.published_transactions", f"{public}.published_daily_sales"
    spark.sql(f"""
        CREATE OR REPLACE VIEW {transactions} AS
        SELECT {columns} FROM {rows} LEFT SEMI JOIN (
            SELECT batch_date, max(version) AS version FROM {versions} GROUP BY batch_date) AS current
        USING (batch_date, version)""")
    spark.sql(f"""
        CREATE OR REPLACE VIEW {daily} AS
        SELECT batch_date, transactions, total_thb, total_usd, total_eur FROM {store.table(MART_DAILY_SALES)}
        WHERE batch_date IN (SELECT batch_date FROM {versions})""")
    return [transactions, daily]
