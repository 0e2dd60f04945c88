"""Reporting marts over the fact and over the classification."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbridge.contracts import (
    ACCEPTED, DUPLICATE_CONFLICT, DUPLICATE_REPLAY, FACT, MART_CURRENCY_SUMMARY, MART_DAILY_SALES,
    MART_DATA_QUALITY, MART_REGION_SALES, NUMERIC, QUARANTINE,
)
from tillbridge.functions.numeric import round_half_even
from tillbridge.operators.classification import flag_outliers
from tillbridge.sinks.store import Store, read_partitions, replace_partitions

_AMOUNTS = ("thb", "usd", "eur")


def _totals():
    """Exact totals next to report values of two decimals, rounded half-even."""
    exact = [F.sum(f"amount_{c}").cast(NUMERIC).alias(f"total_{c}") for c in _AMOUNTS]
    report = [
        round_half_even(F.sum(f"amount_{c}").cast(NUMERIC), 2).cast("decimal(38,2)").alias(f"report_{c}")
        for c in _AMOUNTS]
    return [F.count("*").alias("transactions"), *exact, *report]


def daily_sales(fact: DataFrame) -> DataFrame:
    return fact.groupBy("batch_date").agg(*_totals())


def region_sales(fact: DataFrame) -> DataFrame:
    return fact.groupBy("batch_date", "region").agg(*_totals())


def currency_summary(fact: DataFrame) -> DataFrame:
    """Metrics by original currency, with the total in that currency."""
    return fact.groupBy("batch_date", "currency").agg(
        F.sum("amount").cast(NUMERIC).alias("total_original"), *_totals())


def data_quality(classified: DataFrame, outliers: DataFrame) -> DataFrame:
    """Raw, accepted, quarantine, invalid, replay, conflict and warning rows per date.

    ``outliers`` is the accepted set with ``is_outlier``.
    """
    def reason(code):
        return F.count_if(F.array_contains("reason_codes", code))

    duplicate = F.arrays_overlap("reason_codes", F.array(F.lit(DUPLICATE_CONFLICT), F.lit(DUPLICATE_REPLAY)))
    counts = classified.groupBy("batch_date").agg(
        F.count("*").alias("raw_rows"),
        F.count_if("accepted").alias("accepted_rows"),
        F.count_if(~F.col("accepted")).alias("quarantine_rows"),
        F.count_if(~F.col("accepted") & ~duplicate).alias("invalid_rows"),
        reason(DUPLICATE_REPLAY).alias("replay_rows"),
        reason(DUPLICATE_CONFLICT).alias("conflict_rows"))
    warnings = outliers.groupBy("batch_date").agg(
        F.count_if("is_outlier").alias("warning_rows"))
    return counts.join(warnings, "batch_date", "left").fillna(0, ["warning_rows"])


def refresh_sales(fact: DataFrame, store: Store) -> None:
    """Store the three sales marts of the dates in ``fact``, in place of what they had.

    A date's rows depend on that date alone, so its partition is all the state there is: other
    dates are neither read nor written.
    """
    for contract, mart in ((MART_DAILY_SALES, daily_sales), (MART_REGION_SALES, region_sales),
                           (MART_CURRENCY_SUMMARY, currency_summary)):
        replace_partitions(mart(fact), store, contract)


def refresh_marts(spark: SparkSession, store: Store, dates: Iterable[date]) -> None:
    """Store all four marts of the given dates from the accepted, quarantined and fact rows of these dates."""
    dates = sorted(set(dates))
    refresh_sales(read_partitions(spark, store, FACT, dates), store)
    accepted = read_partitions(spark, store, ACCEPTED, dates, ["batch_date", "currency", "amount"])
    outcome = accepted.select("batch_date", F.lit(True).alias("accepted"), F.array().cast("array<string>").alias("reason_codes"))
    refused = read_partitions(spark, store, QUARANTINE, dates, ["batch_date", "reason_codes"]).select(
        "batch_date", F.lit(False).alias("accepted"), "reason_codes")
    replace_partitions(data_quality(outcome.unionByName(refused), flag_outliers(accepted)), store, MART_DATA_QUALITY)
