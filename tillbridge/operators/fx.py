"""Effective exchange rates: the latest publication on or before each business date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillbridge.contracts import FOREIGN_CURRENCIES, RAW_FX_RATES, require_columns
from tillbridge.functions.dates import with_iso_date
from tillbridge.functions.numeric import with_rate
from tillbridge.functions.text import canonical_code


def publications(raw_fx: DataFrame) -> DataFrame:
    """One row per published ``rate_date``: both rates and ``fx_status``.

    ``fx_status`` is ``OK`` or the first rule the publication breaks. Counts and maxima
    combine before the shuffle, so a publication with any number of rows is harmless.
    """
    require_columns(raw_fx, RAW_FX_RATES.columns, "raw FX rates")
    rows = with_iso_date(with_rate(raw_fx.select(
        "rate_date", "rate_date_raw", "mid_rate", canonical_code(F.col("currency")).alias("code"),
    ), "mid_rate", "rate"), "rate_date_raw", "stated")
    good_rate = F.coalesce(F.col("rate") > 0, F.lit(False))
    same_date = F.coalesce(F.col("stated") == F.col("rate_date"), F.lit(False))
    shape = rows.groupBy("rate_date").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("code") == c).alias(f"n_{c}") for c in FOREIGN_CURRENCIES],
        F.min(same_date).alias("dates_agree"),
        F.min(good_rate).alias("rates_valid"),
        *[F.max(F.when(F.col("code") == c, F.col("rate"))).alias(f"{c.lower()}_thb_rate")
          for c in FOREIGN_CURRENCIES])
    exact_pair = F.col("n") == len(FOREIGN_CURRENCIES)
    for c in FOREIGN_CURRENCIES:
        exact_pair = exact_pair & (F.col(f"n_{c}") == 1)
    status = (
        F.when(~exact_pair, "NOT_EXACT_PAIR")
        .when(~F.col("dates_agree"), "RATE_DATE_MISMATCH")
        .when(~F.col("rates_valid"), "INVALID_RATE")
        .otherwise("OK"))
    return shape.select("rate_date", "usd_thb_rate", "eur_thb_rate", status.alias("fx_status"))


def resolve_effective_fx(dates: DataFrame, published: DataFrame) -> DataFrame:
    """As-of look-up: one row per ``batch_date`` in ``dates``.

    The latest publication on or before the date is taken whether valid or not; there is
    no fallback to an older one. ``fx_status`` is that of the publication, or
    ``NO_PUBLICATION``; rates are NULL unless it is ``OK``.

    Both inputs have one row per calendar date, so their merge is a few hundred rows per
    year, and an ordered pass over it replaces a join of every date with every earlier
    publication.
    """
    calendar = dates.select("batch_date").distinct().join(
        published, F.col("batch_date") == F.col("rate_date"), "full_outer")
    up_to_now = Window.orderBy(F.coalesce("batch_date", "rate_date")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = F.when(F.col("rate_date").isNotNull(), F.struct(
        "rate_date", "usd_thb_rate", "eur_thb_rate", "fx_status"))
    latest = calendar.select(
        "batch_date", F.last(carried, ignorenulls=True).over(up_to_now).alias("p"),
    ).where("batch_date is not null")
    ok = F.col("p.fx_status") == "OK"
    return latest.select(
        "batch_date",
        F.col("p.rate_date").alias("fx_rate_date"),
        F.when(ok, F.col("p.usd_thb_rate")).alias("usd_thb_rate"),
        F.when(ok, F.col("p.eur_thb_rate")).alias("eur_thb_rate"),
        (F.col("p.rate_date") < F.col("batch_date")).alias("is_carried_forward"),
        F.datediff("batch_date", F.col("p.rate_date")).alias("staleness_days"),
        F.coalesce(F.col("p.fx_status"), F.lit("NO_PUBLICATION")).alias("fx_status"))


def snapshots(effective: DataFrame) -> DataFrame:
    """The resolved rates as a local frame: one row per date, evaluated once."""
    return effective.sparkSession.createDataFrame(effective.toArrow(), effective.schema)


def calendar_dates(bounds: DataFrame) -> DataFrame:
    """Every calendar date between the least and greatest ``batch_date``."""
    return bounds.agg(F.min("batch_date").alias("a"), F.max("batch_date").alias("b")).where(
        "a is not null").select(F.explode(F.sequence("a", "b")).alias("batch_date"))


def daily_fx_dimension(dates: DataFrame, published: DataFrame) -> DataFrame:
    """One row per date and foreign currency, carried forward with its lineage."""
    effective = resolve_effective_fx(dates, published)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("currency"), F.col(f"{c.lower()}_thb_rate").alias("thb_rate"))
        for c in FOREIGN_CURRENCIES])
    return effective.withColumn("pair", F.explode(pairs)).select(
        F.col("batch_date").alias("business_date"), "pair.currency",
        F.col("fx_rate_date").alias("rate_date"), "pair.thb_rate",
        "is_carried_forward", "staleness_days", "fx_status")
