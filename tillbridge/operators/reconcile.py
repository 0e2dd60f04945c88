"""Counts and id sets that must agree between layers, one row per business date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def counts_by_date(frame: DataFrame, name: str) -> DataFrame:
    return frame.groupBy("batch_date").agg(F.count("*").alias(name))


def _side_by_side(*counts: DataFrame) -> DataFrame:
    """Per-date count frames in one row per date; a date missing from one counts 0."""
    joined = reduce(lambda a, b: a.join(b, "batch_date", "full_outer"), counts)
    return joined.fillna(0)


def classification_balance(raw: DataFrame, accepted: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Raw rows against accepted plus quarantined rows."""
    return _side_by_side(
        counts_by_date(raw, "raw_rows"),
        counts_by_date(accepted, "accepted_rows"),
        counts_by_date(quarantine, "quarantine_rows"),
    ).withColumn(
        "reconciled",
        F.col("raw_rows") == F.col("accepted_rows") + F.col("quarantine_rows"))


def classified_balance(classified: DataFrame) -> DataFrame:
    """Accepted and quarantined rows of one classification pass."""
    return classified.groupBy("batch_date").agg(
        F.count("*").alias("classified_rows"),
        F.count_if("accepted").alias("accepted_rows"),
        F.count_if(~F.col("accepted")).alias("quarantine_rows"))


def fact_balance(accepted: DataFrame, fact: DataFrame) -> DataFrame:
    """Accepted rows against fact rows."""
    return _side_by_side(
        counts_by_date(accepted, "accepted_rows"), counts_by_date(fact, "fact_rows"),
    ).withColumn("reconciled", F.col("accepted_rows") == F.col("fact_rows"))


def _both_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    keys = ("batch_date", "source_row_id")
    return left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))


def differing_dates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Dates (``batch_date``) whose ids differ between the sides, each id as often as it is there.

    128 hash bits of each id are added up by date, with the left side positive and the right
    side negative, so order does not matter and equal sides cancel out. Tasks add up ahead of
    the shuffle, which carries a row per date and task and no id. Sums are taken over pieces of
    22 bits at most, so that 2**41 rows of a date cannot overflow. Null dates count as one date.
    """
    hashes = (F.xxhash64("source_row_id"), F.xxhash64(F.lit(1), "source_row_id"))
    pieces = [F.shiftrightunsigned(h, shift).bitwiseAND((1 << bits) - 1)
              for h in hashes for shift, bits in ((0, 21), (21, 21), (42, 22))]
    sign = F.col("l") - F.col("r")
    sums = _both_sides(left, right).groupBy("batch_date").agg(
        F.sum(sign).alias("rows"), *[F.sum(sign * p).alias(f"piece{k}") for k, p in enumerate(pieces)])
    return sums.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in sums.columns[1:]])).select("batch_date")


def id_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both directions of ``EXCEPT DISTINCT`` on ``(batch_date, source_row_id)``.

    ``side`` is ``LEFT_ONLY`` or ``RIGHT_ONLY``. Only ids of dates whose fingerprints differ
    are shuffled; one shuffle answers both directions, and ids that occur on a side more than
    once combine ahead of it. The broadcast side has one row per differing date. Both sides are
    read twice, so they should be stored tables.
    """
    keys = ("batch_date", "source_row_id")
    dates = F.broadcast(differing_dates(left, right).withColumnRenamed("batch_date", "differing"))
    both = _both_sides(left, right).join(dates, F.col("batch_date").eqNullSafe(F.col("differing")), "left_semi")
    seen = both.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return seen.where("l <> r").select(
        *keys, F.when(F.col("l") == 1, "LEFT_ONLY").otherwise("RIGHT_ONLY").alias("side"))


def full_chain(manifest: DataFrame, raw: DataFrame, accepted: DataFrame,
               quarantine: DataFrame, fact: DataFrame) -> DataFrame:
    """The quality gate of a date.

    ``manifest`` has ``batch_date`` and ``rows`` per source file. Every manifest row must
    be a raw row with an id of its own, every raw row classified once, and every accepted
    row a fact row with all three amounts.
    """
    source = manifest.groupBy("batch_date").agg(F.sum("rows").cast("long").alias("manifest_rows"))
    per_id = raw.groupBy("batch_date", "source_row_id").agg(F.count("*").alias("n"))
    unique = per_id.groupBy("batch_date").agg(
        F.sum("n").cast("long").alias("raw_rows"), F.count("*").alias("raw_unique_rows"))
    facts = fact.groupBy("batch_date").agg(
        F.count("*").alias("fact_rows"),
        F.count_if(F.col("amount_thb").isNull() | F.col("amount_usd").isNull()
                   | F.col("amount_eur").isNull() | F.col("fx_rate_date").isNull())
        .alias("missing_fx_rows"))
    chain = _side_by_side(
        source, unique, counts_by_date(accepted, "accepted_rows"),
        counts_by_date(quarantine, "quarantine_rows"), facts)
    classified = F.col("accepted_rows") + F.col("quarantine_rows")
    return chain.withColumn("classified_rows", classified).withColumn(
        "quality_gate",
        (F.col("manifest_rows") == F.col("raw_rows"))
        & (F.col("raw_rows") == F.col("raw_unique_rows"))
        & (F.col("raw_unique_rows") == F.col("classified_rows"))
        & (F.col("fact_rows") == F.col("accepted_rows"))
        & (F.col("missing_fx_rows") == 0))
