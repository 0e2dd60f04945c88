"""Classify raw transactions as accepted or quarantined, for any set of dates at once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillbridge.contracts import (
    ACCEPTED, BASE_REASONS, CURRENCIES, DUPLICATE_CONFLICT, DUPLICATE_REPLAY, QUARANTINE,
    RAW_TRANSACTIONS, REGIONS, require_columns,
)
from tillbridge.functions.dates import with_datetime
from tillbridge.functions.numeric import (
    multiply_divide_decimal, to_units, units_to_numeric, with_amount,
)
from tillbridge.functions.text import canonical_code, strip
from tillbridge.operators.hotkeys import heavy_hitters
from tillbridge.sinks.store import broadcast_if_small
from tillbridge.sources.scan import instant

# A transaction id with more rows than this in one batch is resolved by pre-aggregation.
HOT_ROWS = 100_000

_PAYLOAD = ("transaction_dt", "amount_numeric", "currency_code", "region")


def canonicalize(raw: DataFrame) -> DataFrame:
    """Add typed values and the failed base rules to raw rows.

    New columns: ``txn_id``, ``transaction_dt``, ``amount_numeric``, ``currency_code``, and
    ``reason_flags``, one bit per rule: a number is cheaper to compute, shuffle and test
    than a list, see :func:`base_reasons`. The raw columns stay as they are.
    """
    require_columns(raw, RAW_TRANSACTIONS.columns, "raw transactions")
    typed = raw.select(*RAW_TRANSACTIONS.columns).withColumns({
        "txn_id": strip(F.col("txn")),
        "currency_code": canonical_code(F.col("currency")),
        "_dtts": strip(F.col("dtts")),
        "_amount": strip(F.col("amount")),
    })
    typed = with_datetime(typed, "_dtts", "transaction_dt")
    typed = with_amount(typed, "_amount", "amount_numeric").drop("_dtts", "_amount")
    rules = {
        "MISSING_TXN": "txn_id = ''",
        "INVALID_DTTS": "transaction_dt IS NULL",
        "DTTS_BATCH_DATE_MISMATCH": "CAST(transaction_dt AS DATE) <> batch_date",
        "INVALID_AMOUNT": "amount_numeric IS NULL",
        "NEGATIVE_AMOUNT": "amount_numeric < 0",
        "INVALID_CURRENCY": f"currency_code NOT IN {CURRENCIES}",
        "INVALID_REGION": f"NOT coalesce(region IN {REGIONS}, false)",
    }
    bits = " + ".join(f"IF({rules[code]}, {1 << n}, 0)" for n, code in enumerate(BASE_REASONS))
    return typed.withColumn("reason_flags", F.expr(bits))


def base_reasons(flags: Column) -> Column:
    """Reason codes of the set bits, in reporting order."""
    return F.array_compact(F.array(*[
        F.when(flags.bitwiseAND(F.lit(1 << n)) != 0, F.lit(code))
        for n, code in enumerate(BASE_REASONS)]))


def mark_duplicates(canonical: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``duplicate_reason``: NULL, ``DUPLICATE_CONFLICT`` or ``DUPLICATE_REPLAY``.

    Rows that fail a base rule neither get a duplicate reason nor influence one. Scope is
    one ``batch_date``. Differing payloads make every copy a conflict; equal ones are
    replays of the copy with the lowest ``(source_file, source_row_number)``.

    One shuffle and one sort by ``(batch_date, txn_id)`` serve nearly all ids. Ids of
    ``hot_rows`` rows or more, counted beforehand, are judged by pre-aggregation.
    Their rows, and rows that fail a base rule, need no neighbours and are spread over all
    partitions by their own row id.
    """
    valid = F.col("reason_flags") == 0
    key = F.xxhash64("batch_date", "txn_id")
    payload = F.struct(*_PAYLOAD)
    order = F.struct("source_file", "source_row_number")
    # Invalid rows may make an id look hot; that only picks the method.
    hot = heavy_hitters(canonical, F.when(F.col("txn_id") != "", key), hot_rows)

    alone, judged = ~valid, canonical
    any_hot = not hot.isEmpty()
    if any_hot:
        verdicts = broadcast_if_small(_hot_verdicts(canonical, key, hot, payload, order))
        judged = canonical.join(verdicts, ["batch_date", "txn_id"], "left")
        alone = alone | F.col("hot_conflict").isNotNull()
    # The hash leads the sort, where it decides nearly every comparison as a number; the
    # columns behind it keep the grouping exact.
    ordered = Window.partitionBy("_key", "_alone", "batch_date", "txn_id").orderBy(
        "source_file", "source_row_number")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    judged = judged.withColumns({
        "_alone": alone,
        "_key": F.when(alone, F.xxhash64("source_row_id")).otherwise(key),
    }).withColumns({
        "_replay": F.row_number().over(ordered) > 1,
        "_conflict": F.min(payload).over(whole) != F.max(payload).over(whole),
    })
    conflict, replay = F.col("_conflict"), F.col("_replay")
    if any_hot:
        conflict = F.coalesce("hot_conflict", conflict)
        replay = F.when(F.col("hot_conflict").isNull(), replay).otherwise(F.col("hot_first") != order)
    return judged.withColumn(
        "duplicate_reason",
        F.when(valid & conflict, DUPLICATE_CONFLICT).when(valid & replay, DUPLICATE_REPLAY),
    ).drop("_key", "_alone", "_replay", "_conflict", "hot_conflict", "hot_first")


def _hot_verdicts(canonical: DataFrame, key: Column, hot: DataFrame, payload: Column,
                  order: Column) -> DataFrame:
    """Whether a hot id is in conflict, and its first copy. One row per hot id; the rows
    combine before the shuffle.

    Invalid rows enter as NULL. A filter would be pushed below the parsing steps and
    repeat them.
    """
    valid = F.col("reason_flags") == 0
    valid_payload, valid_order = F.when(valid, payload), F.when(valid, order)
    rows = canonical.join(broadcast_if_small(hot), key == F.col("k"), "left_semi")
    return rows.groupBy("batch_date", "txn_id").agg(
        (F.min(valid_payload) != F.max(valid_payload)).alias("hot_conflict"),
        F.min(valid_order).alias("hot_first"))


def classify(raw: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Raw rows with typed values, ``reason_codes`` and ``accepted``; no row is lost."""
    marked = mark_duplicates(canonicalize(raw), hot_rows)
    reasons = F.when(
        F.col("duplicate_reason").isNotNull(), F.array("duplicate_reason"),
    ).otherwise(base_reasons(F.col("reason_flags")))
    return marked.withColumns({
        "reason_codes": reasons,
        "accepted": (F.col("reason_flags") == 0) & F.col("duplicate_reason").isNull(),
    }).drop("reason_flags", "duplicate_reason")


def accepted_rows(classified: DataFrame, classified_at: datetime) -> DataFrame:
    """Typed rows of the accepted table."""
    return classified.where("accepted").select(
        F.col("txn_id").alias("txn"),
        "transaction_dt",
        F.col("amount_numeric").alias("amount"),
        F.col("currency_code").alias("currency"),
        "region", "source_file", "source_checksum", "source_row_number", "source_row_id",
        "batch_date", "ingested_at",
        instant(classified_at).alias("classified_at"),
    ).select(*ACCEPTED.columns)


def quarantine_rows(classified: DataFrame, quarantined_at: datetime) -> DataFrame:
    """Rows of the quarantine table: raw values untouched, with their reasons."""
    return classified.where("not accepted").withColumn(
        "quarantined_at", instant(quarantined_at)).select(*QUARANTINE.columns)


def reason_counts(classified: DataFrame) -> DataFrame:
    """Rows per date and reason code; a row counts once for each of its reasons."""
    return classified.select(
        "batch_date", F.explode("reason_codes").alias("reason_code"),
    ).groupBy("batch_date", "reason_code").agg(F.count("*").alias("rows"))


def flag_outliers(accepted: DataFrame, factor: int = 5) -> DataFrame:
    """Add ``outlier_threshold`` and ``is_outlier`` to accepted rows; nothing is dropped.

    An amount is an outlier above ``factor`` times the mean amount of its date and
    currency. Sum and count combine before the shuffle, and the statistics have three
    rows per date, so they are broadcast.
    """
    stats = accepted.groupBy("batch_date", "currency").agg(
        F.sum("amount").cast("decimal(38,9)").alias("total"), F.count("*").alias("n"))
    # Sum and count are scaled alike so that the divisor has the digits the exact
    # division asks for.
    threshold = multiply_divide_decimal(to_units("total"), f"{factor * 10**6}L", f"n * {10**6}L")
    limits = stats.selectExpr("batch_date", "currency", f"{threshold} AS units").selectExpr(
        "batch_date", "currency", f"{units_to_numeric('units')} AS outlier_threshold")
    return accepted.join(F.broadcast(limits), ["batch_date", "currency"]).withColumn(
        "is_outlier", F.col("amount") > F.col("outlier_threshold"))
