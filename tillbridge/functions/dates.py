"""Strict text-to-date and text-to-timestamp conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillbridge.functions.numeric import let, with_steps
from tillbridge.functions.text import WHITE_SPACE, strip

_PADDED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
# Unpadded fields, a blank-padded day, any run of white space between date and time,
# and seconds 60 and 61, which roll over into the next minute.
_UNPADDED = (
    r"^([0-9]{4})-(1[0-2]|0?[1-9])-(?:(3[01]|[12][0-9]|0?[1-9])| ([1-9]))"
    rf"[{WHITE_SPACE}]+"
    r"(2[0-3]|[01]?[0-9]):([0-5]?[0-9]):(6[01]|[0-5]?[0-9])\z"
)
# Whole seconds that fit a signed 64-bit nanosecond clock.
_EARLIEST = "1677-09-21 00:12:44"
_LATEST = "2262-04-11 23:47:16"


def with_datetime(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: ``yyyy-MM-dd HH:mm:ss`` text as ``timestamp_ntz``, else NULL.

    Seconds 60 and 61 roll over into the next minute, and values outside the
    nanosecond clock are NULL. ``text`` is a stripped column.
    """
    return with_steps(_with_datetime(rows, text, "any_time"), {
        out: f"""CASE WHEN any_time BETWEEN TIMESTAMP_NTZ'{_EARLIEST}'
            AND TIMESTAMP_NTZ'{_LATEST}' THEN any_time END"""}).drop("any_time")


def with_source_datetime(rows: DataFrame, text: str, out: str) -> DataFrame:
    """As :func:`with_datetime` for source validation: the text is taken untrimmed,
    seconds end at 59, and years run from 1 to 9999."""
    return with_steps(_with_datetime(rows, text, "any_time"), {
        out: rf"""CASE WHEN any_time >= TIMESTAMP_NTZ'0001-01-01 00:00:00'
            AND NOT {text} RLIKE r':6[01]\z' THEN any_time END"""}).drop("any_time")


def _with_datetime(rows: DataFrame, text: str, out: str) -> DataFrame:
    # The padded form takes one pattern test and Spark's own cast. Only the others get the
    # second pattern, which brings them into that form, seconds apart.
    minute = f"try_cast(regexp_replace({text}, r'{_UNPADDED}', '$1-$2-$3$4 $5:$6:00') AS TIMESTAMP_NTZ)"
    second = f"try_cast(regexp_extract({text}, r'{_UNPADDED}', 7) AS INT)"
    return with_steps(
        rows,
        {"_padded": f"CASE WHEN {text} RLIKE r'{_PADDED}' THEN try_cast({text} AS TIMESTAMP_NTZ) END"},
        {out: f"""CASE WHEN _padded IS NOT NULL THEN _padded
            WHEN {text} RLIKE r'{_UNPADDED}'
            THEN {minute} + make_dt_interval(0, 0, 0, {second}) END"""})


def with_iso_date(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: ISO 8601 date text as ``date``, in calendar (``2025-07-22``,
    ``20250722``) or week form (``2025-W30-2``, ``2025W302``, day optional), else NULL."""
    iso = "_iso"
    plain = f"replace({iso}, '-', '')"
    # 4 January always lies in ISO week 1, 28 December in the last one.
    monday = let("fourth", "try_cast(concat(left(p, 4), '-01-04') AS DATE)",
                 "date_sub(fourth, weekday(fourth))")
    weeks = "weekofyear(try_cast(concat(left(p, 4), '-12-28') AS DATE))"
    by_week = let("p", plain, let("week", "CAST(substring(p, 6, 2) AS INT)", f"""
        CASE WHEN week BETWEEN 1 AND {weeks} THEN date_add(
            {monday}, (week - 1) * 7 + CAST(coalesce(nullif(substring(p, 8, 1), ''), '1') AS INT) - 1)
        END"""))
    compact = "concat_ws('-', left(_iso, 4), substring(_iso, 5, 2), substring(_iso, 7, 2))"
    return with_steps(
        rows.withColumn(iso, strip(F.col(text))),
        {"_day": rf"""CASE
            WHEN {iso} RLIKE r'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\z' THEN try_cast({iso} AS DATE)
            WHEN {iso} RLIKE r'^[0-9]{{8}}\z' THEN try_cast({compact} AS DATE)
            WHEN {iso} RLIKE r'^[0-9]{{4}}(-W[0-9]{{2}}(-[1-7])?|W[0-9]{{2}}[1-7]?)\z' THEN {by_week} END"""},
        {out: "CASE WHEN _day >= DATE'0001-01-01' THEN _day END"}).drop(iso)
