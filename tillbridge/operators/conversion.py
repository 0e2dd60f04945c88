"""Three-currency conversion of accepted rows, exact to nine decimals."""

from __future__ import annotations

from datetime import datetime
from decimal import ROUND_HALF_EVEN, Decimal, localcontext

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tillbridge.contracts import ACCEPTED, BASE_CURRENCY, CURRENCIES, FACT, require_columns
from tillbridge.functions.numeric import (
    NUMERIC, let, long_units_to_numeric, multiply_divide_decimal, multiply_divide_long, to_units,
    units_to_numeric, with_steps,
)
from tillbridge.functions.text import strip
from tillbridge.sources.scan import instant

_TARGETS = ("thb", "usd", "eur")
# Bigint arithmetic takes rates as whole 1/10000, below 100000; decimal arithmetic takes
# them as whole 1e-9 of seven to nineteen digits.
_FINE = 10_000


def rate_terms(effective_fx: DataFrame) -> DataFrame:
    """Add the integer rates that the conversions use, per date.

    ``long_limit``: the largest amount for which bigint arithmetic cannot overflow, -1
    when the rates have more than four decimals. ``decimal_ok``: whether decimal
    arithmetic is exact for these rates.
    """
    def fine(rate: str) -> str:
        return f"CAST(CAST({rate} AS decimal(9,4)) * {_FINE}BD AS BIGINT)"

    return with_steps(
        effective_fx,
        {"_low": "least(1BD, usd_thb_rate, eur_thb_rate)",
         "_high": "greatest(1BD, usd_thb_rate, eur_thb_rate)"},
        {"_coarse": "_high < 100000 AND usd_thb_rate % 0.0001BD = 0 AND eur_thb_rate % 0.0001BD = 0",
         "decimal_ok": "_low >= 0.001 AND _high < 10000000000"},
        {"long_thb": f"{_FINE}L",
         **{f"long_{c}": f"CASE WHEN _coarse THEN {fine(f'{c}_thb_rate')} END" for c in ("usd", "eur")},
         "long_limit": f"""CAST(CASE WHEN _coarse
            THEN (9000000000 * {fine('_low')}) div {fine('_high')} ELSE -1 END AS {NUMERIC})""",
         "units_thb": "CAST(1000000000 AS decimal(38,0))",
         "units_usd": to_units("usd_thb_rate"),
         "units_eur": to_units("eur_thb_rate")})


_TERMS = ("long_thb", "long_usd", "long_eur", "long_limit", "units_thb", "units_usd",
          "units_eur", "decimal_ok")


def _converted(rows: DataFrame) -> DataFrame:
    """Add the three amounts; NULL where one does not fit ``decimal(38,9)``."""
    def rate(kind: str) -> str:
        whens = " ".join(f"WHEN '{c}' THEN {kind}_{c.lower()}" for c in CURRENCIES)
        return f"CASE currency {whens} END"

    rows = with_steps(rows, {
        "small": "CASE WHEN amount <= long_limit THEN CAST(amount * 1000000000BD AS BIGINT) END",
        "long_rate": rate("long"),
        "units_rate": rate("units"),
    })
    rows = multiply_divide_long(
        rows, *[(f"small_{t}", "small", "long_rate", f"long_{t}") for t in _TARGETS])
    large = let("units", multiply_divide_decimal(to_units("amount"), "units_rate", "target"),
                units_to_numeric("units"))
    targets = ", ".join(f"units_{t}" for t in _TARGETS)
    rows = with_steps(rows, {
        "large": f"CASE WHEN amount > long_limit THEN transform(array({targets}), target -> {large}) END"})
    return with_steps(rows, {
        f"amount_{t}": f"""CASE WHEN currency = '{t.upper()}' THEN amount
            WHEN small IS NOT NULL THEN {long_units_to_numeric(f'small_{t}')}
            ELSE large[{n}] END"""
        for n, t in enumerate(_TARGETS)})


_WIDE_RESULT = T.StructType(
    [T.StructField(f"amount_{target}", T.DecimalType(38, 9)) for target in _TARGETS])


@F.pandas_udf(_WIDE_RESULT)
def _convert_wide(amount: pd.Series, rate: pd.Series, usd: pd.Series, eur: pd.Series) -> pd.DataFrame:
    """Conversion for rates of any size, in Python decimals."""
    unit, top = Decimal("1e-9"), Decimal(10) ** 29
    with localcontext() as context:
        context.prec = 120
        rows = []
        for a, r, u, e in zip(amount, rate, usd, eur):
            row = [(a * r / over).quantize(unit, rounding=ROUND_HALF_EVEN)
                   for over in (Decimal(1), u, e)]
            rows.append([v if v < top else None for v in row])
    return pd.DataFrame(rows, columns=_WIDE_RESULT.names, dtype="object")


def convert(accepted: DataFrame, effective_fx: DataFrame) -> DataFrame:
    """Accepted rows with three amounts and the rate lineage of their date.

    THB is the bridge; each target is rounded once, half-even, from the unrounded THB
    value. Rows of dates without usable rates are left out; :func:`excluded_dates` reports them. An amount
    that does not fit ``decimal(38,9)`` is NULL, for the caller to reject its date.

    Nearly all rows take the bigint path, in generated code; amounts beyond its limit take
    the decimal one. Python is reached only by dates whose rates are outside 0.001 to
    1e10, and that branch is planned only if there are any. The rates have one
    row per date; pass :func:`tillbridge.operators.fx.snapshots` of them.
    """
    require_columns(accepted, ACCEPTED.columns, "accepted transactions")
    usable = rate_terms(effective_fx.where("fx_status = 'OK'"))
    lineage = ("fx_rate_date", "usd_thb_rate", "eur_thb_rate", "is_carried_forward", "staleness_days")
    columns = [*ACCEPTED.columns, *(f"amount_{t}" for t in _TARGETS), *lineage]

    regular = usable.where("decimal_ok").select("batch_date", *lineage, *_TERMS)
    native = _converted(accepted.join(F.broadcast(regular), "batch_date")).select(*columns)

    extreme = usable.where("not decimal_ok").select("batch_date", *lineage)
    if extreme.isEmpty():
        return native
    rate = (
        F.when(F.col("currency") == BASE_CURRENCY, F.lit(Decimal(1)).cast(NUMERIC))
        .when(F.col("currency") == "USD", F.col("usd_thb_rate"))
        .otherwise(F.col("eur_thb_rate")))
    wide = accepted.join(F.broadcast(extreme), "batch_date").withColumn(
        "_wide", _convert_wide("amount", rate, "usd_thb_rate", "eur_thb_rate"),
    ).select("*", "_wide.*").select(*columns)
    return native.unionByName(wide)


def excluded_dates(accepted: DataFrame, effective_fx: DataFrame) -> DataFrame:
    """Dates that :func:`convert` leaves out, with the reason and their accepted rows."""
    unusable = effective_fx.where("fx_status <> 'OK'").select("batch_date", "fx_status")
    return accepted.groupBy("batch_date").agg(F.count("*").alias("excluded_rows")).join(
        F.broadcast(unusable), "batch_date").select("batch_date", "fx_status", "excluded_rows")


def fact_rows(accepted: DataFrame, effective_fx: DataFrame, created_at: datetime) -> DataFrame:
    """Rows of the fact table."""
    return convert(accepted, effective_fx).withColumn(
        "fact_created_at", instant(created_at)).select(*FACT.columns)


def overflows(accepted: DataFrame, effective_fx: DataFrame) -> DataFrame:
    """Per date, the rows in a known currency whose amount does not fit once converted.

    Up to the bigint limit of its date no amount can overflow, so only the few rows above
    are converted. The misfits are counted, not filtered: a filter would be pushed below
    the conversion and repeat it.
    """
    limits = rate_terms(effective_fx.where("fx_status = 'OK'")).select(
        "batch_date", F.col("long_limit").alias("_limit"))
    large = accepted.join(F.broadcast(limits), "batch_date").where(
        (F.col("amount") > F.col("_limit")) & F.col("currency").isin(*CURRENCIES)).drop("_limit")
    return convert(large, effective_fx).groupBy("batch_date").agg(F.count_if(
        F.col("amount_thb").isNull() | F.col("amount_usd").isNull() | F.col("amount_eur").isNull(),
    ).alias("overflows"))


def accepted_violations(accepted: DataFrame, effective_fx: DataFrame) -> DataFrame:
    """Per date, how many accepted rows break each pre-check of the conversion: blank or
    repeated ids, missing or negative amounts, foreign currencies, overflows.

    One shuffle on the row id, with counts combined ahead of it.
    """
    require_columns(accepted, ACCEPTED.columns, "accepted transactions")
    checked = accepted.select(
        "batch_date",
        strip(F.col("source_row_id")).alias("row_id"),
        F.coalesce(F.col("amount") >= 0, F.lit(False)).alias("amount_ok"),
        F.coalesce(F.col("currency").isin(*CURRENCIES), F.lit(False)).alias("currency_ok"))
    per_id = checked.groupBy("batch_date", "row_id").agg(
        F.count("*").alias("copies"),
        F.count_if(~F.col("amount_ok")).alias("bad_amounts"),
        F.count_if(~F.col("currency_ok")).alias("bad_currencies"))
    blank = F.col("row_id") == ""
    counts = per_id.groupBy("batch_date").agg(
        F.sum(F.when(blank, F.col("copies")).otherwise(F.lit(0))).alias("blank_ids"),
        F.sum(F.when(~blank, F.col("copies") - 1).otherwise(F.lit(0))).alias("repeated_ids"),
        F.sum("bad_amounts").alias("bad_amounts"),
        F.sum("bad_currencies").alias("bad_currencies"))
    return counts.join(overflows(accepted, effective_fx), "batch_date", "left").fillna(
        0, ["overflows"])
