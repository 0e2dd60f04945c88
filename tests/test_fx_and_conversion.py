"""Publications, the as-of look-up, and exact conversion."""

import random
from datetime import date, timedelta
from decimal import ROUND_HALF_EVEN, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from fixtures import AT, DAY, fx_frame, fx_row
from tillbridge.contracts import ACCEPTED, FACT
from tillbridge.errors import ContractError
from tillbridge.operators.conversion import accepted_violations, convert, fact_rows
from tillbridge.operators.fx import (
    calendar_dates, daily_fx_dimension, publications, resolve_effective_fx, snapshots,
)

EFFECTIVE = ("batch_date date, fx_rate_date date, usd_thb_rate decimal(38,9), eur_thb_rate decimal(38,9), "
             "is_carried_forward boolean, staleness_days int, fx_status string")


def pair(day, usd="32", eur="40", **changes):
    return [fx_row("USD", usd, day, 1, **changes), fx_row("EUR", eur, day, 2, **changes)]


def resolve(spark, rows, *dates):
    frame = spark.createDataFrame([(d,) for d in dates], "batch_date date")
    done = resolve_effective_fx(frame, publications(fx_frame(spark, rows))).collect()
    return {r.batch_date: r for r in done}


def test_same_day_carry_forward_and_no_future(spark):
    later = DAY + timedelta(3)
    rows = pair(DAY) + pair(later, "33", "41") + pair(DAY - timedelta(9), "N/A")
    got = resolve(spark, rows, DAY - timedelta(10), DAY, DAY + timedelta(2), later)
    assert got[DAY - timedelta(10)].fx_status == "NO_PUBLICATION"
    assert got[DAY - timedelta(10)].fx_rate_date is None
    r = got[DAY]
    assert (r.usd_thb_rate, r.eur_thb_rate, r.is_carried_forward, r.staleness_days) == (32, 40, False, 0)
    r = got[DAY + timedelta(2)]
    assert (r.fx_rate_date, r.is_carried_forward, r.staleness_days) == (DAY, True, 2)
    assert got[later].usd_thb_rate == 33


@pytest.mark.parametrize("rows, status", [
    ([fx_row("USD", "32")], "NOT_EXACT_PAIR"),
    ([fx_row("EUR", "40")], "NOT_EXACT_PAIR"),
    (pair(DAY) + [fx_row("EUR", "40", n=3)], "NOT_EXACT_PAIR"),
    (pair(DAY) + [fx_row("GBP", "44", n=3)], "NOT_EXACT_PAIR"),
    ([fx_row("USD", "32"), fx_row("USD", "32", n=2)], "NOT_EXACT_PAIR"),
    (pair(DAY, rate_date_raw="2025-07-21"), "RATE_DATE_MISMATCH"),
    (pair(DAY, rate_date_raw="yesterday"), "RATE_DATE_MISMATCH"),
    (pair(DAY, rate_date_raw=" 20250722 "), "OK"),
    ([fx_row(" usd ", " 32 "), fx_row("eur", "4e1", n=2)], "OK"),
    *[(pair(DAY, usd=bad), "INVALID_RATE")
      for bad in ("", " ", "N/A", "NaN", "Infinity", "0", "-1", "0.0000000004", "9" * 30)],
])
def test_publication_rules_without_fallback(spark, rows, status):
    older = pair(DAY - timedelta(1))
    got = resolve(spark, older + rows, DAY)[DAY]
    assert got.fx_status == status and got.fx_rate_date == DAY
    assert (got.usd_thb_rate is None) == (status != "OK")


def test_rates_round_half_even(spark):
    got = resolve(spark, pair(DAY, "32.1234567885", "40.1234567895"), DAY)[DAY]
    assert (got.usd_thb_rate, got.eur_thb_rate) == (Decimal("32.123456788"), Decimal("40.123456790"))


def test_missing_fx_column(spark):
    with pytest.raises(ContractError, match="mid_rate"):
        publications(fx_frame(spark, pair(DAY)).drop("mid_rate"))


def test_daily_dimension_has_every_date(spark):
    bounds = spark.createDataFrame([(DAY,), (DAY + timedelta(4),)], "batch_date date")
    published = publications(fx_frame(spark, pair(DAY) + pair(DAY + timedelta(3), "33", "41")))
    rows = daily_fx_dimension(calendar_dates(bounds), published).orderBy("business_date", "currency").collect()
    assert len(rows) == 10
    assert [(r.currency, r.thb_rate, r.staleness_days) for r in rows[4:8]] == [
        ("EUR", 40, 2), ("USD", 32, 2), ("EUR", 41, 0), ("USD", 33, 0)]


def accepted(spark, rows):
    """rows: (id, day, amount text, currency)."""
    return spark.createDataFrame(rows, "source_row_id string, batch_date date, a string, currency string").selectExpr(
        "source_row_id AS txn", "TIMESTAMP_NTZ'2025-07-22 09:30:00' AS transaction_dt",
        "CAST(a AS decimal(38,9)) AS amount", "currency", "'bkk' AS region", "'f' AS source_file",
        "'c' AS source_checksum", "1L AS source_row_number", "source_row_id", "batch_date",
        "TIMESTAMP'2026-01-01 00:00:00' AS ingested_at", "TIMESTAMP'2026-01-01 00:00:00' AS classified_at",
    ).select(*ACCEPTED.columns)


def effective(spark, *rows):
    """rows: (day, usd, eur)."""
    return spark.createDataFrame(
        [(d, d, Decimal(u), Decimal(e), False, 0, "OK") for d, u, e in rows], EFFECTIVE)


def expected(amount, currency, usd, eur):
    with localcontext() as context:
        context.prec = 200
        a, rate = Decimal(amount), {"THB": Decimal(1), "USD": Decimal(usd), "EUR": Decimal(eur)}
        out = []
        for target in ("THB", "USD", "EUR"):
            value = (a * rate[currency] / rate[target]).quantize(Decimal("1e-9"), rounding=ROUND_HALF_EVEN)
            out.append(value if value < Decimal(10) ** 29 else None)
        return tuple(out)


def check(spark, cases, rates):
    """cases: (day, amount, currency); rates: day -> (usd, eur)."""
    rows = [(f"r{n}", d, a, c) for n, (d, a, c) in enumerate(cases)]
    fx = effective(spark, *[(d, *r) for d, r in rates.items()])
    got = {r.source_row_id: (r.amount_thb, r.amount_usd, r.amount_eur)
           for r in convert(accepted(spark, rows), fx).collect()}
    wrong = [(a, c, rates[d], got.get(i), expected(a, c, *rates[d])) for i, d, a, c in rows
             if got.get(i) != expected(a, c, *rates[d])]
    assert not wrong, wrong[:3]


def test_published_samples(spark):
    check(spark, [(DAY, "214.29", "THB"), (DAY, "4.99", "USD"), (DAY, "45.74", "EUR")],
          {DAY: ("32.2722", "37.6978")})


def test_identities_and_ties(spark):
    check(spark, [(DAY, "320", "THB"), (DAY, "10", "USD"), (DAY, "8", "EUR")], {DAY: ("32", "40")})
    check(spark, [(DAY, "1", "THB"), (DAY, "0.000000001", "THB"), (DAY, "0.000000003", "THB"), (DAY, "0", "USD")],
          {DAY: ("2", "7")})


def test_random_conversions_match_decimal(spark):
    rnd = random.Random(8)
    days = [DAY + timedelta(n) for n in range(40)]
    rates, cases = {}, []
    for n, d in enumerate(days):
        places = rnd.choice([0, 2, 4, 4, 9])
        top = [10, 100, 10**4, 10**6, 10**9][n % 5]
        rates[d] = tuple(str(Decimal(rnd.randint(10**places, top * 10**places)).scaleb(-places)) for _ in range(2))
        for _ in range(100):
            digits = rnd.choice([3, 6, 9, 12, 18, 24, 38])
            amount = Decimal(rnd.randint(0, 10**digits - 1)).scaleb(-rnd.choice([0, 2, 9]) if digits < 29 else -9)
            cases.append((d, str(amount), rnd.choice(["THB", "USD", "EUR"])))
    check(spark, cases, rates)


def test_extreme_rates_take_python_decimals(spark):
    rates = {DAY: ("0.000000001", "3"), DAY + timedelta(1): ("12345678901234567890.123456789", "7"),
             DAY + timedelta(2): ("32", "40")}
    cases = [(d, a, c) for d in rates for a in ("0", "1", "33.333333333", "123456789012") for c in ("THB", "USD", "EUR")]
    check(spark, cases, rates)


def test_fact_contract_and_unresolved_dates(spark):
    other = DAY + timedelta(1)
    rows = accepted(spark, [("a", DAY, "1", "THB"), ("b", other, "1", "THB")])
    fx = effective(spark, (DAY, "32", "40")).unionAll(spark.createDataFrame(
        [(other, other, None, None, False, 0, "INVALID_RATE")], EFFECTIVE))
    fact = fact_rows(rows, fx, AT)
    assert fact.columns == FACT.columns
    assert [f.dataType for f in fact.schema] == [f.dataType for f in FACT.schema]
    assert [r.source_row_id for r in fact.collect()] == ["a"]


def test_prechecks_count_each_violation(spark):
    rows = accepted(spark, [
        ("a", DAY, "1", "THB"), ("a", DAY, "1", "THB"), (" ", DAY, "1", "USD"), (None, DAY, "1", "USD"),
        ("n", DAY, "-1", "EUR"), ("m", DAY, None, "EUR"), ("g", DAY, "1", "GBP"),
        ("o", DAY, "9" * 29, "USD"), ("p", DAY, "9" * 29, "THB")])
    got = accepted_violations(rows, effective(spark, (DAY, "32.5", "40"))).first().asDict()
    assert got == dict(batch_date=DAY, blank_ids=2, repeated_ids=1, bad_amounts=2, bad_currencies=1, overflows=1)
    fine = accepted(spark, [("a", DAY, "1", "THB"), ("p", DAY, "9" * 29, "THB")])
    got = accepted_violations(fine, effective(spark, (DAY, "32.5", "40"))).first().asDict()
    assert set(got.values()) == {DAY, 0}


def test_snapshots_are_local(spark):
    frame = snapshots(effective(spark, (DAY, "32", "40")))
    assert frame.schema.simpleString() == effective(spark, (DAY, "32", "40")).schema.simpleString()
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation")
