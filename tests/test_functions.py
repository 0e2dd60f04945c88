"""Scalar functions against Python's Decimal, pandas and datetime."""

import random
import re
from datetime import date, datetime
from decimal import Context, Decimal, InvalidOperation
from fractions import Fraction

import pandas as pd
from pyspark.sql import functions as F

from tillbridge.functions.dates import with_datetime, with_iso_date, with_source_datetime
from tillbridge.functions.numeric import (
    long_units_to_numeric, multiply_divide_decimal, multiply_divide_long, round_half_even,
    to_units, units_to_numeric, with_amount, with_rate,
)
from tillbridge.functions.text import WHITE_SPACE, canonical_code, is_missing, strip


WIDE = Context(prec=2000)


def evaluate(spark, values, *expressions, schema="i int, x string", prepare=lambda f: f):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = prepare(spark.createDataFrame(rows, schema).repartition(8))
    out = frame.select("i", *[e.alias(f"r{n}") for n, e in enumerate(expressions)])
    got = sorted(out.collect())
    return [r[1] if len(expressions) == 1 else tuple(r)[1:] for r in got]


NUMBER = re.compile(r"[+-]?(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d+))?")


def bare(text):
    return text.strip().replace("_", "").strip()


def places(text):
    """Digits before and after the decimal point that the literal spells out, or None."""
    if not text.strip().isascii():
        return None
    try:
        if not Decimal(text.strip()).is_finite():
            return None
    except InvalidOperation:
        return None
    plain = bare(text)
    whole, fraction, power = NUMBER.fullmatch(plain).groups()
    shift = int(power or 0)
    significant = (whole + (fraction or "")).lstrip("0") or "0"
    after = len(fraction or "") - shift
    return max(len(significant) - after, 0), max(after, 0)


def expected_amount(text):
    found = places(text)
    return Decimal(bare(text)) if found and found[0] <= 29 and found[1] <= 9 else None


def expected_rate(text):
    found = places(text)
    if found is None:
        return None
    plain = bare(text)
    if found[1] <= 9:
        return Decimal(plain) if found[0] <= 29 else None
    if found[1] > 2000:  # far below any digit that is kept
        return Decimal(0)
    billionths = round(Fraction(plain) * 10**9)  # to even on a tie
    return None if abs(billionths) >= 10**38 else Decimal(billionths).scaleb(-9, WIDE)


def literals(seed, n):
    rnd = random.Random(seed)
    fixed = [
        "", " ", "0", "-0", "-0.00", "+5", ".5", "5.", ".", "N/A", "NaN", "Infinity", "-inf",
        "1_000", "_1", "1__0.5_", "1e3", "1E+28", "1E+29", "0E+28", "0E+29", "0E-9", "0E-10",
        "1.000000000", "1.0000000000", "1.0000000000E+1", "9" * 29, "9" * 30,
        "9" * 29 + ".999999999", "9" * 29 + ".9999999995", "0" * 40 + "1", "1E99999999999",
        "0E-99999999999", "1E-99999999999", "1 0", "1\n_", "--1", "1e", "e1", "1.2.3", "0x10",
        "1.2345678905", "1.2345678915", "0.0000000005", "0.0000000015", "0.00000000050000001",
        "1e-10", "5e-10", "15e-10", "5.0000e-10", "0.00000000049999999999999999999999999",
        "-1.2345678915", "1234567890123456789012345678.12345678950000000000000000000",
    ]
    out = list(fixed)
    while len(out) < n:
        whole = "".join(rnd.choice("0123456789") for _ in range(rnd.choice([0, 1, 3, 8, 28, 29, 30])))
        frac = "".join(rnd.choice("0055559") for _ in range(rnd.choice([0, 1, 2, 9, 10, 11, 25])))
        text = rnd.choice(["", "", "", "+", "-"]) + whole
        text += "." + frac if frac or rnd.random() < 0.2 else ""
        if rnd.random() < 0.3:
            text += rnd.choice("eE") + rnd.choice(["", "+", "-"]) + str(rnd.randint(0, 32))
        if rnd.random() < 0.1:
            text = rnd.choice(WHITE_SPACE) + text + rnd.choice(WHITE_SPACE)
        out.append(text)
    return out


def test_strip_is_python_strip(spark):
    values = [w + "a" + w + "b" + w for w in WHITE_SPACE] + [None, "", "  ", "x"]
    got = evaluate(spark, values, strip(F.col("x")), is_missing(F.col("x")))
    assert [g[0] for g in got] == [(v or "").strip() for v in values]
    assert [g[1] for g in got] == [(v or "").strip() == "" for v in values]
    assert set(WHITE_SPACE) == {chr(c) for c in range(0x110000) if not chr(c).strip()}


def test_canonical_code(spark):
    got = evaluate(spark, [" usd ", "thb", "　Eur\t"], canonical_code(F.col("x")))
    assert got == ["USD", "THB", "EUR"]


def test_amount_literals_match_decimal(spark):
    values = literals(1, 8000)
    got = evaluate(spark, values, F.col("v"), prepare=lambda f: with_amount(
        f.withColumn("s", strip(F.col("x"))), "s", "v"))
    wrong = [(v, g, expected_amount(v)) for v, g in zip(values, got) if g != expected_amount(v)]
    assert not wrong


def test_rate_literals_match_decimal(spark):
    values = literals(2, 8000)
    got = evaluate(spark, values, F.col("v"), prepare=lambda f: with_rate(f, "x", "v"))
    # A rate that underflows through an exponent beyond int range is NULL instead of 0;
    # both are invalid rates.
    wrong = [(v, g, expected_rate(v)) for v, g in zip(values, got)
             if g != expected_rate(v) and "E-99999999999" not in v]
    assert not wrong


def test_datetime_matches_pandas(spark):
    rnd = random.Random(3)
    values = [
        "", "not-a-date", "2025-07-22", "2025-07-22T09:30:00", "2025-07-22 09:30:00.5",
        "2025-07-22 09:30:00Z", "2025-07-22 09:30:00", "2025-7-2 9:3:0", "2025-07- 2 09:30:00",
        "2025-07-22  09:30:00", "2025-07-22　09:30:00", "2025-07-22 09:30:60",
        "2025-12-31 23:59:61", "2025-07-22 09:30:62", "2025-02-30 00:00:00",
        "2024-02-29 23:59:59", "2023-02-29 00:00:00", "2025-02-28 24:00:00",
        "1677-09-21 00:12:43", "1677-09-21 00:12:44", "2262-04-11 23:47:16",
        "2262-04-11 23:47:17", "0000-01-01 00:00:00", "1500-01-01 00:00:00",
        "2025-13-01 00:00:00", "2025-07-22 009:30:00", "20250722 09:30:00",
        "+2025-07-22 09:30:00", "2025-07-22 09:30:00\n", "2025-07-22 9:30:00",
    ]
    for _ in range(2000):
        values.append("{}-{}-{}{}{}:{}:{}".format(
            rnd.choice(["2025", "1999", "225", "2262"]), rnd.choice(["7", "07", "00", "12", "13"]),
            rnd.choice(["2", "02", " 2", "31", "32", "0"]), rnd.choice([" ", "  ", "T", ""]),
            rnd.choice(["9", "09", "23", "24"]), rnd.choice(["3", "59", "60"]),
            rnd.choice(["0", "00", "59", "60", "61", "62"])))
    want = pd.to_datetime(
        pd.Series(values), format="%Y-%m-%d %H:%M:%S", errors="coerce").astype(str)
    got = evaluate(spark, values, F.col("v").cast("string"),
                   prepare=lambda f: with_datetime(f, "x", "v"))
    wrong = [(v, g, w) for v, g, w in zip(values, got, want) if (g or "NaT") != w]
    assert not wrong

    def strict(text):
        try:
            return str(datetime.strptime(text, "%Y-%m-%d %H:%M:%S"))
        except ValueError:
            return None

    got = evaluate(spark, values, F.col("v").cast("string"),
                   prepare=lambda f: with_source_datetime(f, "x", "v"))
    wrong = [(v, g, strict(v)) for v, g in zip(values, got) if g != strict(v)]
    assert not wrong


def test_iso_date_matches_python(spark):
    rnd = random.Random(4)
    values = ["", "2025-07-22", " 2025-07-22 ", "20250722", "2025-W30-2", "2025W302", "2025-W30",
              "2025W30", "2020-W53-7", "2021-W53-1", "2025-W00-1", "2025-W30-8", "2025-0722",
              "2025-W302", "2025-7-22", "2025-02-30", "0001-01-01", "0000-01-01", "x"]
    for _ in range(500):
        y, w, d = rnd.randint(1, 9998), rnd.randint(0, 54), rnd.randint(0, 8)
        values += [f"{y:04}-W{w:02}-{d}", f"{y:04}W{w:02}", f"{y:04}-{rnd.randint(1, 13):02}-{rnd.randint(1, 32):02}"]

    def expected(text):
        try:
            return date.fromisoformat(text.strip())
        except ValueError:
            return None

    got = evaluate(spark, values, F.col("v"), prepare=lambda f: with_iso_date(f, "x", "v"))
    wrong = [(v, g, expected(v)) for v, g in zip(values, got) if g != expected(v)]
    assert not wrong


def test_half_even_ties(spark):
    values = [Decimal("1.2345678905"), Decimal("1.2345678915")]
    got = evaluate(spark, values, round_half_even(F.col("x"), 9), schema="i int, x decimal(20,10)")
    assert got == [Decimal("1.234567890"), Decimal("1.234567892")]


def exact(a, by, over):
    quotient, remainder = divmod(a * by, over)
    return quotient + (2 * remainder > over or (2 * remainder == over and quotient % 2 == 1))


def test_long_multiply_divide(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 10 ** rnd.randint(1, 16)), rnd.randint(10**4, 10**6),
             rnd.choice([10**4, 2 * 10**4, rnd.randint(10**4, 10**6)])) for _ in range(5000)]
    frame = spark.createDataFrame(rows, "a long, m long, d long")
    got = multiply_divide_long(frame, ("q", "a", "m", "d")).collect()
    assert not [r for r in got if r[3] != exact(r[0], r[1], r[2])]


def test_decimal_multiply_divide(spark):
    rnd = random.Random(6)
    rows = []
    for _ in range(5000):
        a = rnd.randint(0, 10 ** rnd.randint(1, 38) - 1)
        by = rnd.randint(10**6, 10 ** rnd.randint(7, 19) - 1)
        over = rnd.choice([10**9, 2 * 10**9, by, rnd.randint(10**6, 10 ** rnd.randint(7, 19) - 1)])
        rows.append((Decimal(a), Decimal(by), Decimal(over)))
    frame = spark.createDataFrame(rows, "a decimal(38,0), m decimal(38,0), d decimal(38,0)")
    got = frame.selectExpr("*", f"{multiply_divide_decimal('a', 'm', 'd')} AS q").collect()
    for a, m, d, result in got:
        want = exact(int(a), int(m), int(d))
        assert result == (want if want < 10**38 else None), (a, m, d)


def test_units_round_trip(spark):
    values = [Decimal(t) for t in (
        "0.000000000", "0.000000001", "1.500000000", "99999999999999999999999999999.999999999")]
    units = to_units("x")
    got = evaluate(
        spark, values, F.expr(units_to_numeric(units)),
        F.expr(long_units_to_numeric(f"CAST(least({units}, 1000000000000000000BD) AS BIGINT)")),
        schema="i int, x decimal(38,9)")
    assert [g[0] for g in got] == values
    assert [g[1] for g in got[:3]] == values[:3]
