"""Exact ``decimal(38,9)`` parsing, rounding and conversion arithmetic.

Nothing here uses floating point. Spark's own decimal division and string cast round
half-up, so values that need half-even rounding are built from integer quotients and
remainders.

The common case of each function is one or two plain expressions that stay inside a
generated stage. The rare cases are written with :func:`let`, which is evaluated only for
rows that need it and keeps the generated code small enough for the JVM to compile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillbridge.functions.text import strip

NUMERIC = "decimal(38,9)"
MAX_SCALE = 9
MAX_INTEGER_DIGITS = 29


def with_steps(rows: DataFrame, *steps: dict[str, str], drop: str = "_") -> DataFrame:
    """Add the columns of each step, SQL text by name; a step sees the ones before it.

    Columns of the steps that start with ``drop`` are dropped at the end.
    """
    helpers = []
    for step in steps:
        rows = rows.selectExpr("*", *[f"{sql} AS {name}" for name, sql in step.items()])
        helpers += [name for name in step if name.startswith(drop)]
    return rows.drop(*helpers)


def let(name: str, value: str, body: str) -> str:
    """SQL that computes ``value`` once and uses it as ``name`` in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


# Plain literals: any leading zeros, up to 29 more integer digits, up to nine decimals.
_PLAIN = r"^[+-]?(?=[.]?[0-9])0*[0-9]{0,29}([.][0-9]{0,9})?\z"
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,9})?\z"


def _scale(literal: str) -> str:
    """SQL for the decimals of a literal as written, less its exponent."""
    exponent = f"try_cast(regexp_extract({literal}, r'[eE](.*)', 1) AS INT)"
    return f"length(regexp_extract({literal}, r'[.]([0-9]*)', 1)) - coalesce({exponent}, 0)"


def _digits(literal: str) -> str:
    """SQL for the digits of a literal from the first one that is not 0; ``0`` for zero."""
    bare = f"regexp_replace(regexp_replace({literal}, r'[eE].*|[^0-9]', ''), '^0+(?=.)', '')"
    return bare


def with_amount(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: amount text (already stripped) as ``decimal(38,9)``, NULL when not
    storable.

    The literal decides: more than nine decimals or 29 integer digits as written are
    invalid, even where the value itself would fit. Underscores between or around digits
    are legal separators. Only literals with an exponent are taken apart.
    """
    literal = "_literal"
    cast = f"try_cast({literal} AS {NUMERIC})"
    # Branches, not AND and OR: Spark computes what occurs twice in those up front, for
    # every row.
    scale = f"({_scale(literal)})"
    scientific = f"""CASE WHEN {scale} <= {MAX_SCALE} THEN
        CASE WHEN length({_digits(literal)}) - {scale} <= {MAX_INTEGER_DIGITS} THEN {cast} END END"""
    return with_steps(
        rows,
        {literal: f"translate({text}, '_', '')"},
        {out: f"""CASE WHEN {literal} RLIKE r'{_PLAIN}' THEN {cast}
            WHEN {literal} RLIKE r'[eE]' THEN
                CASE WHEN {literal} RLIKE r'{_NUMBER}' THEN {scientific} END END"""})


def with_rate(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: rate text as ``decimal(38,9)``. Excess decimals are rounded half-even;
    more than 29 integer digits (before or after rounding), blanks and non-numbers are
    NULL.

    The rounding works on the digit string, so literals of any length stay exact.
    """
    literal = "_literal"
    # drop: digits to cut off the end; size: digits there are.
    up = """CASE WHEN tail > half OR (tail = half AND right(head, 1) IN ('1', '3', '5', '7', '9'))
        THEN 1BD ELSE 0BD END"""
    sign = f"CASE WHEN {literal} LIKE '-%' THEN '-' ELSE '' END"
    rounded = let("head", "substring(concat('0', digits), 1, size + 1 - cut)", let(
        "tail", "substring(concat('0', digits), size + 2 - cut, cut)", let(
            "half", "rpad('5', cut, '0')", let(
                "units", f"try_add(try_cast(head AS decimal(38,0)), {up})",
                f"try_cast(concat({sign}, {_units_text('units')}) AS {NUMERIC})"))))
    general = let("digits", _digits(literal), let("size", "length(digits)", let(
        "cut", f"{_scale(literal)} - {MAX_SCALE}",
        f"""CASE WHEN size - (cut + {MAX_SCALE}) > {MAX_INTEGER_DIGITS} THEN NULL
            WHEN cut <= 0 THEN try_cast({literal} AS {NUMERIC})
            WHEN cut > size THEN CAST(0 AS {NUMERIC})
            ELSE {rounded} END""")))
    return with_steps(
        rows.withColumn(literal, F.translate(strip(F.col(text)), "_", "")),
        {out: f"""CASE WHEN {literal} RLIKE r'{_PLAIN}' THEN try_cast({literal} AS {NUMERIC})
            WHEN {literal} RLIKE r'{_NUMBER}' THEN {general} END"""}).drop(literal)


def _units_text(units: str) -> str:
    """SQL for a non-negative count of 1e-9 units as decimal text."""
    text = f"lpad(CAST({units} AS STRING), 39, '0')"
    return f"concat(substring({text}, 1, 30), '.', substring({text}, 31, 9))"


def round_half_even(c: Column, scale: int) -> Column:
    return F.bround(c, scale)


def to_units(amount: str) -> str:
    """SQL for a ``decimal(38,9)`` as a whole number of 1e-9 units, ``decimal(38,0)``."""
    whole = f"CAST(floor({amount}) AS decimal(29,0))"
    fraction = f"CAST(({amount} % 1BD) * 1000000000BD AS decimal(10,0))"
    return f"CAST({whole} * 1000000000BD + {fraction} AS decimal(38,0))"


def units_to_numeric(units: str) -> str:
    """SQL for ``decimal(38,0)`` units of 1e-9, not negative, as ``decimal(38,9)``."""
    return f"try_cast({_units_text(units)} AS {NUMERIC})"


def long_units_to_numeric(units: str) -> str:
    """As :func:`units_to_numeric` for bigint units, without the detour over text."""
    return f"CAST(CAST({units} AS decimal(19,0)) * 0.000000001BD AS {NUMERIC})"


def _half_even(remainder: str, over: str, odd: str) -> str:
    return (f"CASE WHEN {remainder} > {over} - {remainder} OR "
            f"({remainder} = {over} - {remainder} AND {odd} = 1) THEN 1 ELSE 0 END")


def _merged(quotients, *makers) -> list[dict[str, str]]:
    return [{name: sql for q in quotients for name, sql in make(*q).items()} for make in makers]


def multiply_divide_long(rows: DataFrame, *quotients: tuple[str, str, str, str]) -> DataFrame:
    """For each ``(out, a, by, over)`` add ``out = a * by / over`` rounded half-even.

    All bigint columns, ``a`` not negative. Splitting ``a`` by ``over`` first keeps every
    intermediate near the size of the result instead of the size of the product.
    """
    return with_steps(rows, *_merged(
        quotients,
        lambda out, a, by, over: {
            f"_{out}_high": f"({a} div {over}) * {by}",
            f"_{out}_rest": f"({a} % {over}) * {by}"},
        lambda out, a, by, over: {
            f"_{out}_whole": f"_{out}_high + (_{out}_rest div {over})",
            f"_{out}_rem": f"_{out}_rest % {over}"},
        lambda out, a, by, over: {
            out: f"_{out}_whole + {_half_even(f'_{out}_rem', over, f'_{out}_whole % 2')}"}))


def multiply_divide_decimal(a: str, by: str, over: str) -> str:
    """SQL for ``a * by / over`` rounded half-even, as ``decimal(38,0)``, NULL on overflow.

    Exact for any ``a`` of 38 digits while ``by`` and ``over`` have at most 19 digits and
    ``over`` at least seven, so that the quotient fits the 32 integer digits Spark keeps.
    For rows that :func:`multiply_divide_long` cannot take.
    """
    whole = "decimal(38,0)"

    def quotient(x: str, y: str) -> str:
        return f"try_cast(try_divide(CAST({x} AS {whole}), {y}) AS {whole})"

    total = (f"try_cast(try_add(try_cast(try_multiply({quotient('a - part', 'o')}, m) AS {whole}), "
             f"{quotient('rest - rem', 'o')}) AS {whole})")
    up = f"CAST({_half_even('rem', 'o', 'total % 2BD')} AS decimal(1,0))"
    body = let("part", "a % o", let("rest", f"CAST(part * m AS {whole})", let(
        "rem", "rest % o", let("total", total, f"try_cast(try_add(total, {up}) AS {whole})"))))
    return let("a", f"CAST({a} AS {whole})", let("m", f"CAST({by} AS decimal(19,0))", let(
        "o", f"CAST({over} AS decimal(19,0))", body)))
