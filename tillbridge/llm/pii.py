"""Personal data: regular expressions propose, checksums confirm, context words weigh.

Column expressions only. Each kind's expression proposes spans; validators drop those that
fail (parts of an address above 255, Luhn for cards, modulo 97 for bank accounts, number of
digits for phones). A span's score starts at its kind's value and rises if a context word of
the kind stands near. Email, ip, card and phone spans are reported whatever their score; the
kinds ``iban`` and ``ssn`` from ``LEAST_SCORE`` on.

Null texts are empty. Spans count code points, ends exclusive. Every row is judged by itself;
ids may be null or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbridge.llm import spans

# The expressions of the four base kinds. Possessive repeats and the look-behind
# change no match; they keep long runs linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

LEAST_SCORE = 0.5
NEAR = 0.3
KINDS = {  # score without context, context words
    "email": (0.9, "mail|contact|reach|write"),
    "ip": (0.6, "ip|address|host|server|login"),
    "card": (0.7, "card|visa|credit|payment|konto|tarjeta"),
    "phone": (0.6, "phone|tel|call|mobile|fax"),
    "iban": (0.7, "iban|bank|account|konto"),
    "ssn": (0.3, "ssn|social security|tax"),
}


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes: from the right, every second digit counts double."""

    def add(total, place):
        digit = F.substring(number, -place, F.lit(1)).cast("int")
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(number)), F.lit(0), add) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number leaves 1: first four characters last, letters as 10 to 35."""
    moved = F.concat(F.substring(account, F.lit(5), F.char_length(account)), F.substring(account, F.lit(1), F.lit(4)))

    def add(rest, place):
        code = F.ascii(F.substring(moved, place, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(moved)), F.lit(0), add) == 1


def _between(low, high):
    return lambda m: F.char_length(digits(m)).between(low, high)


def _valid_card(match):
    return spans.let(digits(match), lambda d: F.when(F.char_length(d).between(16, 19), luhn(d)).otherwise(False))


RULES = {  # expression, validator, and what a text with a match contains
    "email": (EMAIL, None, "@"),
    "ip": (IP, lambda m: m.rlike(rf"^{PART}(\.{PART}){{3}}$"), "."),
    "card": (CARD, _valid_card, None),
    "phone": (PHONE, _between(8, 15), "+"),
    "iban": (IBAN, lambda m: mod_97(F.replace(m, F.lit(" "), F.lit(""))), None),
    "ssn": (SSN, lambda m: ~m.rlike("^(000|666|9)|-00-|-0000$"), "-"),
}
BASE = ("email", "ip", "card", "phone")


def kind_spans(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, score>> of one kind, confirmed."""
    pattern, valid, holds = RULES[kind]
    score, words = KINDS[kind]
    found = spans.find(text, pattern, None if holds is None else text.contains(holds))
    if valid is not None:
        found = F.filter(found, lambda s: valid(s["match"]))
    scored = F.transform(found, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.least(F.lit(1.0), F.lit(score) + F.when(s["context"].rlike(rf"\b(?:{words})"), NEAR).otherwise(0.0)).alias("score")))
    return scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= LEAST_SCORE)


def detect(docs: DataFrame, text: str = "text", prefix: str = "pii_") -> DataFrame:
    """docs with one column of spans per kind: array<struct<kind, start, end, score>>."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.withColumns({f"{prefix}{kind}": kind_spans(whole, kind) for kind in RULES})


def redact(text: Column, spans_: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans are merged
    under the kind of the first.
    """
    ordered = F.array_sort(F.transform(spans_, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def merge(done, s):
        last = F.element_at(done, -1)
        overlaps = (F.size(done) > 0) & (s["start"] < F.try_element_at(done, F.lit(-1))["end"])
        joined = F.struct(F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                          F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]).alias("end"),
                          F.try_element_at(done, F.lit(-1))["kind"].alias("kind"))
        return F.when(overlaps, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(
            F.concat(done, F.array(s)))

    empty = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,kind:string>>")

    def cut(merged):
        pieces = F.transform(merged, lambda s, i: F.concat(
            F.substring(text, F.when(i == 0, 0).otherwise(F.element_at(merged, F.greatest(i, F.lit(1)))["end"]) + 1,
                        s["start"] - F.when(i == 0, 0).otherwise(F.element_at(merged, F.greatest(i, F.lit(1)))["end"])),
            F.lit("["), F.upper(s["kind"]), F.lit("]")))
        tail = F.substring(text, F.element_at(merged, -1)["end"] + 1, F.char_length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    return F.when(F.size(spans_) > 0, spans.let(F.aggregate(ordered, empty, merge), cut)).otherwise(text)


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with personal data replaced in the text; all rows and columns stay."""
    prefix = "_pii_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    found = detect(docs, text, prefix)
    every = F.concat(*[F.col(f"{prefix}{kind}") for kind in RULES])
    return found.withColumn(text, redact(F.col(f"`{text}`"), every)).drop(*[f"{prefix}{kind}" for kind in RULES])


def report(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    found = detect(docs.select(id_column, text), text)
    listed = {kind: spans.labels(F.col(f"pii_{kind}")) for kind in RULES}
    return found.select(
        id_column, *[F.size(f"pii_{kind}").cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(spans.joined(F.concat(*[listed[k] for k in BASE])), 256).alias("base_sha256"),
        spans.joined(F.concat(*listed.values())).alias("spans"))
