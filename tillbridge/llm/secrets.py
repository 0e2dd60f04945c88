"""Secret scan with a trigram index.

Boolean trigram queries are derived from the rules' expressions. An inverted index lists, for
each trigram that a query names, the texts that contain it; intersecting its postings gives
each rule's candidates, which the expression then verifies. A rule without a mandatory trigram
scans all texts. The index is a table in the shared folder; equal texts share their postings.

Column expressions only. Null texts are empty. Spans count code points, ends exclusive. Every
row is judged by itself; ids may be null or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbridge.llm import spans, trigrams
from tillbridge.llm.common import Scratch

# The expressions of the base kinds. A possessive repeat changes no match.
ASSIGN_NAME = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = {  # in the order that breaks ties
    "assign": ASSIGN_NAME + r"[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "github": r"\bgh[oprsu]_[A-Za-z0-9]{36,}+",
    "slack": r"\bxox[abprs]-[A-Za-z0-9-]{10,}+",
    "google": r"\bAIza[A-Za-z0-9_-]{35}",
    "stripe": r"\b[rs]k_live_[A-Za-z0-9]{16,}+",
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY[A-Z ]*-----",
    "webtoken": r"\beyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+",
}
BASE = ("assign", "access", "hex")
LEAST = {  # what a match must hold besides
    "assign": lambda m: F.char_length(F.regexp_replace(m, "^" + ASSIGN_NAME, "")) >= 6,
    "access": lambda m: F.char_length(m) >= 20,
}


def rule_spans(text: Column, rule: str, where: Column | None) -> Column:
    """array<struct<start, number, end, kind>> of a rule."""
    found = spans.find(text, RULES[rule], where)
    if rule in LEAST:
        found = F.filter(found, lambda s: LEAST[rule](s["match"]))
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(list(RULES).index(rule)).alias("number"), s["end"].alias("end"), F.lit(rule).alias("kind")))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and one column of spans per rule."""
    source = docs.select(F.col(id_column), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("key", F.xxhash64("text"))  # a shared key only adds candidates
    queries = {rule: found for rule, pattern in RULES.items() if (found := trigrams.query(pattern))}
    grams = sorted({g for clauses in queries.values() for sets in clauses for s in sets for g in s})
    index = Scratch(docs.sparkSession, "secrets").keep(trigrams.postings(source, grams), "postings")
    possible = trigrams.candidates(index, queries).hint("shuffle_hash")
    rows = source.join(possible, "key", "left")
    return rows.select(F.col(id_column), *[
        rule_spans(F.col("text"), rule, F.coalesce(F.array_contains("rules", rule), F.lit(False)) if rule in queries else None)
        .alias(f"secret_{rule}") for rule in RULES])


def report(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans, by start and kind."""
    found = scan(docs, id_column, text)

    def listed(rules):
        return spans.joined(spans.labels(F.array_sort(F.concat(*[F.col(f"secret_{r}") for r in rules]))))

    return found.select(id_column, *[F.size(f"secret_{r}").cast("long").alias(f"n_{r}") for r in BASE],
                        F.sha2(listed(BASE), 256).alias("base_sha256"), listed(RULES).alias("spans"))
