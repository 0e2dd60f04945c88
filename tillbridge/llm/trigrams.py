"""Boolean trigram queries of regular expressions, and the inverted index that answers them.

A query is a conjunction of clauses; a clause is a disjunction of sets of trigrams; every text
with a match has, for each clause, all trigrams of at least one set. It is derived from the
parts of an expression that can only be one of a few strings. Without such a part of three or
more characters the query is empty, which all texts satisfy.
"""

from __future__ import annotations

from re import _constants as kind
from re import _parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_STRINGS = 64


def _exact(items) -> set[str] | None:
    """All strings the items can match, or None if there are too many."""
    found = {""}
    for op, value in items:
        if op is kind.LITERAL:
            part = {chr(value).lower()}
        elif op is kind.IN:
            part = {chr(c).lower() for o, c in value if o is kind.LITERAL}
            if any(o is not kind.LITERAL for o, _ in value):
                return None
        elif op is kind.BRANCH:
            branches = [_exact(b) for b in value[1]]
            if any(b is None for b in branches):
                return None
            part = set().union(*branches)
        elif op is kind.SUBPATTERN:
            part = _exact(value[3])
        elif op in (kind.MAX_REPEAT, kind.POSSESSIVE_REPEAT) and value[:2] == (0, 1):
            part = _exact(value[2])
            part = part and part | {""}
        elif op in (kind.MAX_REPEAT, kind.POSSESSIVE_REPEAT) and value[0] == value[1] and value[0] <= 8:
            part = _exact(list(value[2]) * value[0])
        else:
            return None
        if part is None or len(part) * len(found) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def _clauses(items) -> list[set[str]]:
    """Sets of strings, one of each being part of any match."""
    found, run = [], []

    def close():
        if run:
            found.append(_exact(run))
            run.clear()

    for item in items:
        op, value = item
        if _exact([*run, item]) is not None:
            run.append(item)
            continue
        close()
        if _exact([item]) is not None:
            run.append(item)
        elif op is kind.SUBPATTERN:
            found += _clauses(value[3])
        elif op in (kind.MAX_REPEAT, kind.POSSESSIVE_REPEAT) and value[0] >= 1:
            found += _clauses(value[2])
    close()
    return found


def query(pattern: str) -> list[list[frozenset[str]]]:
    """The clauses of an expression; trigrams are lower-case ASCII."""
    clauses = []
    for strings in _clauses(_parser.parse(pattern)):
        sets = {frozenset(s[k:k + 3] for k in range(len(s) - 2) if s[k:k + 3].isascii()) for s in strings}
        if frozenset() not in sets:  # a set that holds another says no more than it
            clauses.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))
    return clauses


def postings(texts: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, key) of the given trigrams, from columns key and text."""
    wanted = F.array(*[F.lit(g) for g in grams])
    lowered = F.element_at(F.transform(
        F.array(F.lower("text")), lambda low: F.filter(wanted, lambda g: F.contains(low, g))), 1)
    return texts.select("key", F.explode(lowered).alias("gram")).distinct()


def candidates(index: DataFrame, queries: dict[str, list[list[frozenset[str]]]]) -> DataFrame:
    """(key, rules): the rules each text may match, by intersecting the postings."""
    rows = [(gram, rule, c, s, len(grams), len(clauses))
            for rule, clauses in queries.items() for c, sets in enumerate(clauses)
            for s, grams in enumerate(sets) for gram in grams]
    terms = index.sparkSession.createDataFrame(
        rows, "gram string, rule string, clause int, choice int, grams int, clauses int")
    return (index.join(F.broadcast(terms), "gram")  # as many rows as the rules have trigrams
            .groupBy("key", "rule", "clause", "choice", "grams", "clauses").agg(F.count("*").alias("n")).where("n = grams")
            .groupBy("key", "rule", "clauses").agg(F.count_distinct("clause").alias("n")).where("n = clauses")
            .groupBy("key").agg(F.collect_set("rule").alias("rules")))
