"""Spans of regular expressions as column expressions, in code points.

Matches are marked by two private-use characters and the text is split there; prefix sums of
the parts' lengths give the positions. Patterns are Java regular expressions; every match is
found once, leftmost first and without overlaps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BEGIN, END, OTHER = "\ue000", "\ue001", "\ue002"
BLOCK = 64
CONTEXT = 40


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def starts(lengths: Column) -> Column:
    """Sums of all earlier lengths; by blocks, as appending to an array copies it."""

    def running(values, first):
        return F.aggregate(values, F.array(first), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))

    def of_blocks(blocks):
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
        return let(running(sums, F.lit(0)), lambda bases: F.flatten(F.transform(
            blocks, lambda b, j: F.slice(running(b, F.element_at(bases, j + 1)), 1, F.size(b)))))

    numbers = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    return let(F.transform(numbers, lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK)), of_blocks)


def find(text: Column, pattern: str, where: Column | None = None) -> Column:
    """array<struct<start, end, match, context>>; where tells which texts can have a match.

    The context is what stands up to ``CONTEXT`` characters before and after the match, in
    lower case.
    """
    plain = F.when(text.contains(BEGIN) | text.contains(END),
                   F.translate(text, BEGIN + END, OTHER + OTHER)).otherwise(text)
    parts = F.split(F.regexp_replace(plain, F.lit(pattern), F.lit(f"{BEGIN}$0{END}")), BEGIN)

    def of_parts(p):
        lengths = F.transform(p, lambda x, i: F.char_length(x) - F.when(i > 0, 1).otherwise(0))
        return let(starts(lengths), lambda at: F.transform(
            F.slice(p, 2, F.size(p)), lambda x, i: let(F.substring_index(x, END, 1), lambda m: F.struct(
                F.element_at(at, i + 2).alias("start"), (F.element_at(at, i + 2) + F.char_length(m)).alias("end"),
                m.alias("match"),
                F.lower(F.concat_ws(" ", F.right(F.element_at(p, i + 1), F.lit(CONTEXT)),
                                    F.left(F.substring_index(x, END, -1), F.lit(CONTEXT)))).alias("context")))))

    empty = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,match:string,context:string>>")
    found = let(parts, lambda p: F.when(F.size(p) > 1, of_parts(p)).otherwise(empty))
    return found if where is None else F.when(where, found).otherwise(empty)


def labels(spans: Column, kind: str | None = None) -> Column:
    """kind:start:end of each span; the kind is the span's own field if not given."""
    return F.transform(spans, lambda s: F.concat_ws(
        ":", F.lit(kind) if kind else s["kind"], s["start"].cast("string"), s["end"].cast("string")))


def joined(parts: Column) -> Column:
    return F.array_join(parts, ",")
