"""Interaction of document filters: what every order of five filters removes at every step.

Whether a text fails a filter does not depend on the filters before it, so all a document
contributes is the set of filters it fails, its mask. Under an order a document goes at the first
filter of its mask. Written in lexicographic order, orders have ranks 0 to 119 (Lehmer
codes), and those with a common beginning are an interval of ranks. A mask is removed at step s by
exactly the orders that begin with s - 1 filters outside it and one inside it: a union of such
intervals. Documents are counted once for each part and mask; each interval adds the count where
it begins and takes it back where it ends, and a running sum over the ranks turns these
differences into the documents removed by each order at each step.

Defined results: a null text is the empty text (no words; it fails A only, or E as well), a null
language is the part ``''``. Equal texts are compared table-wide by SHA-256. A null id is neither
smaller nor larger than another, so such a document passes E and makes none fail it. Rows that
are repeated with one id do not fail E through each other. Several labels of one id count as one
that is good if any says so, toxic if any says so; labels without an id belong to nothing. An
empty table has no parts and gives no rows. Texts are read whole, one at a time; other columns of
the documents are ignored. Nothing larger than a row for each part and mask is ever in one group.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbridge.llm.common import Scratch

FILTERS = "ABCDE"
_BIT = {name: 1 << k for k, name in enumerate(FILTERS)}


def lehmer_rank(order: str) -> int:
    """Place of an order among all orders of its letters, by its Lehmer code."""
    return sum(
        sum(later < letter for later in order[k + 1:]) * factorial(len(order) - k - 1)
        for k, letter in enumerate(order))


def intervals(mask: int) -> list[tuple[int, int, int]]:
    """(step, first rank, rank behind the last) of the orders that remove a mask at a step."""
    outside = [f for f in FILTERS if not mask & _BIT[f]]
    inside = [f for f in FILTERS if mask & _BIT[f]]
    found = []
    for step in range(1, len(FILTERS) + 1):
        width = factorial(len(FILTERS) - step)
        for before in permutations(outside, step - 1):
            for name in inside:
                beginning = "".join(before) + name
                rest = "".join(f for f in FILTERS if f not in beginning)
                first = lehmer_rank(beginning + rest)
                found.append((step, first, first + width))
    merged = []
    for step, first, end in sorted(found):
        if merged and merged[-1][0] == step and merged[-1][2] == first:
            merged[-1] = (step, merged[-1][1], end)
        else:
            merged.append((step, first, end))
    return merged


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``digest`` of the text, and the bits of A to D it fails."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    measured = texts.select(
        "doc_id", "part", F.sha2("text", 256).alias("digest"), F.size(words).alias("words"),
        F.size(F.array_distinct(words)).alias("distinct"), F.char_length("text").alias("points"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("capitals"), F.col("text").rlike("[#$%&*|]").alias("marked"))
    return measured.selectExpr(
        "doc_id", "part", "digest",
        f"IF(words < 200, {_BIT['A']}, 0) + IF(100L * distinct < 50L * words, {_BIT['B']}, 0)"
        f" + IF(100L * capitals > 3L * points, {_BIT['C']}, 0) + IF(marked, {_BIT['D']}, 0) AS mask")


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of one text, id, part and label, counted: ``digest``, ``doc_id``, ``part``, ``mask`` of
    A to D, ``good``, ``toxic``, ``n``."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    ).withColumn("at", F.col("doc_id"))
    # A row without an id matches no label; its digest keeps such rows from meeting in one task.
    rows = failures(docs).withColumn("at", F.coalesce("doc_id", F.xxhash64("digest")))
    kind = ["digest", rows.doc_id, "part", "mask", F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic")]
    judged = rows.join(known, (rows.at == known.at) & (rows.doc_id == known.doc_id), "left").select(*kind)
    return judged.groupBy(*judged.columns).agg(F.count("*").alias("n"))


def mask_counts(rows: DataFrame) -> DataFrame:
    """``part``, ``mask`` of A to E, and how many documents, good and toxic ones have it.

    A text's least id comes from a count that combines before the shuffle; rows look it up by text
    and id together, so that the copies of a text do not meet in one task.
    """
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marked = rows.join(first, ["digest", "doc_id"], "left").withColumn(
        "mask", F.expr(f"mask + IF(is_first OR doc_id IS NULL, 0, {_BIT['E']})"))
    return marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.expr("IF(good, n, 0L)")).alias("good"),
        F.sum(F.expr("IF(toxic, n, 0L)")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters, and step; see the module for its columns.

    ``kept`` after the step; ``removed``, ``good_lost`` and ``toxic_lost`` at it; ``redundant``
    documents fail the step's filter but went earlier; ``unique_fails`` fail no other filter;
    ``shapley`` is what the filter removes, summed over all orders.
    """
    spark = docs.sparkSession
    orders = ["".join(o) for o in permutations(FILTERS)]
    ends = spark.createDataFrame(  # at most 31 masks with a few hundred ends each
        [(mask, step, rank, sign) for mask in range(1, 1 << len(FILTERS))
         for step, first, end in intervals(mask) for rank, sign in ((first, 1), (end, -1))],
        "mask int, step int, rank int, sign int")
    places = spark.createDataFrame(
        [(rank, order, step + 1, name) for rank, order in enumerate(orders) for step, name in enumerate(order)],
        "rank int, filter_order string, step int, filter string")
    scratch = Scratch(spark, "audit")
    rows = scratch.keep(labelled(docs, labels), "rows")
    masks = scratch.keep(mask_counts(rows), "masks")
    scratch.drop(rows)
    sums = ["n", "good", "toxic"]
    changes = masks.join(F.broadcast(ends), "mask").select(
        "part", "step", "rank", *[(F.col(c) * F.col("sign")).alias(c) for c in sums])
    totals = masks.groupBy("part").agg(
        F.sum("n").alias("total"),
        *[F.sum(F.expr(f"IF(mask & {bit} > 0, n, 0L)")).alias(f"fails_{f}") for f, bit in _BIT.items()],
        *[F.sum(F.expr(f"IF(mask = {bit}, n, 0L)")).alias(f"only_{f}") for f, bit in _BIT.items()])
    blank = totals.select("part", F.expr("explode(sequence(0, 119)) AS rank")).select(
        "part", F.expr("explode(sequence(1, 5)) AS step"), "rank", *[F.lit(0).cast("long").alias(c) for c in sums])
    differences = changes.unionByName(blank).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in sums])
    along = Window.partitionBy("part", "step").orderBy("rank")
    removed = differences.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in sums])
    by_step = removed.join(F.broadcast(places), ["rank", "step"])  # the rank behind the last has no order
    down = Window.partitionBy("part", "rank").orderBy("step")
    same = Window.partitionBy("part", "filter")
    summed = by_step.withColumns({"gone": F.sum("n").over(down), "shapley": F.sum("n").over(same)})

    def of_filter(prefix: str):
        return F.coalesce(*[F.when(F.col("filter") == f, F.col(f"{prefix}_{f}")) for f in FILTERS])

    return summed.join(totals, "part").select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
        (of_filter("fails") - F.col("n")).alias("redundant"), of_filter("only").alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
