"""Near duplicates by ProbMinHash: weighted word shingles, banding, exact verification.

A text's elements are its shingles of five words (lower-cased, separated by white space; texts of fewer words have
one shingle), weighted by their number of occurrences. Every element is a Poisson process
whose rate is its weight; its arrivals fall on random components of the signature, and a
component keeps the element that arrives first. An element is followed no further than the
latest component's first arrival, which is where all later arrivals are too late. Two texts
agree in a component with the probability Jaccard of their weights.

Texts that agree in all rows of a band share a bucket. Each text has a second signature with all
weights 1 and bands of its own, so both measures that define a link generate candidates; for a text
without a repeated shingle the two are the same. Candidates are verified exactly: a
pair is linked if its probability Jaccard, or the Jaccard of its sets of shingles, is at
least the threshold. Classes are the connected components of links.

Pairs of a large bucket are not listed. A few members of each bucket, its centres, are verified
against the others. Where a larger bucket still holds several classes, its texts are looked at
by shingle: ordered by rarity, a text whose unshared shingles carry a share u of its weight can
be linked to one with share v only if (1 - u)(1 - v) >= t (1 - uv), for either measure; so two
texts can only be linked if they share one of their first shingles, at places that satisfy
this. Common shingles are bounded further by hash group: in each there are no more than the fewer
of the two texts' shared ones. Texts that share such a shingle are verified against more and more centres, those with
the fewest unshared shingles first, until each group is of one class or all of it has been
centre. No link between classes is missed.

Equal texts are collapsed beforehand. A null text counts as the empty one. Texts without a
word are alike only if equal. Ids may be null or repeated; of rows that are equal in id and
text one is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbridge.llm.common import Scratch, mix, ngrams, slices, word_hashes
from tillbridge.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
FEW = 4  # centres of each bucket at first
GROUPS = 64  # hash groups by which common shingles are bounded
_MOST = 32_000
LAST = 8  # shingles before a shared one that tell whether a pair was met earlier
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(words, offsets, size: int = WORDS):
    """Distinct shingles of each text in ascending order, their counts, and offsets."""
    grams, ends = ngrams(words, offsets, size)
    lengths = np.diff(offsets)
    codes, counts = [], []
    for k, length in enumerate(lengths):
        if length >= size:
            own = np.sort(grams[ends[k]:ends[k + 1]])
            new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            codes.append(own[new])
            counts.append(np.diff(np.append(new, len(own))))
        elif length:
            whole = words[offsets[k]:offsets[k + 1]]
            codes.append(mix(np.array([np.bitwise_xor.reduce(mix(whole + np.arange(length, dtype=np.uint64) * _STEP))])))
            counts.append(np.ones(1, np.int64))
        else:
            codes.append(np.zeros(0, np.uint64))
            counts.append(np.zeros(0, np.int64))
    sizes = np.array([len(c) for c in codes])
    return np.concatenate(codes), np.concatenate(counts), np.concatenate([[0], np.cumsum(sizes)])


def signatures(codes, counts, offsets, size: int) -> np.ndarray:
    """ProbMinHash: for each text and component the element that arrives there first (0: no element)."""
    texts = len(offsets) - 1
    first = np.full(texts * size, np.inf)
    element = np.zeros(texts * size, np.uint64)
    text = np.repeat(np.arange(texts), np.diff(offsets))
    code, weight = codes, counts.astype(float)
    clock, arrivals = np.zeros(len(codes)), 0
    while len(code):
        many = max(1, min(64, 4096 // len(code)))
        numbers = np.arange(arrivals + 1, arrivals + many + 1, dtype=np.uint64) * _STEP
        bits = mix(code[:, None] + numbers)
        gaps = -np.log(((bits >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / weight[:, None]
        times = clock[:, None] + np.cumsum(gaps, 1)
        slots = text[:, None] * size + ((bits & np.uint64(2047)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, slots.ravel(), times.ravel())
        won = times <= first[slots]
        element[slots[won]] = np.broadcast_to(code[:, None], won.shape)[won]
        clock, arrivals = times[:, -1], arrivals + many
        goes_on = clock < first.reshape(texts, size).max(1)[text]
        text, code, weight, clock = text[goes_on], code[goes_on], weight[goes_on], clock[goes_on]
    return element.reshape(texts, size)


def both_bands(codes, counts, offsets, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct band keys of each text, by its weights and by weights of 1, and their offsets."""
    held = np.diff(offsets) > 0
    keys = band_keys(signatures(codes, counts, offsets, bands * rows), bands, rows)
    text = np.repeat(np.arange(len(held)), np.diff(offsets))
    again = np.zeros(len(held), bool)
    again[text[counts > 1]] = True
    plain = keys.copy()
    if again.any():
        own, sizes = again[text], np.diff(offsets)[again]
        plain[again] = band_keys(signatures(codes[own], np.ones(int(own.sum()), np.int64),
                                            np.concatenate([[0], np.cumsum(sizes)]), bands * rows), bands, rows)
    every = np.stack([keys, plain], 2).reshape(len(held), -1)
    first = np.tile([True, False], bands) | (every != np.repeat(keys, 2, axis=1))
    first &= held[:, None]
    return every[first], np.concatenate([[0], np.cumsum(first.sum(1))])


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signature), bands)).copy()
    parts = signature.reshape(len(signature), bands, rows)
    for r in range(rows):
        keys = mix(keys + parts[:, :, r])
    return keys.view(np.int64)


def _sign(bands, rows, words):
    def run(batches):
        for batch in batches:
            for at, part in slices(batch.column("text"), lower=True):
                codes, counts, offsets = shingles(*word_hashes(part), words)
                keys, ends = both_bands(codes, counts, offsets, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, len(part)), batch.column("digest").slice(at, len(part)),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(keys))],
                    ["id", "digest", "bands"])

    return run


def _sets(words):
    def run(batches):
        for batch in batches:
            for at, part in slices(batch.column("text"), lower=True):
                codes, counts, offsets = shingles(*word_hashes(part), words)
                counts = counts.astype(np.int32)
                pairs = list(zip(offsets[:-1], offsets[1:]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(at, len(part)),
                     pa.array([codes[a:b].tobytes() for a, b in pairs], pa.binary()),
                     pa.array([counts[a:b].tobytes() for a, b in pairs], pa.binary())], ["node", "codes", "counts"])

    return run


def similarities(codes_a, counts_a, codes_b, counts_b) -> tuple[float, float]:
    """Probability Jaccard of the weights, and Jaccard of the sets."""
    both, at, bt = np.intersect1d(codes_a, codes_b, True, return_indices=True)
    if not len(both):
        return 0.0, 0.0
    a, b = counts_a[at].astype(float), counts_b[bt].astype(float)
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    ratio = a / b
    group = np.searchsorted(ratio, ratio, "left")  # equal ratios count on one side
    below = np.concatenate([[0], np.cumsum(b)])[group] + counts_b.sum() - b.sum()
    above = a.sum() - np.concatenate([[0], np.cumsum(a)])[group] + counts_a.sum() - a.sum()
    return float((1 / (above / a + below / b)).sum()), len(both) / (len(codes_a) + len(codes_b) - len(both))


def _verify(threshold):
    def run(batches):
        for batch in batches:
            found = []
            for ca, na, cb, nb in zip(*(batch.column(c) for c in ("codes_a", "counts_a", "codes_b", "counts_b"))):
                found.append(max(similarities(
                    np.frombuffer(ca.as_buffer(), np.uint64), np.frombuffer(na.as_buffer(), np.int32),
                    np.frombuffer(cb.as_buffer(), np.uint64), np.frombuffer(nb.as_buffer(), np.int32))) >= threshold)
            keep = pa.array(found, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("la").filter(keep), batch.column("lb").filter(keep)], ["a", "b"])

    return run


def _digest(text: str):
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))


def classes(docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
            bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """One row per row of docs: id, digest (of its text), class_id (least id of its class).

    ``class_digest`` is the digest of the text that stands for the class: of those with the
    class id, or of all if no id is known, the least one.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    source = docs.select(F.col(id_column).cast("long").alias("id"),
                         F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), _digest(text).alias("digest"))
    signed = scratch.keep(source.mapInArrow(_sign(bands, rows, words), "id long, digest string, bands array<long>"), "signed")
    nodes = scratch.keep(signed.groupBy("digest").agg(F.min("id").alias("id"), F.any_value("bands").alias("bands"))
                         .withColumn("node", F.monotonically_increasing_id()), "nodes")
    banded = nodes.select(F.explode("bands").alias("key"), "node")
    shared = banded.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    buckets = scratch.keep(banded.join(shared, "key"), "buckets")

    involved = buckets.select("node").distinct().join(nodes.select("node", "digest"), "node").hint("shuffle_hash")
    texts = source.join(involved, "digest").select("node", "text")
    sets = scratch.keep(texts.mapInArrow(_sets(words), "node long, codes binary, counts binary")
                        .groupBy("node").agg(F.any_value("codes").alias("codes"), F.any_value("counts").alias("counts")), "sets")

    search = _Links(scratch, sets, threshold)
    search.round(buckets, [F.xxhash64("node"), F.col("node")], F.lit(True), 0, FEW)
    large = search.mixed(buckets, FEW)
    if not large.isEmpty():
        shared = scratch.keep(_first_shingles(sets.join(large.select("node").distinct(), "node"), threshold), "shingles")
        centres, before = 1, 0
        while search.round(shared, [F.col("u"), F.xxhash64("node"), F.col("node")], _close(threshold), before, centres):
            before, centres = centres, centres * 16
        scratch.drop(shared)
    labels = search.labels
    scratch.drop(large)
    classed = nodes.drop("bands")
    classed = classed.withColumn("root", F.col("node")) if labels is None else (
        classed.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")))
    best = classed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "digest")).alias("best"))
    of_text = classed.join(best, "root").select(
        "digest", F.col("best.id").alias("class_id"), F.col("best.digest").alias("class_digest"))
    result = scratch.keep(signed.select("id", "digest").join(of_text, "digest"), "classes")
    scratch.drop(*[f for f in (signed, nodes, buckets, sets, labels) if f is not None])
    return result.withColumnRenamed("id", id_column)


def _first_shingles(sets: DataFrame, threshold: float) -> DataFrame:
    """(key, node, u, v, members, last): shingles that several texts share, among each text's first.

    Shingles are ordered by the number of texts that have them; u is the share of a text's
    weight that stands before, v the same with equal weights. ``last`` has the shared
    shingles just before: two texts that agree in one of them meet there already.
    """

    def run(batches):
        for batch in batches:
            codes = [np.frombuffer(c.as_buffer(), np.int64) for c in batch.column("codes")]
            counts = [np.frombuffer(c.as_buffer(), np.int32) for c in batch.column("counts")]
            if codes:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(codes)), pa.array(np.repeat(batch.column("node").to_numpy(), [len(c) for c in codes])),
                    pa.array(np.concatenate([c / c.sum() for c in counts])),
                    pa.array(np.concatenate([np.full(len(c), 1 / len(c)) for c in counts]))], ["key", "node", "weight", "one"])

    rows = sets.mapInArrow(run, "key long, node long, weight double, one double")
    members = rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    every = Window.partitionBy("node")
    earlier = every.orderBy("members", "key").rowsBetween(Window.unboundedPreceding, -1)

    def before(c):
        return 1 - F.sum(c).over(every) + F.coalesce(F.sum(c).over(earlier), F.lit(0.0))

    last = F.collect_list("key").over(every.orderBy("members", "key").rowsBetween(-LAST, -1))
    shared = rows.join(members, "key")
    placed = shared.select(
        "key", "node", "members", before("weight").alias("u"), before("one").alias("v"), last.alias("last"))
    profile = shared.groupBy("node").agg(F.collect_list("key").alias("keys"), F.collect_list("weight").alias("weights")).join(
        sets.select("node", "counts"), "node").mapInArrow(
        _profiles, "node long, size int, having array<smallint>, mass array<float>")
    return placed.where(F.least("u", "v") <= 1 - threshold + 1e-9).join(profile, "node")


def _profiles(batches):
    """Number of shingles of a text; how many of the shared ones each hash group has; and if any is repeated,
    the groups' shares of the weight."""
    for batch in batches:
        out = []
        for keys, weights, counts in zip(*(batch.column(c) for c in ("keys", "weights", "counts"))):
            group = keys.values.to_numpy() % GROUPS
            own, having = np.frombuffer(counts.as_buffer(), np.int32), np.bincount(group, minlength=GROUPS)
            if having.max() > _MOST:  # bounds nothing, so the other text does
                having[:] = _MOST
            out.append((len(own), having.tolist(), None if (own == 1).all() else np.bincount(
                group, weights.values.to_numpy(), GROUPS).tolist()))
        columns = list(zip(*out)) or [[]] * 3
        kinds = (pa.int32(), pa.list_(pa.int16()), pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["node", "size", "having", "mass"])


def _close(threshold: float):
    """Whether texts that meet at a shingle can be linked and do not meet earlier.

    Their common shingles are at most, in each hash group, the fewer of the two. Of sets that bounds the
    Jaccard; where no shingle is repeated the probability Jaccard is the same, and otherwise it is
    at most the common mass, as no coupling of two distributions agrees more often.
    """

    def may(a, b):
        return (1 - F.col(a)) * (1 - F.col(b)) >= threshold * (1 - F.col(a) * F.col(b)) - 1e-9

    def common(one, other):
        return f"aggregate(zip_with({one}, {other}, (x, y) -> least(x, y)), 0D, (s, x) -> s + x)"

    def mass(side):
        return f"coalesce({side}mass, transform({side}having, x -> CAST(x / {side}size AS FLOAT)))"

    sets = F.expr(f"{common('having', 'centre_having')} * {1 + threshold} >= {threshold} * (size + centre_size) - 1e-6")
    weights = F.expr("(mass IS NOT NULL OR centre_mass IS NOT NULL)"
                     f" AND {common(mass(''), mass('centre_'))} >= {threshold} - 1e-4")
    return (may("u", "centre_u") | may("v", "centre_v")) & ~F.arrays_overlap("last", "centre_last") & (sets | weights)


class _Links:
    """Classes of nodes so far, and the pairs that were verified."""

    def __init__(self, scratch: Scratch, sets: DataFrame, threshold: float):
        self.scratch, self.sets, self.threshold = scratch, sets, threshold
        self.labels = self.checked = None  # (node, root) of nodes that are not their own root; (a, b)

    def labelled(self, buckets: DataFrame) -> DataFrame:
        if self.labels is None:
            return buckets.withColumn("label", F.col("node"))
        return buckets.join(self.labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")

    def mixed(self, buckets: DataFrame, before: int) -> DataFrame:
        """The buckets of several classes whose pairs were not all verified with ``before`` centres."""
        members = self.labelled(buckets.where(F.col("members") > before + 1))
        keys = (members.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"))
                .where("least < most").select("key"))
        return self.scratch.keep(members.join(keys, "key"), "mixed")

    def round(self, buckets: DataFrame, order: list, close, before: int, centres: int) -> bool:
        """Verify the next centres against the members of other classes; whether there was anything to do."""
        live = self.mixed(buckets, before)
        if live.isEmpty():
            return False
        place = F.row_number().over(Window.partitionBy("key").orderBy(*order))
        chosen = live.withColumn("place", place).where(F.col("place") <= centres).drop("place", "members")
        chosen = chosen.select(*[F.col(c).alias(c if c == "key" else f"centre_{c}") for c in chosen.columns])
        first = F.col("node") < F.col("centre_node")
        pairs = (live.join(chosen, (live["key"] == chosen["key"]) & (F.col("label") != F.col("centre_label")) & close)
                 .select(F.least("node", "centre_node").alias("a"), F.greatest("node", "centre_node").alias("b"),
                         F.when(first, F.col("label")).otherwise(F.col("centre_label")).alias("la"),
                         F.when(first, F.col("centre_label")).otherwise(F.col("label")).alias("lb")).distinct())
        if self.checked is not None:
            pairs = pairs.join(self.checked, ["a", "b"], "left_anti")
        pairs = self.scratch.keep(pairs, "pairs")
        done = pairs.select("a", "b")
        self.checked = done if self.checked is None else self.checked.union(done)

        def side(s):
            return self.sets.select(F.col("node").alias(s), F.col("codes").alias(f"codes_{s}"), F.col("counts").alias(f"counts_{s}"))

        links = (pairs.join(side("a"), "a").join(side("b"), "b")
                 .select("la", "lb", "codes_a", "counts_a", "codes_b", "counts_b")
                 .mapInArrow(_verify(self.threshold), "a long, b long"))
        joined = components(links, self.scratch)  # of labels
        if self.labels is None:
            new = joined
        else:
            moved = self.labels.join(joined.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
            new = moved.select("node", F.coalesce("to", "root").alias("root")).union(
                joined.join(self.labels, "node", "left_anti"))
        kept = self.scratch.keep(new, "labels")
        self.scratch.drop(live, joined, *([self.labels] if self.labels is not None else []))
        self.labels = kept
        return True


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs that stand for their class, one for each class."""
    found = classes(docs, id_column, text, **options)
    first = (found.where(F.col("digest") == F.col("class_digest"))
             .where(F.col(id_column).eqNullSafe(F.col("class_id")))
             .select(F.concat_ws(":", "digest", id_column).alias("_key")).distinct())
    rows = (docs.groupBy(F.concat_ws(":", _digest(text), F.col(id_column).cast("long")).alias("_key"))
            .agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row")))
    return rows.join(first, "_key", "left_semi").select("_row.*")
