"""Benchmark decontamination: complete seeds, then Smith-Waterman alignment.

Words are runs of letters and digits (lower-cased; other ASCII characters separate).
Where a text has a seed of a test item, the words around it are aligned locally with the item: a
match scores 2, a mismatch or a gap -1. The score is divided by that of the whole item; pairs at or
above ``THRESHOLD`` are contaminated. So are pairs with a passage, whatever the item's length: an
alignment of at least ``PASSAGE`` matching words, in which at most ``EDITS`` columns and at most a
fifth of them do not match (as in 20 words at an identity of 0.8). For a pair below the threshold the score is that of its best
alignment, and the words are those of its passage with the most matches.

The seeds leave out no such pair. If m of the n words of an item match and e columns do not, the
score 2 m - e reaches T only if the matches lie in at most 2 m - T + 1 runs, so at least T - m - 1
pairs of neighbouring words are unbroken. All word pairs of an item are seeds but its k most
frequent ones, counted in the training texts; an alignment that holds none of the seeds has at
least T - 1 - k matches, thus one of the n - T + 2 + k rarest single words, which are seeds too. Of
all k each item takes the one whose seeds occur least often. A passage holds four unbroken words,
so the rarer of any two consecutive runs of three, if both occur, is a seed as well. Seeds that
occur nowhere cost nothing and take no one's place. Windows are aligned only if the words they
share with the item can reach the score at all.

The benchmark goes to the tasks in blocks of at most ``BLOCK`` words, each with a pass of its
own. Null and empty texts match nothing, nor do items of fewer than ``GRAM`` words. Ids may be
null or repeated; each row and each item counts by itself. An item that a text holds several
times is reported once, where it aligns best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbridge.llm.common import mix, ngrams, slices, word_hashes

GRAM, WINDOW = 3, 3  # items of fewer than GRAM words match nothing
SIZES = (1, 2, 3)  # words in a seed
PASSAGE, EDITS = 16, 7
NEEDED = [max(4 * edits, PASSAGE) for edits in range(EDITS + 1)]  # matches of a passage
THRESHOLD = 0.5
BLOCK = 1 << 20
MATCH, MISS = 2, 1
_PASSAGE_SCORE = min(MATCH * matches - MISS * edits for edits, matches in enumerate(NEEDED))
_BITS = 22


class Grams:
    """Sorted n-gram hashes with a quick test for the many that are absent."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.unique(codes)
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.codes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the grams that are here, and their numbers."""
        if not len(self.codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.maybe[(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.codes, grams[at]), len(self.codes) - 1)
        hit = self.codes[number] == grams[at]
        return at[hit], number[hit]


class Items:
    """A block of test items: ids, words with offsets, and n-grams of each size."""

    def __init__(self, ids: list, texts: list):
        self.ids = ids
        self.words, self.offsets = word_hashes(
            pc.utf8_lower(pa.array([t or "" for t in texts], pa.large_string())), punctuation=False)
        self.parts = [ngrams(self.words, self.offsets, size) for size in SIZES]
        self.grams = np.concatenate([grams for grams, _ in self.parts])

    def seeds(self, codes: np.ndarray, counts: np.ndarray, threshold: float) -> "Seeds":
        """The seeds by the counts of n-grams, given in ascending order of their hashes."""
        numbers = [_counts(codes, counts, grams) for grams, _ in self.parts]
        gram, item, place = [], [], []
        for k in range(len(self.ids)):
            length = int(self.offsets[k + 1] - self.offsets[k])
            if length < GRAM:
                continue
            own = [n[ends[k]:ends[k + 1]] for n, (_, ends) in zip(numbers, self.parts)]
            for part, (grams, ends), places in zip(own, self.parts, _chosen(*own, _least(length, threshold), length >= PASSAGE)):
                places = places[part[places] > 0]
                gram.append(grams[ends[k] + places])
                item.append(np.full(len(places), k))
                place.append(places)
        return Seeds(self, *(np.concatenate([np.zeros(0, t), *x]) for x, t in ((gram, np.uint64), (item, np.int64), (place, np.int64))))


def _counts(codes, counts, grams):
    if not len(codes):
        return np.zeros(len(grams), np.int64)
    at = np.minimum(np.searchsorted(codes, grams), len(codes) - 1)
    return np.where(codes[at] == grams, counts[at], 0)


def _least(length, threshold: float):
    """The least score that reaches the threshold for an item of so many words."""
    return np.ceil(MATCH * length * threshold - 1e-9).astype(np.int64)


def _chosen(words: np.ndarray, pairs: np.ndarray, runs: np.ndarray, least: int, passages: bool):
    """Places of the words, of the word pairs and of the runs of three, given by counts, that are seeds of an item."""
    by_word, by_pair = np.argsort(words, kind="stable"), np.argsort(pairs, kind="stable")
    sums, all_pairs = (np.concatenate([[0], np.cumsum(c)]) for c in (words[by_word], pairs[by_pair]))
    left_out = np.arange(len(pairs) + 1)
    many = np.clip(len(words) - least + 2 + left_out, 0, len(words))
    k = int((sums[many] + all_pairs[::-1]).argmin())
    first = np.flatnonzero((runs[:-1] > 0) & (runs[1:] > 0)) if passages else np.zeros(0, np.int64)
    return (np.sort(by_word[:many[k]]), np.sort(by_pair[:len(pairs) - k]),
            np.unique(first + (runs[first + 1] < runs[first])) if len(first) else first)


class Seeds:
    def __init__(self, items: Items, gram, item, place):
        order = np.argsort(gram, kind="stable")
        self.items, self.grams = items, Grams(gram)
        self.item, self.place = item[order], place[order]
        self.first = np.append(np.searchsorted(gram[order], self.grams.codes), len(gram))

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, place in item) of every seed among the grams."""
        at, number = self.grams.find(grams)
        many = self.first[number + 1] - self.first[number]
        entry = np.repeat(self.first[number], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(at, many), self.item[entry], self.place[entry]


def align(rows: list[np.ndarray], columns: list[np.ndarray]):
    """Smith-Waterman of many pairs at once: score, first and last column of the best alignment.

    The low bits of a cell carry where its alignment began (earlier is larger), the rest its score.
    """
    pairs, height, width = len(rows), max(map(len, rows)), max(map(len, columns))
    first, second = np.zeros((pairs, height), np.uint64), np.zeros((pairs, width), np.uint64)
    tall, wide = np.zeros((pairs, height), bool), np.zeros((pairs, width), bool)
    for k, (r, c) in enumerate(zip(rows, columns)):
        first[k, :len(r)], tall[k, :len(r)] = r, True
        second[k, :len(c)], wide[k, :len(c)] = c, True
    one = 1 << 32
    begins = one - 1 - np.arange(width + 1, dtype=np.int64)
    slope = np.arange(width, dtype=np.int64) * MISS * one
    last = np.tile(begins[1:], (pairs, 1))
    best, end = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
    for i in range(height):
        same = (second == first[:, i:i + 1]) & wide & tall[:, i:i + 1]
        cell = np.empty_like(last)
        cell[:, 0] = begins[0]
        cell[:, 1:] = np.maximum(last[:, :-1], begins[1:-1])
        cell += np.where(same, MATCH * one, -MISS * one)
        np.maximum(cell, last - MISS * one, out=cell)
        np.maximum(cell, begins[1:], out=cell)
        cell = np.maximum.accumulate(cell + slope, axis=1) - slope
        top = cell.argmax(1)
        value = cell[np.arange(pairs), top]
        better = (value >> 32) > (best >> 32)
        best[better], end[better] = value[better], top[better]
        last = cell
    return best >> 32, one - 1 - (best & (one - 1)), end


def passages(rows: list[np.ndarray], columns: list[np.ndarray]):
    """Of many pairs at once: most matches of a passage (0 if there is none), its first and last column.

    One layer for each number of columns that do not match; cells are as in ``align``, with
    the matches in place of the score.
    """
    pairs, height, width = len(rows), max(map(len, rows)), max(map(len, columns))
    first, second = np.zeros((pairs, height), np.uint64), np.zeros((pairs, width), np.uint64)
    tall, wide = np.zeros((pairs, height), bool), np.zeros((pairs, width), bool)
    for k, (r, c) in enumerate(zip(rows, columns)):
        first[k, :len(r)], tall[k, :len(r)] = r, True
        second[k, :len(c)], wide[k, :len(c)] = c, True
    one, none = 1 << 32, -1 << 60
    begins = one - 1 - np.arange(width + 1, dtype=np.int64)
    layers = [np.full((pairs, width), none) for _ in NEEDED]
    best, end = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)

    def after(cells):
        return np.concatenate([np.full((pairs, 1), none), cells[:, :-1]], axis=1)

    for i in range(height):
        same = (second == first[:, i:i + 1]) & wide & tall[:, i:i + 1]
        before, fewer = None, None  # the layer with one miss less: at the row above, and at this one
        for edits, least in enumerate(NEEDED):
            last = layers[edits]
            match = after(last)
            if not edits:
                match = np.maximum(match, begins[:-1])
            match = np.where(same, match + one, none)
            cell = match
            if edits:
                cell = np.maximum(np.maximum(cell, after(before)), np.maximum(before, after(fewer)))
            top = match.argmax(1)
            value = match[np.arange(pairs), top]
            better = ((value >> 32) >= least) & ((value >> 32) > (best >> 32))
            best[better], end[better] = value[better], top[better]
            layers[edits], before, fewer = cell, last, cell
    return best >> 32, np.where(best > 0, one - 1 - (best & (one - 1)), 0), end


def reachable(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """No alignment of a pair scores more: words of the row that the column lacks cost at least a miss."""
    sizes = np.array([len(r) for r in rows])
    key = [mix(np.arange(1, len(rows) + 1, dtype=np.uint64))[np.repeat(np.arange(len(rows)), [len(x) for x in side])]
           + np.concatenate(side) for side in (rows, columns)]
    shared = np.isin(mix(key[0]), mix(key[1]))
    gain = np.zeros((len(rows), sizes.max() + 1), np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    gain[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1] = np.where(shared, MATCH, -MISS)
    total = np.cumsum(gain, axis=1)
    return (total - np.minimum.accumulate(total, axis=1)).max(1)


def matches_in(part: pa.Array, seeds: Seeds, threshold: float):
    """(text, item, score, first word, end word) of a slice of texts, sorted."""
    items = seeds.items
    words, offsets = word_hashes(part, punctuation=False)
    hits = []
    for size in SIZES:
        grams, ends = ngrams(words, offsets, size)
        at, item, place = seeds.hits(grams)
        text = np.searchsorted(ends, at, "right") - 1
        hits.append((text, at - ends[text], item, place))
    text, position, item, place = (np.concatenate(x) for x in zip(*hits))
    if not len(text):
        return []
    lengths = items.offsets[item + 1] - items.offsets[item]
    reach = np.ceil(MATCH * lengths * (1 - threshold)).astype(np.int64) + GRAM + EDITS  # more gaps would cost too much
    diagonal = position - place
    order = np.lexsort((diagonal, item, text))
    text, item, diagonal, reach, lengths = (x[order] for x in (text, item, diagonal, reach, lengths))
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > reach[1:])
    group = np.flatnonzero(new)
    final = np.append(group[1:], len(text)) - 1
    begin = np.maximum(diagonal[group] - reach[group], 0)
    stop = np.minimum(diagonal[final] + lengths[final] + reach[final], (offsets[1:] - offsets[:-1])[text[group]])
    found: dict[tuple, tuple] = {}
    by_width = np.lexsort((lengths[group], stop - begin))
    at = 0
    while at < len(by_width):
        width = int((stop - begin)[by_width[min(at + 255, len(by_width) - 1)]])
        take = by_width[at:at + max(1, min(256, (1 << 18) // max(1, width)))]
        at += len(take)
        rows = [items.words[items.offsets[item[group[g]]]:items.offsets[item[group[g]] + 1]] for g in take]
        columns = [words[offsets[text[group[g]]] + begin[g]:offsets[text[group[g]]] + stop[g]] for g in take]
        most, wanted = reachable(rows, columns), _least(lengths[group[take]], threshold)
        may = np.flatnonzero(most >= np.minimum(wanted, _PASSAGE_SCORE))
        if not len(may):
            continue
        take, rows, columns, wanted = take[may], [rows[k] for k in may], [columns[k] for k in may], wanted[may]
        score, left, right = align(rows, columns)
        held = score >= wanted
        short = np.flatnonzero(~held & (score >= _PASSAGE_SCORE))
        if len(short):
            many, left[short], right[short] = passages([rows[k] for k in short], [columns[k] for k in short])
            held[short] = many > 0
        for k in np.flatnonzero(held):
            g, share = take[k], float(score[k]) / (MATCH * len(rows[k]))
            key = (int(text[group[g]]), int(item[group[g]]))
            value = (share, -int(begin[g] + left[k]), -int(begin[g] + right[k] + 1))
            found[key] = max(found.get(key, (0.0, 0, 0)), value)
    return [(*key, share, -left, -right) for key, (share, left, right) in sorted(found.items())]


def _blocks(benchmark: DataFrame):
    """The benchmark as lists of ids and texts, as many words in each as a block may have."""
    ids, texts, words = [], [], 0
    for row in benchmark.toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        words += len(row[1] or "") // 2 + 1
        if words >= BLOCK:
            yield ids, texts
            ids, texts, words = [], [], 0
    if ids:
        yield ids, texts


def seeds_of(docs: DataFrame, text: str, items: Items, threshold: float = THRESHOLD) -> Seeds:
    """Seeds of the items, by a count of their n-grams over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(Grams(items.grams))

    def run(batches):
        grams = shared.value
        counts = np.zeros(len(grams.codes), np.int64)
        for batch in batches:
            for _, part in slices(batch.column(0), lower=True):
                words, offsets = word_hashes(part, punctuation=False)
                for size in SIZES:
                    _, number = grams.find(ngrams(words, offsets, size)[0])
                    counts += np.bincount(number, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams.codes[used].view(np.int64)), pa.array(counts[used])], ["gram", "n"])

    rows = (docs.select(F.col(text).cast("string")).mapInArrow(run, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).toArrow())  # no more rows than the block has n-grams
    codes, counts = rows.column("gram").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(codes)
    return items.seeds(codes[order], counts[order], threshold)


def matches(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Contaminated pairs: id, item_id, score (0 to 1), first_word and end_word of the passage."""
    schema = f"`{id_column}` long, item_id long, score double, first_word long, end_word long"
    frame = docs.select(F.col(id_column).cast("long"), F.col(text).cast("string").alias("text"))
    result = docs.sparkSession.createDataFrame([], schema)
    for ids, texts in _blocks(benchmark.select(F.col(item_id).cast("long"), F.col(item_text).cast("string"))):
        seeds = docs.sparkSession.sparkContext.broadcast(seeds_of(frame, "text", Items(ids, texts), threshold))

        def run(batches, seeds=seeds):
            names = seeds.value.items.ids
            for batch in batches:
                own = batch.column(0)
                for at, part in slices(batch.column(1), lower=True):
                    found = matches_in(part, seeds.value, threshold)
                    if found:
                        texts, items, scores, first, end = zip(*found)
                        yield pa.RecordBatch.from_arrays(
                            [own.take(pa.array([at + t for t in texts])), pa.array([names[i] for i in items], pa.int64()),
                             pa.array(scores, pa.float64()), pa.array(first, pa.int64()), pa.array(end, pa.int64())],
                            [id_column, "item_id", "score", "first_word", "end_word"])

        rows = frame.mapInArrow(run, schema)
        result = result.union(rows)
    return result


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
          item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that match no item, with all their columns."""
    for ids, texts in _blocks(benchmark.select(F.col(item_id).cast("long"), F.col(item_text).cast("string"))):
        seeds = docs.sparkSession.sparkContext.broadcast(seeds_of(docs, text, Items(ids, texts), threshold))

        def run(batches, seeds=seeds):
            for batch in batches:
                keep = np.ones(len(batch), bool)
                for at, part in slices(batch.column(text).cast(pa.string()), lower=True):
                    for found in matches_in(part, seeds.value, threshold):
                        keep[at + found[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
