"""Repeated passages of 100 bytes or more, found by sorting suffixes.

A text is its UTF-8 bytes. A window, the 100 bytes that start at some byte, repeats if the same 100
bytes also start earlier: in a document of smaller id, or before it in its own. Every byte of a
window that repeats is removed. Windows are judged on the input and never cross documents.

Not every suffix can be sent to be sorted. Each window has an anchor, the 32-byte string in it
with the least hash (by its upper half; the first of equal ones), so equal windows have equal anchors at equal places.
One anchor serves some 30 windows in a row; with the bytes they span these are a context. An anchor
whose hash occurs once in the corpus has no window that repeats, and its context is never made:
documents first send hashes alone, and get those back that occur again. The contexts left meet
by anchor; equal ones are collapsed to the earliest, as in all others every window repeats, and the
suffixes at the windows of the others are sorted deep-shallow, to 100 bytes:

* multikey quicksort, eight bytes as one character, to ``SHALLOW`` bytes; groups of one suffix are
  done as soon as they appear;
* groups that agree so far are ordered by a blind trie each: a suffix descends by the branching
  characters alone, is compared once with the leaf it meets, and branches off where they differ.

Suffixes equal to 100 bytes end in one leaf, and all but the earliest repeat. An anchor of more than
``CONTEXTS`` contexts has equal ones collapsed before the shuffle; if twice as many different ones are left (a
short line that many documents share), its windows are grouped one by one by their bytes, which
combine before the shuffle as well.

Defined results: a null text is empty. Documents are ordered by id, null first; rows of one id but
different texts by a 64-bit hash of the row; rows equal in both are one document and get equal
results. A text below 100 bytes loses nothing. An empty table gives no rows; other columns are
ignored. A text is held whole by one task; nothing else in memory grows with the input.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbridge.llm.common import Scratch, slices
from tillbridge.operators.hotkeys import hot_keys
from tillbridge.sinks.store import broadcast_if_small

WIDTH = 100
ANCHOR = 32
SHALLOW = 32
CONTEXTS = 1000
PIECE = 1 << 17  # bytes of text at once; their arrays stay in the cache
SORT_BYTES = 1 << 21  # context bytes sorted together
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)




def _hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``ANCHOR`` bytes from each place on."""
    eight = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)
    sixteen = eight[:-8] * _ODD[0] + eight[8:]
    x = sixteen[:-16] * _ODD[1] + sixteen[16:]
    x ^= x >> np.uint64(32)
    return x * _ODD[2]


def anchors(data: np.ndarray, starts: np.ndarray):
    """Anchors of the windows that start at ``starts``, ascending: hash, place, first window, windows."""
    hashes, span = _hashes(data), WIDTH - ANCHOR + 1
    # Least upper half of each run of ``span`` hashes, by runs of twice the length each time.
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    least, length = upper, 1
    while length < span:
        step = min(length, span - length)
        least = np.minimum(least[:-step], least[step:])
        length += step
    least = least[starts]
    new = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (np.diff(starts) != 1)]))
    first, value = starts[new], least[new]
    count = np.diff(np.append(new, len(starts)))
    place = np.empty(len(new), np.int64)
    for k in range(0, len(new), 1 << 14):
        near = np.lib.stride_tricks.sliding_window_view(upper, span)[first[k:k + (1 << 14)]]
        place[k:k + (1 << 14)] = first[k:k + (1 << 14)] + np.argmax(near == value[k:k + (1 << 14), None], axis=1)
    again = np.flatnonzero(place < first + count - 1)  # the same bytes once more before the run ends
    if len(again):
        parts = [(np.delete(place, again), np.delete(first, again), np.delete(count, again))]
        for k in again:
            end = first[k] + count[k]
            places = first[k] + np.flatnonzero(upper[first[k]:end + span - 1] == value[k])
            froms = np.concatenate([[first[k]], places[:-1] + 1])
            tos = np.minimum(places + 1, end)
            kept = froms < tos
            parts.append((places[kept], froms[kept], (tos - froms)[kept]))
        place, first, count = map(np.concatenate, zip(*parts))
        order = np.argsort(first)
        place, first, count = place[order], first[order], count[order]
    return hashes[place], place, first, count


def _parts(texts: pa.Array):
    """(first row, bytes, offsets of its rows, place in the first row) of about ``PIECE`` bytes; a longer
    text comes in pieces that overlap so that each window is in one."""
    for row, part in slices(texts, PIECE):
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + len(part) + 1]
        if offsets[-1] == offsets[0]:
            continue
        data = np.frombuffer(part.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if len(data) <= 2 * PIECE:
            yield row, data, offsets, 0
        else:
            for at in range(0, len(data) - WIDTH + 1, PIECE):
                piece = data[at:at + PIECE + WIDTH - 1]
                yield row, piece, np.array([0, len(piece)]), at


def _all_windows(offsets: np.ndarray) -> np.ndarray:
    windows = np.maximum(np.diff(offsets) - WIDTH + 1, 0)
    return np.repeat(offsets[:-1] - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())


def _anchor_hashes(batches):
    for batch in batches:
        for row, data, offsets, _ in _parts(batch.column("text")):
            starts = _all_windows(offsets)
            if len(starts):
                hashes, _, first, _ = anchors(data, starts)
                own = np.searchsorted(offsets, first, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(row + own)), pa.array(hashes.view(np.int64))], ["row", "hash"])


def _gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)])
    taken = data[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(taken)])


def _lists(column):
    """Offsets of each row's list, and the items of all."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False))])
    return ends.astype(np.int64), column.flatten()


def _contexts(batches):
    """The anchors whose hash is among those of the row, ``again``, with the bytes that their windows span."""
    for batch in batches:
        ends, again = _lists(batch.column("again"))
        again = again.to_numpy(zero_copy_only=False).view(np.uint64)
        for row, data, offsets, at in _parts(batch.column("text")):
            own = np.repeat(np.arange(len(offsets) - 1), np.diff(ends[row:row + len(offsets)]))
            starts = _all_windows(offsets)
            if not len(own) or not len(starts):
                continue
            hashes, place, first, count = anchors(data, starts)
            text = np.searchsorted(offsets, first, "right") - 1
            step = np.uint64(0x9E3779B97F4A7C15)  # tells the rows' hashes apart
            kept = np.isin(hashes + text.astype(np.uint64) * step, again[ends[row]:ends[row + len(offsets) - 1]] + own.astype(np.uint64) * step)
            hashes, place, first, count, text = (x[kept] for x in (hashes, place, first, count, text))
            rows = pa.array(row + text)
            yield pa.RecordBatch.from_arrays([
                pa.array(hashes.view(np.int64)), pa.array((place - first).astype(np.int32)),
                _gathered(data, first, count + WIDTH - 1).cast(pa.binary()),
                batch.column("doc_id").take(rows), batch.column("row").take(rows),
                pa.array((first - offsets[text] + at).astype(np.int32)),
            ], ["hash", "back", "bytes", "doc_id", "row", "first"])


def trie_order(blob: bytes, suffixes: list[int], depth: int) -> list[list[int]]:
    """Groups of equal suffixes, in order of their bytes from ``depth`` to ``WIDTH``; the bytes before
    are equal. A blind trie: nodes know the depth at which suffixes part and the byte there, no more."""
    root = [suffixes[0]]  # a leaf is a list of equal suffixes, a node a pair (depth, children)
    for x in suffixes[1:]:
        own, node, path = blob[x:x + WIDTH], root, []
        while type(node) is tuple:
            path.append(node)
            children = node[1]
            node = children.get(own[node[0]]) or next(iter(children.values()))
        other = blob[node[0]:node[0] + WIDTH]
        if own == other:
            node.append(x)
            continue
        part = depth
        while own[part] == other[part]:
            part += 1
        above = None
        for parent in path:  # the last node before the place where x parts
            if parent[0] > part:
                break
            above = parent
        if above is not None and above[0] == part:
            above[1][own[part]] = [x]
            continue
        below = root if above is None else above[1][own[above[0]]]
        branch = (part, {other[part]: below, own[part]: [x]})
        if above is None:
            root = branch
        else:
            above[1][own[above[0]]] = branch
    ordered, stack = [], [root]
    while stack:
        node = stack.pop()
        if type(node) is tuple:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
        else:
            ordered.append(node)
    return ordered


def earliest(blob: bytes, places: np.ndarray, groups: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Whether each suffix is the one of least rank among those of its group with equal ``WIDTH`` bytes."""
    first = np.ones(len(places), bool)
    padded = blob + bytes(8)
    eight = np.ndarray((len(blob) + 1,), ">u8", padded, strides=(1,))
    alive, groups = np.arange(len(places)), groups.astype(np.int64)
    for depth in range(0, SHALLOW, 8):  # multikey quicksort, eight bytes as one character
        key = eight[places[alive] + depth].astype(np.uint64)
        order = np.lexsort((key, groups))
        alive, groups, key = alive[order], groups[order], key[order]
        new = np.concatenate([[True], (groups[1:] != groups[:-1]) | (key[1:] != key[:-1])])
        groups = np.cumsum(new)
        size = np.bincount(groups)
        several = size[groups] > 1
        alive, groups = alive[several], groups[several]
        if not len(alive):
            return first
    edges = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])).tolist() + [len(groups)]
    place, ranks, index = places[alive].tolist(), rank[alive].tolist(), alive.tolist()
    later = []
    for a, b in zip(edges, edges[1:]):
        at = {place[k]: k for k in range(a, b)}
        for equal in trie_order(blob, place[a:b], SHALLOW):
            if len(equal) > 1:
                keep = min(equal, key=lambda x: ranks[at[x]])
                later += [index[at[x]] for x in equal if x != keep]
    first[later] = False
    return first


def _repeated(table: pa.Table) -> pa.RecordBatch:
    """Runs of windows that occur earlier, among whole anchors sorted by hash, place in the context, and bytes."""
    table = table.combine_chunks()
    hashes, back, lo = (table[c].to_numpy().astype(np.int64) for c in ("hash", "back", "first"))
    column = table["bytes"].combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    ids, rows = table["doc_id"].combine_chunks(), table["row"].combine_chunks()
    order = pc.sort_indices(
        pa.table({"doc_id": ids, "row": rows, "at": lo + back}),
        [("doc_id", "ascending"), ("row", "ascending"), ("at", "ascending")], null_placement="at_start").to_numpy()
    by_place = pa.table({"doc_id": ids, "row": rows, "at": lo + back}).take(pa.array(order))
    moved = np.zeros(len(order), bool)
    for name in by_place.column_names:  # one document's place has one rank, though rows may be repeated
        c = by_place[name].combine_chunks()
        equal = pc.equal(c[1:], c[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
        both_null = pc.and_(pc.is_null(c[1:]), pc.is_null(c[:-1])).to_numpy(zero_copy_only=False)
        moved[1:] |= ~(equal | both_null)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(moved)
    # Equal contexts are neighbours; of each, the earliest goes on.
    new = np.ones(len(hashes), bool)
    if len(hashes) > 1:
        new[1:] = (hashes[1:] != hashes[:-1]) | (back[1:] != back[:-1]) | ~pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    context = np.cumsum(new) - 1
    least = np.minimum.reduceat(rank, np.flatnonzero(new))
    again = rank > least[context]
    first = np.flatnonzero(~again)
    first = first[np.concatenate([[True], context[first][1:] != context[first][:-1]])]
    anchor = np.cumsum(np.concatenate([[True], hashes[first][1:] != hashes[first][:-1]])) - 1
    first = first[np.bincount(anchor)[anchor] > 1]
    out = [np.flatnonzero(again), lo[again], lo[again] + np.diff(offsets)[again] - WIDTH + 1]
    if len(first):
        many = np.diff(offsets)[first] - WIDTH + 1
        starts = np.concatenate([[0], np.cumsum(many)])
        within = np.arange(starts[-1]) - np.repeat(starts[:-1], many)
        anchor = np.cumsum(np.concatenate([[True], hashes[first][1:] != hashes[first][:-1]]))
        ahead = np.repeat(back[first], many) - within  # equal windows lie alike around their anchor
        blob = column.buffers()[2].to_pybytes()[offsets[0]:offsets[-1]]
        repeats = ~earliest(
            blob, np.repeat(offsets[first] - offsets[0], many) + within,
            np.repeat(anchor, many) * (WIDTH + 1) + ahead, np.repeat(rank[first], many))
        cut = np.zeros(len(repeats) + 1, bool)
        cut[starts] = True
        begins = np.flatnonzero(repeats & (cut[:-1] | ~np.concatenate([[False], repeats[:-1]])))
        ends = np.flatnonzero(repeats & (cut[1:] | ~np.concatenate([repeats[1:], [False]]))) + 1
        k = np.searchsorted(starts, begins, "right") - 1
        out = [np.concatenate([a, b]) for a, b in zip(
            out, (first[k], begins - starts[k] + lo[first[k]], ends - starts[k] + lo[first[k]]))]
    taken = pa.array(out[0])
    return pa.RecordBatch.from_arrays([
        ids.take(taken), rows.take(taken), *[pa.array(x.astype(np.int32)) for x in out[1:]],
        pa.array(np.ones(len(taken), np.int32))], ["doc_id", "row", "begin", "end", "sign"])


def _sorted(batches):
    """Rows come sorted; whole anchors are sorted together, some ``SORT_BYTES`` at a time."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < SORT_BYTES:
            continue
        table = pa.Table.from_batches(held)
        hashes = table["hash"].to_numpy()
        cut = int(np.searchsorted(hashes, hashes[-1]))
        if cut:
            yield _repeated(table.slice(0, cut))
        held = table.slice(cut).to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield _repeated(pa.Table.from_batches(held))


def _judged(batches, keep_text: bool):
    for batch in batches:
        ends, marks = _lists(batch.column("marks"))
        marks = {f.name: marks.field(k).to_numpy(zero_copy_only=False) for k, f in enumerate(marks.type)}
        texts, out = batch.column("text"), []
        for k in range(batch.num_rows):
            data = texts[k].as_buffer()
            view, own, spans = memoryview(data), slice(ends[k], ends[k + 1]), np.zeros((0, 2), np.int64)
            if own.stop > own.start:
                step = np.zeros(len(data) + 1, np.int32)
                np.add.at(step, marks["begin"][own], marks["sign"][own])
                np.add.at(step, marks["end"][own], -marks["sign"][own])
                spans = _runs(np.cumsum(step[:-1]) > 0)
                cover = np.zeros(len(data) + 1, np.int32)  # windows to the bytes they cover
                np.add.at(cover, spans[:, 0], 1)
                np.add.at(cover, spans[:, 1] + WIDTH - 1, -1)
                spans = _runs(np.cumsum(cover[:-1]) > 0)
            at, left = 0, []
            for begin, end in spans.tolist():
                left.append(view[at:begin])
                at = end
            left = b"".join([*left, view[at:]])
            out.append((len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest(),
                        [{"start": a, "end": b} for a, b in spans.tolist()], left if keep_text else None))
        columns = list(zip(*out)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


def _runs(flags: np.ndarray) -> np.ndarray:
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)], axis=1)


def _marks(texts: DataFrame, hot: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """``doc_id``, ``row``, ``begin``, ``end``, ``sign``: runs of windows; those with a positive sum repeat."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    marks = f"doc_id {kind}, row long, begin int, end int, sign int"
    contexts = texts.mapInArrow(_contexts, f"hash long, back int, bytes binary, doc_id {kind}, row long, first int")

    def ordered(frame):
        return frame.repartition("hash").sortWithinPartitions("hash", "back", "bytes").mapInArrow(_sorted, marks)

    if hot.isEmpty():
        return ordered(contexts)
    # Every window of a hot anchor is marked; the earliest of equal contexts are unmarked, whole where
    # no other context has their anchor's windows, else as far as the sorting finds nothing earlier.
    few = broadcast_if_small(hot)
    place, end = F.struct("doc_id", "row", "first"), f"first + length(bytes) - {WIDTH - 1} AS end"
    often = scratch.keep(contexts.join(few, contexts.hash == few.k, "left_semi"), "often")
    single = scratch.keep(often.groupBy("hash", "back", "bytes").agg(F.min(place).alias("p")).select(
        "hash", "back", "bytes", "p.*"), "single")
    still = scratch.keep(hot_keys(single, F.col("hash"), 2 * most + 1), "still")  # sorted up to here
    fewer = broadcast_if_small(still)
    sortable = single.join(fewer, single.hash == fewer.k, "left_anti")
    windows = single.join(fewer, single.hash == fewer.k, "left_semi").select(
        "doc_id", "row", "first", "bytes", F.expr(f"explode(sequence(0, length(bytes) - {WIDTH})) AS k")).selectExpr(
        "doc_id", "row", "first + k AS first", f"substring(bytes, k + 1, {WIDTH}) AS bytes")
    parts = [
        ordered(contexts.join(few, contexts.hash == few.k, "left_anti").unionByName(sortable)),
        often.selectExpr("doc_id", "row", "first AS begin", end, "2 AS sign"),
        sortable.selectExpr("doc_id", "row", "first AS begin", end, "-2 AS sign"),
        windows.groupBy("bytes").agg(F.min(place).alias("p")).selectExpr(
            "p.doc_id", "p.row", "p.first AS begin", "p.first + 1 AS end", "-2 AS sign")]
    return reduce(DataFrame.unionByName, parts)


def repeats(docs: DataFrame, keep_text: bool = False, most: int = CONTEXTS) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and the removed ``spans`` in bytes.

    With ``keep_text`` the remaining bytes come as ``kept``: a cut may fall within a character.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_anchor_hashes, "row long, hash long")
    twice = scratch.keep(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "twice")
    again = scratch.keep(found.join(twice.select("hash"), "hash", "left_semi").groupBy("row").agg(
        F.collect_set("hash").alias("again")), "again")
    texts = scratch.keep(rows.join(again, "row", "left"), "texts")
    scratch.drop(again)
    marks = scratch.keep(_marks(
        texts.where("again IS NOT NULL"), twice.where(F.col("n") > most).select(F.col("hash").alias("k")), scratch, most).groupBy("doc_id", "row").agg(
        F.collect_set(F.struct("begin", "end", "sign")).alias("marks")), "marks")
    scratch.drop(texts)
    marked = rows.join(
        marks.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "marks"),
        (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id", "_row")
    whole = scratch.keep(marked.mapInArrow(
        lambda batches: _judged(batches, keep_text),
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
        " spans array<struct<start: bigint, end: bigint>>, kept binary"), "repeats")
    scratch.drop_all_but(whole)
    return whole if keep_text else whole.drop("kept")
