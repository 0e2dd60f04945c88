"""Language-model scores from a hidden Markov model of words.

Training counts every word of the training texts (Spark sums), then runs Baum-Welch: texts are
kept in chunks of about ``CHUNK`` tokens, each chunk computes expected counts, Spark adds them up.
Every word that occurs ``LEAST`` times or more has emissions of its own, so the emissions grow
with the corpus; rarer words share the symbol OTHER, whose probability is split by their exact
counts. Texts are scored by the scaled forward recursion over the whole text, in double
precision. Training follows whole texts as well: a long one is computed in pieces of ``SEGMENT``
tokens side by side, after products of their transition matrices have told the states each
begins with and what follows it. Chunks take turns in ``ROUNDS`` groups, in training and in scoring, which
bounds the shuffle files on disk.

Words are identified by 64-bit hashes. Words above 1/``LOOKUP`` of all tokens (at most
``LOOKUP``, and the end token) lie in an array that tasks share; the emissions of all others are
a stored table. Those words are dealt to parts by their hashes, one for every ``PART`` training tokens
(``PARTS`` at least, unless the words are few), and a chunk lists its words by part. In every pass a part looks up the words
that chunks list of it, and sends each chunk their emissions in one row; the sums return the same
way. Where a word lies does not change its treatment. As a chunk lists a word once, no word is a
hot key. Emissions are rounded to single precision, sums and recursions are in double.

Training ends when a pass raises the log-likelihood by less than ``TOLERANCE`` of its amount, or
after ``ITERATIONS`` passes.

Null and empty texts consist of the end token alone. A null id counts as training data. With
nothing to learn from, every count is 0 and the model gives each symbol the same probability.
Repeated rows are scored each; columns other than id and text are ignored, whatever their names.
A text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbridge.llm.common import Scratch, crc_mod, mix, slices, word_hashes

STATES = 8
LEAST = 5  # occurrences from which on a word has emissions of its own
LOOKUP = 1 << 16  # words above 1/LOOKUP of all tokens are shared with the tasks, others joined
ITERATIONS = 3
TOLERANCE = 2e-3
CHUNK = 1 << 21  # tokens
SEGMENT = 1 << 10  # tokens of a piece in training; pieces know what lies before and behind
ROUNDS = 3  # groups of chunks in a pass over all
BLOCK = 1 << 18  # tokens held at once in training
LISTED = 1 << 16  # words of a chunk in one row
PART = 1 << 21  # training tokens for each part of the words
PARTS = 32  # fewest parts of a vocabulary of 1024 words for each
SCALED = 4  # steps of a recursion between two divisions by the sum over states
END = int(mix(np.array([12345], np.uint64)).view(np.int64)[0])
ADD = 0.1
PRIOR = 10.0  # pseudo-occurrences of a state, spread by the words' counts
FLUSH = 1 << 21


@dataclass
class Model:
    """start[k], move[j, k], emit[symbol, k]."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


@dataclass
class Vocabulary:
    """Sorted hashes of the shared words and their counts; OTHER is the symbol behind the last."""

    words: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int
    other_tokens: int
    other_distinct: int
    lookup: int
    parts: int

    @property
    def other(self) -> int:
        return len(self.words)

    def part(self):
        """The part of the column ``word``."""
        return F.pmod("word", F.lit(self.parts)).cast("int").alias("part")

    def joined(self):
        """Condition on (word, n): a word with emissions of its own that is not shared."""
        return (F.col("n") >= LEAST) & (F.col("n") * self.lookup < self.tokens) & (F.col("word") != END)


@dataclass
class Parameters:
    """What the driver holds of a model: emissions of shared words and OTHER are not yet
    divided by ``total``, the sums over all symbols; those of other words are in a table."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    total: np.ndarray


def tokens_of(texts):
    """Per slice: first row, word hashes with the end token appended to each text, offsets."""
    for at, part in slices(texts):
        words, offsets = word_hashes(part)
        lengths = np.diff(offsets)
        ends = offsets[1:] + np.arange(len(lengths))
        out = np.empty(len(words) + len(lengths), np.int64)
        inner = np.ones(len(out), bool)
        inner[ends] = False
        out[inner] = words.view(np.int64)
        out[ends] = END
        yield at, out, np.concatenate([[0], ends + 1])


def _merged(parts):
    words = np.concatenate([w for w, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    unique, inverse = np.unique(words, return_inverse=True)
    return unique, np.bincount(inverse, counts, len(unique)).astype(np.int64)


def _count_batches(batches):
    parts, size = [], 0

    def rows(words, counts):
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], ["word", "n"])

    for batch in batches:
        for _, words, _ in tokens_of(batch.column(0)):
            parts.append(np.unique(words, return_counts=True))
            size += len(parts[-1][0])
            if size > FLUSH:
                parts = [_merged(parts)]
                size = len(parts[0][0])
                if size > FLUSH // 2:
                    yield rows(*parts[0])
                    parts, size = [], 0
    if parts:
        yield rows(*_merged(parts))


def token_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word hash, n) over all tokens, the end tokens among them."""
    return (texts.select(text).mapInArrow(_count_batches, "word long, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def vocabulary(counts: DataFrame, lookup: int = LOOKUP) -> Vocabulary:
    """The words that tasks hold; ``counts`` should be a stored table."""
    rare = (F.col("n") < LEAST) & (F.col("word") != END)
    total, distinct, other, other_distinct = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"),
        F.coalesce(F.sum(F.when(rare, F.col("n"))), F.lit(0)), F.count_if(rare)).first()
    shared = counts.where(((F.col("n") >= LEAST) & (F.col("n") * lookup >= total)) | (F.col("word") == END)).toArrow()
    order = np.argsort(words := shared.column("word").to_numpy())
    words, n = words[order], shared.column("n").to_numpy()[order]
    if END not in words:  # nothing to learn from
        at = int(np.searchsorted(words, END))
        words, n = np.insert(words, at, END), np.insert(n, at, 0)
    parts = max(1 + total // PART, min(PARTS, 1 + distinct // 1024))
    return Vocabulary(words, n, total, distinct, other, other_distinct, lookup, parts)


def _lists(number, turn, words, part, schema: pa.Schema) -> pa.RecordBatch:
    """Rows of up to ``LISTED`` words of one part; the words come by part."""
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else part
    first = [at for a, b in zip(edges, np.append(edges[1:], len(part))) for at in range(a, b, LISTED)]
    rows = len(first)
    own = {"chunk": np.full(rows, number, np.int64), "turn": np.full(rows, turn, np.int32), "part": part[first].astype(np.int32),
           "first": np.array(first, np.int32)}
    lists = pa.ListArray.from_arrays(pa.array([*first, len(part)], pa.int32()), pa.array(words, pa.int64()))
    return pa.RecordBatch.from_arrays([
        lists if f.name == "words" else pa.array(own[f.name]) if f.name in own else pa.nulls(rows, f.type) for f in schema], schema=schema)


def _chunk(number, turn, parts, vocab: Vocabulary):
    """Rows of a chunk: its texts as symbols, then its words that are not shared, by part."""
    words = np.concatenate([p[2] for p in parts])
    symbols = np.minimum(np.searchsorted(vocab.words, words), len(vocab.words) - 1)
    own = vocab.words[symbols] == words
    listed, place = np.unique(words[~own], return_inverse=True)
    part = np.mod(listed, vocab.parts)
    order = np.argsort(part, kind="stable")
    behind = np.empty(len(order), np.int64)
    behind[order] = np.arange(len(order))
    symbols[~own] = vocab.other + behind[place]
    data, at = symbols.astype(np.uint32), 0
    for ids, held, _, offsets in parts:
        n, to = len(ids), at + int(offsets[-1])
        texts = pa.Array.from_buffers(pa.large_binary(), n, [
            None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(data[at:to])])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(n, number)), pa.array(np.full(n, turn, np.int32)), ids, held, texts.cast(pa.binary()),
            pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64()))], schema=ENCODED_ARROW)
        at = to
    yield _lists(number, turn, listed[order], part[order], ENCODED_ARROW)


ENCODED = "chunk long, turn int, id long, held_out boolean, symbols binary, part int, first int, words array<long>"
ENCODED_ARROW = pa.schema([
    ("chunk", pa.int64()), ("turn", pa.int32()), ("id", pa.int64()), ("held_out", pa.bool_()), ("symbols", pa.binary()),
    ("part", pa.int32()), ("first", pa.int32()), ("words", pa.list_(pa.int64()))])


def encode(frame: DataFrame, vocab: Vocabulary, chunk: int = CHUNK) -> DataFrame:
    """Texts as symbols, and in rows of their own (without symbols) the words of each chunk.

    A symbol is the place of a shared word, or ``vocab.other`` and the word's place in the list
    of its chunk. ``turn`` is the round of the chunk.
    """
    shared = frame.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        partition = TaskContext.get().partitionId()
        number, parts, size = partition << 32, [], 0
        for batch in batches:
            for at, words, offsets in tokens_of(batch.column("text")):
                n = len(offsets) - 1
                parts.append((batch.column("id").slice(at, n), batch.column("held_out").slice(at, n), words, offsets))
                size += len(words)
                if size >= chunk:
                    yield from _chunk(number, (partition + number) % ROUNDS, parts, shared.value)
                    number, parts, size = number + 1, [], 0
        if parts:
            yield from _chunk(number, (partition + number) % ROUNDS, parts, shared.value)

    return frame.mapInArrow(run, ENCODED)


PREPARED = ("chunk long, turn int, id long, held_out boolean, n_tokens long, n_known long, base double, rest double, "
            "symbols binary, part int, first int, words array<long>")
PREPARED_ARROW = pa.schema([
    ("chunk", pa.int64()), ("turn", pa.int32()), ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("base", pa.float64()), ("rest", pa.float64()), ("symbols", pa.binary()), ("part", pa.int32()),
    ("first", pa.int32()), ("words", pa.list_(pa.int64()))])


def listed_words(encoded: DataFrame) -> DataFrame:
    """(chunk, place, word) of the words in the chunks' lists."""
    return encoded.where("symbols IS NULL").select("chunk", "first", F.posexplode("words").alias("at", "word")).select(
        F.col("chunk").alias("chunk"), (F.col("first") + F.col("at")).alias("place"), "word")


def _bytes(column) -> np.ndarray:
    """The values of a binary column, one behind the other."""
    column = column.cast(pa.large_binary())
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]


def _binary(values: np.ndarray, ends) -> pa.Array:
    """A binary column: row k holds the values from ``ends[k]`` up to ``ends[k + 1]``."""
    values = np.ascontiguousarray(values)
    size = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer((np.asarray(ends, np.int64) * size).astype(np.int32)), pa.py_buffer(values)])


DEALT = "turn int, chunk long, part int, place binary, word binary, e binary"
DEALT_NAMES = ["turn", "chunk", "part", "place", "word", "e"]


def chunk_words(encoded: DataFrame, values: DataFrame) -> DataFrame:
    """What ``values`` (part, word, e) holds of the words each chunk lists: a row for each list, with
    the places, hashes and e of the words found as bytes. e is binary of one size, or long."""
    def run(lists: pa.Table, known: pa.Table) -> pa.Table:
        words, e = known.column("word").to_numpy(), known.column("e")
        e = np.ascontiguousarray(e.to_numpy()).view(np.uint8) if pa.types.is_int64(e.type) else _bytes(e)
        rows = lists.column("words").combine_chunks()
        rows = pa.concat_arrays(rows.chunks) if isinstance(rows, pa.ChunkedArray) else rows
        wanted, many = rows.flatten().to_numpy(), rows.value_lengths().to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(many)])
        place = np.arange(ends[-1]) + np.repeat(lists.column("first").to_numpy() - ends[:-1], many)
        if not len(words) or not len(wanted):
            found, at, e = np.zeros(len(wanted), bool), np.zeros(0, np.int64), np.zeros((1, 8), np.uint8)
        else:
            order = np.argsort(words)
            at = np.minimum(np.searchsorted(words[order], wanted), len(words) - 1)
            at, e = order[at], e.reshape(len(words), -1)
            found = words[at] == wanted
            at = at[found]
        ends = np.concatenate([[0], np.cumsum(found)])[ends]
        return pa.Table.from_arrays(
            [*[lists.column(c) for c in DEALT_NAMES[:3]], _binary(place[found].astype(np.int32), ends), _binary(wanted[found], ends),
             _binary(np.take(e, at, axis=0), ends)], DEALT_NAMES)

    lists = encoded.where("symbols IS NULL").select(*DEALT_NAMES[:3], "first", "words")
    return lists.groupBy("part").cogroup(values.select("part", "word", "e").groupBy("part")).applyInArrow(run, DEALT)


def counted_words(encoded: DataFrame, counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The counts of the words each chunk lists, as ``chunk_words`` has them."""
    return chunk_words(encoded, counts.select(vocab.part(), "word", F.col("n").alias("e")))


def prepare(encoded: DataFrame, counts: DataFrame, vocab: Vocabulary, known: DataFrame | None = None) -> DataFrame:
    """Encoded texts with their sums over words; words without emissions of their own become OTHER.

    ``vocab.other`` is OTHER now, and the words still listed follow it. ``rest`` adds up what
    the words that became OTHER have of it. ``known`` are the ``counted_words``, if at hand.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocab)

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not len(texts):
            return PREPARED_ARROW.empty_table()
        v, rows = shared.value, len(texts)
        symbols, offsets = _symbols(texts.column("symbols"))
        n = np.zeros(max(0, int(symbols.max()) + 1 - v.other), np.int64)  # words that occur in no training text stay 0
        words, part = np.zeros_like(n), np.zeros_like(n)
        place, counted = _bytes(known.column("place")).view(np.int32), _bytes(known.column("word")).view(np.int64)
        n[place], words[place] = _bytes(known.column("e")).view(np.int64), counted
        part[place] = np.mod(counted, v.parts)
        own = np.flatnonzero(n >= LEAST)
        symbol = np.concatenate([np.arange(v.other), np.full(len(n), v.other)])
        symbol[v.other + own] = v.other + 1 + np.arange(len(own))
        n = np.concatenate([v.counts, n])
        logs, other = np.log10(n + ADD), np.log10(v.other_tokens + ADD * (v.other_distinct + 1))
        rest = np.where(symbol == v.other, logs - other, 0.0)
        sums = [np.add.reduceat(np.take(x, symbols), offsets[:-1]) for x in ((n > 0).astype(np.int64), logs, rest)]
        lengths = np.diff(offsets)
        base = sums[1] - lengths * np.log10(v.tokens + ADD * (v.distinct + 1))
        binary = pa.Array.from_buffers(pa.large_binary(), rows, [
            None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(np.take(symbol.astype(np.uint32), symbols))])
        chunk, turn = (texts.column(c) for c in ("chunk", "turn"))
        kept = pa.Table.from_arrays([
            chunk, turn, texts.column("id"), texts.column("held_out"), pa.array(lengths), pa.array(sums[0]),
            pa.array(base), pa.array(sums[2]), binary.cast(pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int32()),
            pa.nulls(rows, pa.list_(pa.int64()))], schema=PREPARED_ARROW)
        lists = _lists(chunk[0].as_py(), turn[0].as_py(), words[own], part[own], PREPARED_ARROW)
        return pa.concat_tables([kept, pa.Table.from_batches([lists])])

    known = counted_words(encoded, counts, vocab) if known is None else known
    texts = encoded.where("symbols IS NOT NULL").select("chunk", "turn", "id", "held_out", "symbols")
    return texts.groupBy("chunk").cogroup(
        known.select("chunk", "place", "word", "e").groupBy("chunk")).applyInArrow(run, PREPARED)


def _names(states: int) -> list[str]:
    return [f"s{k}" for k in range(states)]


def _scattered(words: np.ndarray, n: np.ndarray, states: int) -> np.ndarray:
    """Emissions to begin with: the counts times log-normal noise drawn from the words' hashes."""
    out = np.empty((len(words), states))
    for k in range(states):
        one, two = (mix(words.view(np.uint64) ^ mix(np.array([2 * k + j], np.uint64))) >> np.uint64(11) for j in (1, 2))
        normal = np.sqrt(-2 * np.log((one + np.uint64(1)) / 2.0 ** 53)) * np.cos(2 * np.pi * (two / 2.0 ** 53))
        out[:, k] = (n + 1) * np.exp(2 * normal)
    return out


def _packed(part, words, values: np.ndarray) -> pa.RecordBatch:
    """(part, word, e): the values of each word as single-precision bytes."""
    packed = _binary(values.astype(np.float32), np.arange(len(values) + 1))
    return pa.RecordBatch.from_arrays([part, words, packed], ["part", "word", "e"])


def _unpacked(column, states: int) -> np.ndarray:
    return _bytes(column).view(np.float32).reshape(-1, states).astype(np.float64)


EMISSIONS = "part int, word long, e binary"


def first_emissions(counts: DataFrame, vocab: Vocabulary, states: int) -> DataFrame:
    """(part, word, e) of the words that are not shared."""
    def run(batches):
        for batch in batches:
            n = batch.column("n").to_numpy()
            yield _packed(batch.column("part"), batch.column("word"), _scattered(batch.column("word").to_numpy(), n, states))

    return counts.where(vocab.joined()).select(vocab.part(), "word", "n").mapInArrow(run, EMISSIONS)


def _with_total(start, move, emit, emissions: DataFrame) -> Parameters:
    states, names = len(start), _names(len(start))

    def run(batches):
        total = sum((_unpacked(batch.column(0), states).sum(0) for batch in batches), np.zeros(states))
        yield pa.RecordBatch.from_arrays([pa.array([float(x)]) for x in total], names)

    rest = emissions.select("e").mapInArrow(run, ", ".join(f"{n} double" for n in names)).agg(
        *[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names]).first()
    emit = emit.astype(np.float32).astype(np.float64)
    return Parameters(start, move, emit, emit.sum(0) + np.array([rest[n] for n in names]))


def initial(vocab: Vocabulary, emissions: DataFrame, states: int) -> Parameters:
    """Sticky states whose emissions scatter around the word frequencies."""
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    words = np.append(vocab.words, [0]).astype(np.int64)  # OTHER takes the noise of hash 0
    emit = _scattered(words, np.append(vocab.counts, vocab.other_tokens), states)
    return _with_total(np.full(states, 1 / states), move, emit, emissions)


def _symbols(column):
    """All symbols of a binary column, and each row's offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.cast(pa.large_binary()).combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(np.uint32)
    return data.astype(np.int64), (offsets - offsets[0]) // 4


def _model(known: pa.Table, parameters: Parameters) -> Model:
    """A chunk's model: shared words, OTHER, then the listed words."""
    states, shared = len(parameters.start), len(parameters.emit)
    place = _bytes(known.column("place")).view(np.int32)
    emit = np.empty((shared + len(place), states))
    emit[:shared] = parameters.emit
    emit[shared + place] = _unpacked(known.column("e"), states)
    emit /= parameters.total
    return Model(parameters.start, parameters.move, emit)


def log_likelihood(symbols, offsets, model: Model) -> np.ndarray:
    """Natural logarithm of each sequence's probability: all sequences advance in step."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = offsets[:-1][order], lengths[order]
    out = np.zeros(len(order))
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 2), "right") if len(order) else []
    ones, state = np.ones(len(model.start)), None
    for t, (m, go_on) in enumerate(zip(active, active[1:])):
        emit = np.take(model.emit, np.take(symbols, starts[:m] + t), axis=0)
        state = emit * model.start if state is None else (state[:m] @ model.move) * emit
        if go_on < m:
            out[go_on:m] += np.log(state[go_on:m] @ ones)
        if t % SCALED == 0:
            scale = state[:go_on] @ ones
            state[:go_on] /= scale[:, None]
            out[:go_on] += np.log(scale)
    result = np.empty(len(order))
    result[order] = out
    return result


def _pieces(starts, lengths, segment: int):
    """Places and sizes of the pieces of each sequence, and whether they are its first."""
    many = -(-lengths // segment)
    text = np.repeat(np.arange(len(lengths)), many)
    inside = (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * segment
    return starts[text] + inside, np.minimum(segment, lengths[text] - inside), inside == 0


def _surroundings(symbols, starts, sizes, first, model: Model):
    """For each piece the state before it (0 before a first one), and the backward values behind it."""
    states = len(model.start)
    before, behind = np.zeros((len(starts), states)), np.ones((len(starts), states))
    last = np.append(first[1:], True)
    cut = np.flatnonzero(~(first & last))
    if not len(cut):
        return before, behind
    order = cut[np.argsort(-sizes[cut], kind="stable")]
    matrix = np.where(first[order][:, None, None], np.eye(states), model.move) * model.emit[symbols[starts[order]]][:, None, :]
    step, at, ones = np.empty_like(matrix), starts[order], np.ones(states * states)
    for t, m in enumerate(np.searchsorted(-sizes[order], -np.arange(1, int(sizes[order[0]])), "left"), 1):
        np.matmul(matrix[:m].reshape(-1, states), model.move, out=step[:m].reshape(-1, states))
        emit = np.take(model.emit, np.take(symbols, at[:m] + t), axis=0)
        np.multiply(step[:m], emit[:, None, :], out=matrix[:m])
        if t % SCALED == 0:
            matrix[:m] /= (matrix[:m].reshape(m, -1) @ ones)[:, None, None]
    matrix /= matrix.sum((1, 2), keepdims=True)
    place = np.empty(len(starts), np.int64)
    place[order] = np.arange(len(order))
    for p in cut[~last[cut]]:
        state = (model.start if first[p] else before[p]) @ matrix[place[p]]
        before[p + 1] = state / state.sum()
    for p in cut[~first[cut]][::-1]:
        values = matrix[place[p]] @ behind[p]
        behind[p - 1] = values / (before[p] @ values)
    return before, behind


def _piece_counts(symbols, starts, sizes, before, behind, first, model: Model, emissions):
    """Baum-Welch sums of pieces in descending order of size: start, moves and logarithm of the
    likelihood; those of state k are added to ``emissions[k]``."""
    states, longest = len(model.start), int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), "right")
    ends = np.concatenate([[0], np.cumsum(active)])  # tokens by step: those of step t lie from ends[t]
    place = np.empty(ends[-1], np.int64)
    for t, m in enumerate(active):
        np.take(symbols, starts[:m] + t, out=place[ends[t]:ends[t + 1]], mode="clip")
    emit = np.take(model.emit, place, axis=0)
    forward, scales, ones = np.empty_like(emit), {}, np.ones(states)
    np.multiply(np.where(first[:, None], model.start, before @ model.move), emit[:len(sizes)], out=forward[:len(sizes)])
    for t in range(1, longest):
        now = forward[ends[t]:ends[t + 1]]
        np.matmul(forward[ends[t - 1]:ends[t - 1] + active[t]], model.move, out=now)
        now *= emit[ends[t]:ends[t + 1]]
        if t % SCALED == 0:
            scales[t] = (now @ ones)[:, None]
            now /= scales[t]
    last = forward[ends[sizes - 1] + np.arange(len(sizes))] @ ones
    log = float(np.log(last).sum() + sum(np.log(scale).sum() for scale in scales.values()))
    behind = behind / last[:, None]  # so that forward and backward values multiply to a sum of 1
    moves, backward = np.zeros((states, states)), behind[:0]
    for t in range(longest - 1, -1, -1):
        m = active[t]
        if len(backward) < m:
            backward = np.concatenate([backward, behind[len(backward):m]])
        pull = emit[ends[t]:ends[t + 1]]
        pull *= backward
        if t in scales:
            pull /= scales[t]
        forward[ends[t]:ends[t + 1]] *= backward  # the weights of the states, from here on
        moves += (forward[ends[t - 1]:ends[t - 1] + m] if t else before).T @ pull
        if t:
            backward = pull @ model.move.T
    for k in range(states):
        emissions[k] += np.bincount(place, forward[:, k], emissions.shape[1])
    return forward[:len(sizes)][first].sum(0), moves, log


def expected_counts(symbols, starts, lengths, model: Model, segment: int = SEGMENT):
    """Baum-Welch sums of whole sequences: start, moves, emissions, logarithm of the likelihood."""
    starts, sizes, first = _pieces(starts, lengths, segment)
    before, behind = _surroundings(symbols, starts, sizes, first, model)
    order = np.argsort(-sizes, kind="stable")
    start, moves, emissions, log = np.zeros(len(model.start)), np.zeros_like(model.move), np.zeros(model.emit.T.shape), 0.0
    at = 0
    while at < len(order):
        part = order[at:at + max(1, BLOCK // int(sizes[order[at]]))]
        a, b, c = _piece_counts(symbols, starts[part], sizes[part], before[part], behind[part], first[part], model, emissions)
        start, moves, log = start + a, moves + b, log + c
        at += len(part)
    return start, moves * model.move, np.ascontiguousarray(emissions.T), log


SUMS = "part int, shared boolean, code binary, s binary"
SUMS_NAMES = ["part", "shared", "code", "s"]


def _expectations(prepared: DataFrame, emissions: DataFrame, parameters: Parameters, parts: int) -> DataFrame:
    """(part, shared, code, s): sums for the words listed of each part, whose codes are their hashes, and
    shared ones for symbols, with negative codes those of the moves, the start and the logarithm."""
    states = len(parameters.start)
    sent = prepared.sparkSession.sparkContext.broadcast(parameters)

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        model = _model(known, sent.value)
        if not len(texts):  # all are held out
            return pa.Table.from_arrays([pa.nulls(0, t) for t in (pa.int32(), pa.bool_(), pa.binary(), pa.binary())], SUMS_NAMES)
        symbols, offsets = _symbols(texts.column("symbols"))
        start, moves, emit, log = expected_counts(symbols, offsets[:-1], np.diff(offsets), model)
        others = len(sent.value.emit)
        used, last = np.flatnonzero(emit[:others].sum(1)), np.zeros(states)
        last[0] = log
        part = np.concatenate([np.full(states + 2, texts.column("chunk")[0].as_py() % parts), used % parts])
        code = np.concatenate([[-1 - states, -2 - states], -1 - np.arange(states), used]).astype(np.int64)
        sums = np.concatenate([[start, last], moves, emit[used]]).astype(np.float32)
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(first, len(part))
        own = pa.Table.from_arrays(
            [pa.array(part[first].astype(np.int32)), pa.array(np.ones(len(first), bool)), _binary(code[order], ends),
             _binary(sums[order], ends)], SUMS_NAMES)
        place = _bytes(known.column("place")).view(np.int32)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(known.column("word")).to_numpy() // 8)])
        listed = pa.Table.from_arrays(
            [known.column("part"), pa.array(np.zeros(len(known), bool)), known.column("word"),
             _binary(np.take(emit, others + place, axis=0).astype(np.float32), ends)], SUMS_NAMES)
        return pa.concat_tables([own, listed])

    texts = prepared.where("symbols IS NOT NULL AND NOT held_out").select("chunk", "symbols")
    known = chunk_words(prepared, emissions).drop("turn")
    return _added(texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, SUMS), np.float32)


def _added(sums: DataFrame, kind) -> DataFrame:
    """Sums in double precision, a row for each part; those given are of the numpy type ``kind``."""
    def run(rows: pa.Table) -> pa.Table:
        code = _bytes(rows.column("code")).view(np.int64)
        values = _bytes(rows.column("s")).view(kind).reshape(len(code), -1)
        order = np.argsort(code, kind="stable")
        code = code[order]
        new = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        values = np.add.reduceat(np.take(values, order, axis=0).astype(np.float64), new)
        return pa.Table.from_arrays(
            [*[rows.column(c).slice(0, 1) for c in SUMS_NAMES[:2]], _binary(code[new], [0, len(new)]),
             _binary(values, [0, len(new)])], SUMS_NAMES)

    return sums.groupBy("part", "shared").applyInArrow(run, SUMS)


def _maximized(sums: DataFrame, states: int, spread: float) -> DataFrame:
    """(part, word, e) from the sums of words that are not shared."""
    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                part, code, values = (batch.column(c).slice(row, 1) for c in ("part", "code", "s"))
                words = _bytes(code).view(np.int64)
                values = _bytes(values).view(np.float64).reshape(-1, states)
                n = values.sum(1, keepdims=True)  # a token's states have probabilities that add up to 1
                yield _packed(pa.array(np.full(len(words), part[0].as_py(), np.int32)), pa.array(words), values + (n + 1) * spread)

    return sums.where("NOT shared").mapInArrow(run, EMISSIONS)


def train(prepared: DataFrame, counts: DataFrame, vocab: Vocabulary, scratch: Scratch,
          states: int = STATES, iterations: int = ITERATIONS, tolerance: float = TOLERANCE):
    """Parameters, the table of emissions, and the training log-likelihood before each pass."""
    history = []
    emissions = scratch.keep(first_emissions(counts, vocab, states), "emissions")
    parameters = initial(vocab, emissions, states)
    symbols = vocab.other + 1 + emissions.count()
    occurrences = np.append(vocab.counts, vocab.other_tokens)
    spread = PRIOR / (vocab.tokens + symbols)
    for _ in range(iterations):
        turns = [prepared.where(F.col("turn") == k) for k in range(ROUNDS)]
        parts = [scratch.keep(_expectations(turn, emissions, parameters, vocab.parts), "part") for turn in turns]
        sums = scratch.keep(_added(reduce(DataFrame.unionAll, parts), np.float64), "sums")
        scratch.drop(*parts)
        found = sums.where("shared").toArrow()
        if not found.num_rows:
            scratch.drop(sums)
            break
        symbol = _bytes(found.column("code")).view(np.int64)
        values = _bytes(found.column("s")).view(np.float64).reshape(-1, states)
        history.append(float(values[symbol == -2 - states].sum(0)[0]))
        start = values[symbol == -1 - states].sum(0) + 1
        moves = 1 + np.stack([values[symbol == -1 - k].sum(0) for k in range(states)])
        emit = np.repeat((occurrences + 1)[:, None] * spread, states, 1)
        emit[symbol[symbol >= 0]] += values[symbol >= 0]
        new = scratch.keep(_maximized(sums, states, spread), "emissions")
        scratch.drop(emissions, sums)
        emissions = new
        parameters = _with_total(start / start.sum(), moves / moves.sum(1, keepdims=True), emit, emissions)
        if len(history) > 1 and history[-1] - history[-2] < tolerance * abs(history[-2]):
            break
    return parameters, emissions, history


def score(prepared: DataFrame, emissions: DataFrame, parameters: Parameters, tokens: int) -> DataFrame:
    """One row per text: token sums, unigram score and model score, both log10."""
    shared = prepared.sparkSession.sparkContext.broadcast(parameters)

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        model = _model(known, shared.value)
        symbols, offsets = _symbols(texts.column("symbols"))
        scores = log_likelihood(symbols, offsets, model) / np.log(10) + texts.column("rest").to_numpy()
        return pa.Table.from_arrays(
            [*[texts.column(c) for c in SCORED_NAMES[:4]], pa.array(np.full(len(texts), tokens, np.int64)),
             texts.column("base"), pa.array(scores)], SCORED_NAMES)

    texts = prepared.where("symbols IS NOT NULL").select("chunk", *SCORED_NAMES[:4], "base", "rest", "symbols")
    known = chunk_words(prepared, emissions).drop("turn")
    return texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, SCORED)


SCORED = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
SCORED_NAMES = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def score_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", folds: int = 10,
                    held_fold: int = 0, states: int = STATES, iterations: int = ITERATIONS,
                    lookup: int = LOOKUP, chunk: int = CHUNK) -> DataFrame:
    """Score all texts with a model learned from those outside the held-out fold."""
    scratch = Scratch(docs.sparkSession, "markov")
    frame = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
                        F.coalesce(crc_mod(id_column, folds) == held_fold, F.lit(False)).alias("held_out"))
    counts = scratch.keep(token_counts(frame.where("NOT held_out")), "counts")
    vocab = vocabulary(counts, lookup)
    encoded = scratch.keep(encode(frame, vocab, chunk), "encoded")
    known = scratch.keep(counted_words(encoded, counts, vocab), "known")
    parts = [scratch.keep(prepare(encoded.where(F.col("turn") == k), counts, vocab, known.where(F.col("turn") == k)), "prepared")
             for k in range(ROUNDS)]
    prepared = reduce(DataFrame.unionAll, parts)
    scratch.drop(encoded, known)
    parameters, emissions, _ = train(prepared, counts, vocab, scratch, states, iterations)
    turns = [prepared.where(F.col("turn") == k) for k in range(ROUNDS)]
    scores = [scratch.keep(score(turn, emissions, parameters, vocab.tokens), "scores") for turn in turns]
    result = reduce(DataFrame.unionAll, scores)
    scratch.drop_all_but(*scores)
    return result.withColumnRenamed("id", id_column)
