"""Packing of tokenized texts into windows of fixed capacity, by minimum bin slack.

A text's tokens, and a final separator, are cut into full windows and a remainder. A task
collects remainders by length; a bitset subset-sum over the lengths at hand (each as often as
it is there) finds the multiset that comes closest to the capacity, backtracking gives the
count of each length, and the same multiset is taken as often as the counts allow. While more
texts follow, only exact fills are taken, unless they leave the pool full, as remainders of one
length would: then, and at the end of a task, the slack of the closest fill is closed by a cut
from one more remainder. The last tokens, less than one window, become sequences of descending
powers of two. So no sequence needs padding.

Tasks work on their own partitions: nothing is shuffled, and a task holds ``POOL`` tokens of
remainders, those of 256 texts more, and one record batch. Sequence ids are unique across tasks.

Null and empty texts consist of the separator alone. Ids may be null or repeated; each row is
a text of its own. Text that spells a special token gets that token's id, as the tokenizer does.
"""

from __future__ import annotations

import json
import os
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
SEPARATOR = 0
POOL = 1 << 22
# Fixed value: how the byte-level pre-tokenizer splits a text.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids as little-endian 32-bit bytes.

    Byte pairs of a plain byte-level vocabulary are merged by tiktoken, several times faster;
    ``tokenizers`` encodes texts that spell special tokens, and all texts for other vocabularies.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = byte_pairs(path, self.special)

    def encode(self, text: str) -> bytes:
        if self.merge is None or any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.merge(text)
        return np.array(ids, "<u4").tobytes()


def byte_pairs(path: str, special: list[str]):
    """Encoder of a byte-level vocabulary whose merges stand in the order of their ids, or None."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    splits = model["pre_tokenizer"] or {}
    if model["model"]["type"] != "BPE" or splits.get("type") != "ByteLevel" or splits.get("add_prefix_space") \
            or not splits.get("use_regex", True) or model["normalizer"]:
        return None
    import tiktoken

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    ids = model["model"]["vocab"]
    ranks = {bytes(byte[c] for c in token): n for token, n in ids.items() if token not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
    order = [ids["".join(m)] for m in merges]
    if order != sorted(order):
        return None
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take, for the largest sum that does not exceed the capacity."""
    mask, reach, layers = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        before, left, step = reach, min(counts[length], capacity // length), 1
        while left:  # any number up to the count, by parts of powers of two
            take = min(step, left)
            reach |= (reach << (take * length)) & mask
            left -= take
            step *= 2
        layers.append((length, before))
        if reach >> capacity:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(layers):
        many = 0
        while not before >> total & 1:
            total -= length
            many += 1
        if many:
            taken[length] = many
    return taken


class Pool:
    """Remainders by length; makes sequences of pieces (id, start, ids, document tokens)."""

    def __init__(self, capacity: int):
        self.capacity, self.tokens = capacity, 0
        self.by_length: dict[int, list] = defaultdict(list)

    def add(self, piece) -> None:
        length = len(piece[2]) // 4
        self.by_length[length].append(piece)
        self.tokens += length

    def take(self, length: int):
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            del self.by_length[length]
        self.tokens -= length
        return piece

    def fills(self):
        """Sequences without slack, until none is left."""
        while True:
            counts = {length: len(p) for length, p in self.by_length.items()}
            chosen = closest_fill(counts, self.capacity)
            if sum(length * n for length, n in chosen.items()) != self.capacity:
                return
            for _ in range(min(counts[length] // n for length, n in chosen.items())):
                yield [self.take(length) for length, n in chosen.items() for _ in range(n)]

    def cut(self, length: int):
        """A piece of this length from the start of the shortest remainder that is as long, or else of the longest."""
        enough = [x for x in self.by_length if x >= length]
        id_, start, ids, tokens = self.take(min(enough) if enough else max(self.by_length))
        if len(ids) > 4 * length:
            self.add((id_, start + length, ids[4 * length:], tokens))
        return id_, start, ids[:4 * length], tokens

    def down_to(self, most: int):
        """Sequences, the last slack of each closed by cuts, until ``most`` tokens are left."""
        yield from self.fills()
        while self.tokens > most:
            size = self.capacity if self.tokens >= self.capacity else 1 << (self.tokens.bit_length() - 1)
            counts = {length: len(p) for length, p in self.by_length.items()}
            sequence = [self.take(length) for length, n in closest_fill(counts, size).items() for _ in range(n)]
            slack = size - sum(len(p[2]) // 4 for p in sequence)
            while slack:
                sequence.append(self.cut(slack))
                slack -= len(sequence[-1][2]) // 4
            yield sequence


PIECES = ("start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long")
_NAMES = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, separator: int = SEPARATOR, pool_tokens: int = POOL) -> DataFrame:
    """One row per piece: id, start and length in its text's tokens, ids (little-endian unsigned
    32-bit), the text's number of tokens, its sequence and the offset there.
    """
    end = np.array([separator], "<u4").tobytes()

    def run(batches):
        encoder, pool = Encoder(tokenizer), Pool(capacity)
        sequence_id = TaskContext.get().partitionId() << 40

        def rows(sequences):
            nonlocal sequence_id
            columns = [[] for _ in range(7)]
            size = 0
            for sequence in sequences:
                offset = 0
                for id_, start, ids, tokens in sequence:
                    length = len(ids) // 4
                    for column, value in zip(columns, (id_, start, length, ids, tokens, sequence_id, offset)):
                        column.append(value)
                    offset += length
                size += offset
                sequence_id += 1
                if size > 1 << 20:
                    yield batch_of(columns)
                    columns, size = [[] for _ in range(7)], 0
            if columns[0]:
                yield batch_of(columns)

        def batch_of(columns):
            types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [id_column, *_NAMES])

        def full(id_, ids, tokens):
            for at in range(0, tokens - capacity + 1, capacity):
                yield [(id_, at, ids[4 * at:4 * (at + capacity)], tokens)]

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sequences = []
                for id_, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = encoder.encode(text.as_py() or "") + end
                    tokens = len(ids) // 4
                    sequences += full(id_, ids, tokens)
                    if tokens % capacity:
                        cut = tokens - tokens % capacity
                        pool.add((id_, cut, ids[4 * cut:], tokens))
                yield from rows(sequences)
                if pool.tokens > pool_tokens:
                    yield from rows(pool.fills())
                if pool.tokens > pool_tokens:
                    yield from rows(pool.down_to(pool_tokens // 2))
        yield from rows(pool.down_to(0))

    frame = docs.select(F.col(id_column).cast("long"), F.col(text).cast("string").alias("text"))
    return frame.mapInArrow(run, f"`{id_column}` long, {PIECES}")
