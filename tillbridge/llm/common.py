"""What the operators share: tables, scratch folders, and word hashing on Arrow buffers."""

from __future__ import annotations

import uuid
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbridge.session import drop_folder, shared_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SLICE_BYTES = 1 << 20  # text bytes handled at once by the numpy kernels
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SEPARATOR = np.ones(256, bool)  # all of ASCII but letters and digits
_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables in the shared folder that cut lineage and survive lost executors.

    ``keep`` writes a frame and returns one that reads it back; ``drop`` deletes what was
    written so far, but for the frames named. ``settings`` hold while a frame is written.
    """

    def __init__(self, spark: SparkSession, label: str, settings: dict[str, str] | None = None):
        self.spark, self.root = spark, f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self.settings = {CLEANUP: "true", **(settings or {})}  # the table stands in for the shuffles behind it
        self.folders: dict[int, str] = {}
        self.frames: list[DataFrame] = []

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        folder = self.folder(name)
        before = {key: self.spark.conf.get(key, None) for key in self.settings}
        for key, value in self.settings.items():
            self.spark.conf.set(key, value)
        try:
            frame.write.parquet(folder)
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)
        kept = self.spark.read.schema(frame.schema).parquet(folder)
        self.folders[id(kept)] = folder
        self.frames.append(kept)  # the ids stay unique while the frames live
        return kept

    def drop_all_but(self, *frames: DataFrame) -> None:
        """Delete every table of this scratch folder, but for those the frames named read."""
        kept = {id(f) for f in frames}
        for folder in [self.folders.pop(k) for k in list(self.folders) if k not in kept]:
            drop_folder(self.spark, folder)

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            folder = self.folders.pop(id(frame), None)
            if folder:
                drop_folder(self.spark, folder)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER)) | np.uint64(1)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table_of(base):
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return table_of(_MULTIPLIER), table_of(_INVERSE)


def slices(texts: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES, lower: bool = False):
    """(first row, array) parts of about ``most`` bytes; a longer text is a part of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        part = texts.slice(at, to - at)
        yield at, pc.utf8_lower(part) if lower else part
        at = to


def word_hashes(texts: pa.Array, punctuation: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a large_string array, and each text's offsets into them.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; without
    ``punctuation`` all ASCII characters but letters and digits separate words.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    word = ~(_SPACE if punctuation else _SEPARATOR)[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # parts that end with a word, so that the power tables stay small
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + 2 * SLICE_BYTES)))
        s, e = starts[at:to], ends[at:to]
        part = data[s[0]:e[-1] + 1]
        size = 1 << max(16, int(len(part) - 1).bit_length())
        powers, inverses = _powers(size)
        terms = _BYTE[_LOWER[part]] * powers[:len(part)]
        sums = np.cumsum(terms)
        s, e = s - s[0], e - s[0]
        hashes[at:to] = mix((sums[e] - sums[s] + terms[s]) * inverses[s] + (e - s).astype(np.uint64))
        at = to
    return hashes, np.searchsorted(starts, offsets)


def ngrams(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words within each text, and the offsets of each text's runs."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    if len(words) < size:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    rolled = words[:len(words) - size + 1].copy()
    for k in range(1, size):
        rolled = rolled * np.uint64(_MULTIPLIER) + words[k:len(words) - size + 1 + k]
    ends = np.concatenate([[0], np.cumsum(counts)])
    places = np.repeat(offsets[:-1] - ends[:-1], counts) + np.arange(ends[-1])
    return mix(rolled[places]), ends


def crc_mod(column, modulus: int):
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % modulus
