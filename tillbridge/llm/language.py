"""Language identification by rank-order profiles of character n-grams.

A language's profile is its most frequent n-grams of one to three letters, in order. A text
gets the same list of its own n-grams; its distance to a language sums, over the text's
n-grams, how many places each is from its rank in the profile, or the profile's length where
the profile lacks it. The nearest language wins, ties to the smaller name.

Texts are lower-cased; everything but letters separates words, and one blank stands at either
end of a word. Whole texts are counted. Null texts and texts without a letter are ``und`` with
score 0; so is every text if nothing could be learned. Training rows need a text with letters
and a language. Repeated rows count as often as they occur; ids may be null or repeated.

Profiles go to the tasks: ``PROFILE`` n-grams for each of at most ``MOST_LANGUAGES`` languages;
more languages are an error.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tillbridge.llm.common import crc_mod

PROFILE = 400
LEAST_SCORE = 0.2  # below, a text's n-grams hardly occur in any language learned
MOST_LANGUAGES = 2000
UNKNOWN = "und"
BLANK = 0x20
FLUSH = 1 << 16


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of a text's n-grams; a code holds up to three code points of 21 bits."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.where(letter, points, BLANK)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = np.concatenate([[BLANK], points[keep], [BLANK]])
    if points[1] == BLANK:  # cannot be: a kept blank follows a letter
        points = points[1:]
    if points[-2] == BLANK:
        points = points[:-1]
    two = (points[:-1] << 21) | points[1:]
    three = (two[:-1] << 21) | points[2:]
    middle = points[1:-1] != BLANK  # three letters, or two and a blank at one end
    codes = np.concatenate([points[points != BLANK], two, three[middle]])
    codes.sort()
    new = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[new], np.diff(np.append(new, len(codes)))


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, ties to the smaller code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = np.flatnonzero(counts >= least)
        codes, counts = codes[keep], counts[keep]
    return codes[np.argsort(-counts, kind="stable")][:size]


def _count_batches(batches):
    found: dict[str, list] = {}
    size = 0

    def flush():
        for language, parts in found.items():
            codes, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                ["lang", "gram", "n"])
        found.clear()

    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            codes, counts = gram_counts(text.as_py())
            if len(codes):
                found.setdefault(language, []).append((codes, counts))
                size += len(codes)
            if size > FLUSH * 8:
                for key, parts in found.items():
                    codes, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                    found[key] = [(codes, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64))]
                size = sum(len(p[0][0]) for p in found.values())
                if size > FLUSH * 4:
                    yield from flush()
                    size = 0
    yield from flush()


def learn(labelled: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Profiles from columns lang and text."""
    counts = (labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
              .mapInArrow(_count_batches, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    rows = best.select("lang", "place", "gram").limit(MOST_LANGUAGES * size + 1).toArrow()
    if rows.num_rows > MOST_LANGUAGES * size:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    profiles: dict[str, np.ndarray] = {}
    for language, place, gram in zip(*(rows.column(c).to_pylist() for c in ("lang", "place", "gram"))):
        profiles.setdefault(language, np.zeros(size, np.int64))[place - 1] = gram
    return {k: v[v != 0] for k, v in sorted(profiles.items())}


def predict(frame: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE, within: str | None = None) -> DataFrame:
    """The frame, whose column text_ is replaced by lang_pred and score.

    The score is 1 less the distance to the chosen profile over the largest possible one. With
    ``within`` the texts are that field of the only column, a struct, so no text is sent twice.
    """
    languages = list(profiles)
    grams = np.unique(np.concatenate([np.zeros(0, np.int64), *profiles.values()]))
    places = np.full((len(grams) + 1, max(1, len(languages))), -1, np.int32)
    for k, profile in enumerate(profiles.values()):
        places[np.searchsorted(grams, profile), k] = np.arange(len(profile))
    shared = frame.sparkSession.sparkContext.broadcast((languages, grams, places))
    others = [f for f in frame.schema.fields if f.name != "text_"]

    def run(batches):
        languages, grams, places = shared.value
        for batch in batches:
            predicted, scores = [], []
            for text in batch.column("text_") if within is None else batch.column(0).field(within):
                codes, counts = gram_counts(text.as_py()) if languages else ((), ())
                if not len(codes):
                    predicted.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                own = ranked(codes, counts, size)
                at = np.searchsorted(grams, own)
                at[(at == len(grams)) | (grams[np.minimum(at, len(grams) - 1)] != own)] = len(grams)
                place = places[at]
                apart = np.where(place < 0, size, np.abs(place - np.arange(len(own), dtype=np.int32)[:, None]))
                distance = apart.sum(0)
                best = int(distance.argmin())
                predicted.append(languages[best])
                scores.append(1 - float(distance[best]) / (size * len(own)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in others], pa.array(predicted, pa.string()), pa.array(scores, pa.float64())],
                [*[f.name for f in others], "lang_pred", "score"])

    return frame.mapInArrow(run, StructType([
        *others, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def identify(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
             folds: int = 4, held_fold: int = 2, size: int = PROFILE) -> DataFrame:
    """Predict all rows from profiles of the rows outside the held-out fold."""
    held = F.coalesce(crc_mod(id_column, folds) == held_fold, F.lit(False)).alias("held_out")
    profiles = learn(docs.where(~held).select(F.col(lang).alias("lang"), F.col(text).alias("text")), size)
    return predict(docs.select(F.col(id_column), held, F.col(text).alias("text_")), profiles, size)


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE,
                    least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of docs, with their own columns, whose language is told with at least this score.

    Profiles are learned from all rows that name a language. If none does, only texts without a
    letter go, as nothing can be told of the others.
    """
    profiles = learn(docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")), size)
    if not profiles:
        return docs.where(F.col(text).rlike(r"\p{L}"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    told = predict(row, profiles, size, text).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return told.select("row.*")

