"""A training corpus from raw documents: five stages, each a DataFrame over all its predecessor kept.

Every stage but the last returns rows of documents with the columns they came with; the last
returns packed pieces. Stages are written as Parquet and read again, so a lost executor costs
one stage at most.

Stages bound the record batches that tasks exchange with Python by ``BATCH_BYTES``, as whole texts
pass. That is an option of the session and stays set; a smaller bound of the session's own holds.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbridge.llm import contamination, language, near_duplicates, packing, pii
from tillbridge.llm.common import Scratch, table

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 22


def bound_batches(spark: SparkSession) -> None:
    """Frames are planned when they are written, so the option outlives the stage that sets it."""
    number, unit = re.fullmatch(r"(-?\d+)([a-z]*)", spark.conf.get(BATCH).lower()).groups()
    bytes_ = int(number) << {"k": 10, "m": 20, "g": 30, "t": 40, "p": 50}.get(unit[:1], 0)
    if not 0 < bytes_ <= BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; null texts and texts without a letter go."""
    bound_batches(spark)
    return language.keep_identified(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the least id."""
    bound_batches(spark)
    return near_duplicates.keep_one(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    bound_batches(spark)
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows the text."""
    bound_batches(spark)
    masked = pii.clean(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token sequences, packed into windows; ids as their checksum."""
    bound_batches(spark)
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language", keep_identified),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("pii", mask_personal_data),
    ("packing", pack),
]
ORACLE_SQL = None  # alignment and tokenizing have no SQL form; tests compare with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    return docs
