"""The stages of the corpus pipeline on a small corpus."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillbridge.llm import near_duplicates

pytest.importorskip("public_tokenizers")
pipeline = pytest.importorskip("corpus_pipeline")
WORDS = ["the", "and", "bado", "kare", "mi", "stone", "river", "lamp", "green", "under", "walks", "seven", "paper", "cloud"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    folder = str(tmp_path_factory.mktemp("corpus"))
    prose = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed"]) for _ in range(n))
    item = prose(30)
    texts = {n: prose(60) for n in range(20)}
    texts |= {20: texts[3], 21: texts[4].replace(" ", "  "), 22: prose(20) + " " + item + " " + prose(10), 23: None, 24: "", 25: "1 2 3",
              26: prose(30) + " write to ann@example.org or +1 (743) 555-3824"}
    rows = [(i, t, "en", "src", len(t or "")) for i, t in texts.items()] + [(5, texts[5], "en", "src", len(texts[5]))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, prose(20))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_every_stage_takes_effect(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, corpus).cache()
        assert docs.columns == columns
        kept[name] = sorted(r.doc_id for r in docs.collect())
    assert kept["language"] == sorted([*range(23), 5, 26])
    assert kept["near_duplicates"] == [*range(20), 22, 26]
    assert kept["decontamination"] == kept["pii"] == [*range(20), 26]
    masked = docs.where("doc_id = 26").first()
    assert masked.text.endswith("write to [EMAIL] or [PHONE]") and masked.n_chars == len(masked.text)
    pieces = pipeline.STAGES[-1][1](spark, docs, corpus)
    whole = pipeline.run(spark, corpus)
    assert whole.columns == pieces.columns
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    sums = [f.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).orderBy("doc_id").collect() for f in (pieces, whole)]
    assert sums[0] == sums[1] and all(r.n == r.m for r in sums[0]) and set(order) <= set(whole.columns)


def test_stages_take_empty_tables(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs, corpus).count() == 0, name


def test_stage_names_and_order():
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "pii", "packing"]
    assert near_duplicates.THRESHOLD == 0.8 and near_duplicates.WORDS == 5


def test_record_batches_are_bounded(spark):
    rows = spark.createDataFrame([(n, "the stone river " * 2000, "en") for n in range(400)], "doc_id long, text string, lang string").coalesce(1)
    before = spark.conf.get(pipeline.BATCH)

    def measured(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), pa.array([batch.nbytes])], ["n", "size"])

    try:
        spark.conf.set(pipeline.BATCH, "64m")
        kept = pipeline.keep_identified(spark, rows, "").mapInArrow(measured, "n long, size long").collect()
        assert sum(r.n for r in kept) == 400
        assert max(r.size for r in kept) <= pipeline.BATCH_BYTES + 100_000  # a batch ends with the row that passes the bound
        spark.conf.set(pipeline.BATCH, "1m")
        pipeline.keep_identified(spark, rows, "")
        assert spark.conf.get(pipeline.BATCH) == "1m"
    finally:
        spark.conf.set(pipeline.BATCH, before)
