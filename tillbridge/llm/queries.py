"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillbridge.llm.common import table
from tillbridge.llm.oracles import ORACLES  # noqa: F401


def op1_neighbours(spark, sf_dir):
    from tillbridge.llm import neighbours

    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_rows(rows, rows.where("vec_id % 50 = 0"))


def op2_secrets(spark, sf_dir):
    from tillbridge.llm import secrets

    return secrets.report(table(spark, sf_dir, "documents"))


def op3_url_filter(spark, sf_dir):
    from tillbridge.llm import urls

    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_warc(spark, sf_dir):
    from tillbridge.llm import warc

    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_packing(spark, sf_dir):
    import public_tokenizers

    from tillbridge.llm import packing

    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_pii(spark, sf_dir):
    from tillbridge.llm import pii

    return pii.report(table(spark, sf_dir, "documents"))


def op7_decontamination(spark, sf_dir):
    from tillbridge.llm import contamination

    return contamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_probminhash(spark, sf_dir):
    from tillbridge.llm import near_duplicates

    return near_duplicates.classes(table(spark, sf_dir, "documents")).withColumn(
        "is_kept", F.expr("doc_id <=> class_id AND digest = class_digest"))


def op9_language(spark, sf_dir):
    from tillbridge.llm import language

    return language.identify(table(spark, sf_dir, "documents"))


def op10_hmm_scores(spark, sf_dir):
    from tillbridge.llm import markov

    return markov.score_documents(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark, sf_dir):
    from tillbridge.llm import suffixes

    return suffixes.repeats(table(spark, sf_dir, "documents")).drop("spans")


def op12_spelling_variants(spark, sf_dir):
    from tillbridge.llm import spelling

    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark, sf_dir):
    from tillbridge.llm import filter_audit

    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_neighbours, op2_secrets, op3_url_filter, op4_warc, op5_packing, op6_pii, op7_decontamination, op8_probminhash,
    op9_language, op10_hmm_scores, op11_suffix_dedup, op12_spelling_variants, op13_filter_audit)}
