"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typeferry.llm import (
    codes,
    decontam,
    divergence,
    language,
    licenses,
    multiindex,
    packing,
    pii,
    quality,
    shards,
    simhash,
    toxicity,
    warc,
)
from typeferry.llm.common import bucket, checkpointed, fresh_folder, read
from typeferry.llm.files import remove_folder
from typeferry.llm.tokens import public_path


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=3)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_multiindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = multiindex.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.95)
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    scorer, _ = toxicity.learn(docs, read(spark, sf_dir, "labels"), ~held_out)
    rows = docs.select(
        "doc_id", held_out.alias("held_out"), toxicity.scores(docs, scorer).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "shards")
    path = public_path("word_bpe_49k.json")
    shards.write_shards(read(spark, sf_dir, "documents"), folder, path, end_id=2)
    rows = checkpointed(shards.read_shards(spark, folder))
    remove_folder(spark, folder)
    return rows


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), folder, least_bytes=0)
    rows = checkpointed(warc.read_archives(spark, folder, with_payload=False))
    remove_folder(spark, folder)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(
        read(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"), end_id=1
    )
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    model = language.learn(docs, ~held_out)
    found = docs.select(
        "doc_id", held_out.alias("held_out"), language.mixtures(docs, model).alias("found")
    )
    return found.select(
        "doc_id",
        "held_out",
        F.coalesce("found.lang", F.lit("und")).alias("lang_pred"),
        F.col("found.share").alias("score"),
        F.col("found.other").alias("other"),
        F.transform("found.mix", lambda m: m["lang"]).alias("languages"),
    )


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.finds(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    held_out = F.coalesce(bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    classifier = quality.learn(docs, read(spark, sf_dir, "labels"), ~held_out)
    rows = quality.scores(docs, classifier, host="source", path="lang")
    return rows.select(
        "doc_id",
        F.coalesce(bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.LEAST).cast("int").alias("predicted"),
        "text_score",
        "host_rate",
        "path_rate",
    )


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = codes.codes(read(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    return codes.with_label_errors(rows).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = divergence.audit(read(spark, sf_dir, "documents"), least=3, top=200)
    return found.select("lang", "source", "part", "item", "value", "rank")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_multiindex": op2_multiindex,
    "op3_toxicity": op3_toxicity,
    "op4_shards": op4_shards,
    "op5_warc": op5_warc,
    "op6_licenses": op6_licenses,
    "op7_packing": op7_packing,
    "op8_language": op8_language,
    "op9_decontam": op9_decontam,
    "op10_quality": op10_quality,
    "op11_codes": op11_codes,
    "op12_divergence": op12_divergence,
    "op13_pii": op13_pii,
}

ORACLES: dict[str, str] = {
    "op2_multiindex": multiindex.oracle(),
    "op5_warc": warc.oracle(),
    "op6_licenses": licenses.oracle(),
    "op11_codes": codes.oracle(),
    "op12_divergence": divergence.oracle(),
}
