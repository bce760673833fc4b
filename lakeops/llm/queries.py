"""Each operator over its whole table, under the keys of the driver, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import decontam, lines, minhash, mixing, pieces, pii, quality, repair, secrets, sharding, topk, toxicity, whitening
from lakeops.session import written_out

SHARDS = 8
TOP = 20
#: A fixed key, so that reruns agree; a user passes one of their own and keeps it secret.
PII_KEY = "demonstration key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    found = topk.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors, TOP, "vec_id", "embedding", 64.0)
    return found.withColumnRenamed("id", "vec_id")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pii.pseudonymised(docs, PII_KEY)
    return done.select("doc_id", F.size("entities").cast("long").alias("n_entities"), F.array_join("entities", ",").alias("kinds"), "text")


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(_table(spark, sf_dir, "documents"), SHARDS)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1")
    return quality.classify(_table(spark, sf_dir, "documents"), trusted)


def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.without_repeated_runs(docs).select("doc_id", "removed_lines", "text")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    values, words = secrets.labelled_samples(docs.withColumn("base", secrets.base_spans(F.coalesce("text", F.lit("")))), "text")
    words = written_out(secrets.counted(words))
    held = secrets.held_out(F.col("value"))
    model = secrets.train(values, words.where(~held))
    found = secrets.scan(docs, model, ordinary=secrets.calibrated(model, words.where(held)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(repair.damage(_table(spark, sf_dir, "conversations")), "present")


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.encoded(_table(spark, sf_dir, "documents"), model, decode=True)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_jump_shards": op3_jump_shards,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_toxicity": op5_toxicity,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_line_chunks": op7_line_chunks,
    "op8_secret_scan": op8_secret_scan,
    "op9_mix_sources": op9_mix_sources,
    "op10_latent_leaks": op10_latent_leaks,
    "op11_whitening": op11_whitening,
    "op12_repair": op12_repair,
    "op13_pieces": op13_pieces,
}
