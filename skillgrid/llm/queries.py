"""Registered queries of the corpus operators, one per operator, over whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import checks, decontamination, hilbert, jaccard, language, licenses, merkle, packing, pieces, pseudonyms, token_counts, toxicity, trie, url_templates
from .common import crc_bucket, ship_package

# Of the registered query; a user of the operator passes a key of their own.
PSEUDONYM_KEY = "registered query"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_language_centroids")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 5) == 0
    model = language.fit(docs, allowed=~held_out)
    found = language.detect(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out.alias("held_out"), F.col("_lang.lang").alias("lang_pred"), "_lang.score", "_lang.rejected"
    )


@query("op2_toxicity_ngrams")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_bucket("doc_id", 4) == 2
    model = toxicity.fit(docs, labels.select("doc_id", "toxic"), allowed=~held_out)
    found = toxicity.score(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("_toxic").alias("score"),
        (F.col("_toxic") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op3_license_templates", checks.licenses_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query("op4_url_templates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge_urls(table(spark, sf_dir, "pages"))


@query("op5_cutting_stock_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_ngram_jaccard_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_feistel_pseudonyms")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.report(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@query("op8_hilbert_neighbours")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op9_suffix_automaton_decontamination", checks.decontamination_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op11_merkle_manifest", checks.merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower).otherwise(F.col("text"))}
    found = merkle.manifest(table(spark, sf_dir, "documents"), variants={"given": tampered})
    found = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), merkle.folded(F.col("given"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op12_sentencepiece_round_trip")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.decoded(pieces.encoded(table(spark, sf_dir, "documents"), model), model)
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query("op13_conversation_trie", checks.trie_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.shared_turns(table(spark, sf_dir, "conversations"), group=20, most=3))
