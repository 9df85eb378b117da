"""From raw documents to training sequences, in five stages of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back for
the next one. All but the last return the columns of the documents, whatever columns they have.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgrid.llm import decontamination, jaccard, language, packing, pseudonyms
from skillgrid.llm.common import free_name, materialize, ship_package

PSEUDONYM_KEY = "corpus pipeline"
WORDS, PERCENT = 5, 80  # of near duplicates; op6's own values hold for its query alone


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars``, where documents have it, of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels teach: those without letters or far from all go."""
    ship_package(spark)
    name = free_name(docs, "_found")
    found = language.detect(docs, language.fit(docs), result=name)
    return found.where(~F.col(f"{name}.rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; documents without an id stay.

    Of rows that repeat an id and a text one stays.
    """
    ship_package(spark)
    found = jaccard.near_duplicates(docs, words=WORDS, percent=PERCENT).where("doc_id is not null")
    found = materialize(found.groupBy("doc_id").agg(F.count_if(F.expr("doc_id = component_id")).alias("rows")), "kept")
    ids = lambda rule: jaccard.checked_broadcast(found.where(rule).select("doc_id"))
    # Those that go are fewer than those that stay: as long as they can be broadcast, no text is shuffled.
    once = docs.join(ids("rows <> 1"), "doc_id", "left_anti")
    repeated = docs.join(ids("rows > 1"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    out = once.unionByName(repeated)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that mostly consist of them go."""
    ship_package(spark)
    return _measured(decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms."""
    ship_package(spark)
    name = free_name(docs, "_found")
    found = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, result=name)
    text = F.coalesce(F.col(f"{name}.text"), F.col("text")).alias("text")
    return _measured(found.select(*[text if c == "text" else F.col(f"`{c}`") for c in docs.columns]))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", known_language),
    ("near duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("packing", sequences),
]

# Centroids and cutting-stock patterns are beyond SQL; tests/llm compares with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
