"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  A stage works
on all that its predecessor kept and its decisions take effect:

1. toxicity: documents scored 0.5 or more go;
2. exact dedup: of equal normalised texts the smallest doc_id stays;
3. SimHash near-dedup: of each component the smallest doc_id stays;
4. mixing: documents come as often, or as partly, as the mix takes them;
5. packing: sequences of at most 2048 tokens, one row per piece.

Null texts count as empty in every stage; rows keep extra columns up to the
last stage; an empty table gives empty results.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.llm import exact_dedup, mixing, packing, simhash, toxicity  # noqa: E402
from salesmart.llm.common import col, table, without  # noqa: E402
from salesmart.workspace import run_dir  # noqa: E402


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs)
    return without(docs, found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id"), "doc_id")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, block=MIX_BLOCK)
    # The length that documents carry is brought in line with cut texts.
    return mixed.withColumn("n_chars", F.length("text").cast("bigint")).select(*map(col, docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


#: Words that the mix takes together: long enough to be worth reading on their own.
MIX_BLOCK = 256

STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: A trained classifier, 64-bit hashes and random draws are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder, docs = run_dir(spark, "pipeline"), table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
