"""Training-data pipeline over ``documents``: each stage reads the Parquet
table its predecessor wrote, all but the last return the columns of
``documents``.

1. language ID: texts in no learned language go (null, no letter, or no word
   in a learned language's script);
2. exact dedup: one row of each group of equal texts stays;
3. SimHash near-dedup: one document of each component stays;
4. mixing: documents are repeated (or left out) to the target weights of
   their sources and shuffled globally;
5. SentencePiece encoding: the ids of every whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelweave.llm import exact_dedup, langid, mixing, pieces, simhash
from labelweave.llm.common import drop_stage, write_stage
from labelweave.session import read_table, ship_package

#: SQL expresses neither the Viterbi stages nor SimHash; tests hold run()
#: against a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)  # its pandas functions import the package
    return langid.drop_undetermined(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)  # its pandas functions import the package
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)  # its pandas functions import the package
    return pieces.encode_documents(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixture), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stages between are written under the
    shared checkpoint folder and deleted when their successor is written."""
    docs, path = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, new = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if path:
            drop_stage(spark, path)
        path = new
    return STAGES[-1][1](spark, docs, sf_dir)
