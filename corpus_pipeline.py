"""The corpus pipeline: five stages, each over all that the one before it kept.

Stages take ``(spark, docs, sf_dir)`` and return the columns of ``documents``, but for the last, which returns
the packed pieces. Null, empty and very long texts, null or repeated ids, ties, extra columns and empty
tables are treated as the stages' operators say; a stage changes no row that it keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, langid, packing, simhash, toxicity
from shelfwise.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read as none of the learned languages go (null text, no letter, letters that are unknown even
    in pairs); where no row names a language, nothing can be learned and all stay."""
    return langid.recognised(docs, langid.train(docs.select("doc_id", "text", "lang")))


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts as toxic go."""
    told = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return told.filter(F.col(told.columns[-1]) == 0).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest as pieces of training sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("toxicity", harmless),
    ("simhash_near_duplicates", near_duplicates),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: No stage but decontamination can be said in SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
