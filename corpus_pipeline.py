"""Training-corpus pipeline over ``documents``: toxicity, near-duplicates,
benchmark decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that the stage before has kept. Null and empty texts, texts of any length and
repeated rows go through as the operators define; an empty table gives an
empty result; extra columns of ``documents`` pass through to the last stage. All but the last return the columns of
``documents``; the last returns one row per document and epoch taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recfold.llm import decontaminate, mixing, pii, simhash, toxicity
from recfold.llm.common import materialize, release_shared


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not reject."""
    return toxicity.reject(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 4-word shingles, at most 4 differing bits."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), remove="documents")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    return pii.replace_all(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents and epochs that fill the hierarchical token budgets."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii_surrogates", replace_personal_data),
    ("source_mixing", mix_sources),
]

#: The classifier and the surrogates have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
            release_shared()  # the stage's models and sets are no longer needed
    return docs
