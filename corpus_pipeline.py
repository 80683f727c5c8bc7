"""From raw documents to packed training sequences.

Each stage works on all that its predecessor kept, and its result is written before the next one
starts: a lost executor repeats tasks of one stage. The tables read besides the documents are
those of ``sf_dir``. What each stage does with nulls, blank and very long texts, repeated rows, empty
tables and further columns stands with its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triagelake.llm.common import table
from triagelake.llm.decontaminate import decontaminate
from triagelake.llm.langid import keep_known, training_rows
from triagelake.llm.packing import pack
from triagelake.llm.pii import mask
from triagelake.llm.simhash import keep_one
from triagelake.session import materialise


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject."""
    return keep_known(docs, training_rows())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark; texts that are mostly such passages go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    return mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return pack(docs)


STAGES = [
    ("language_id", known_language),
    ("simhash_dedup", near_duplicates),
    ("decontamination", without_test_items),
    ("pii", without_personal_data),
    ("packing", packed),
]
#: Fingerprints, character models and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
