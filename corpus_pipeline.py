"""From raw documents to packed sequences: language, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns rows that the next one reads from Parquet.

Defined cases: texts that are null, or without a letter, have no known language and go in the first stage, however long
or short others are; nulls in other columns change nothing but that a null id never trains; a row that ties with another
(equal texts, equal ids, wholly equal rows) is judged like it by the first two stages, and of a group of near-duplicates
one row stays, whether ids repeat or are null; an empty table gives an empty result in each stage; extra columns pass
through, even if they have the names of results, until the last stage, which returns pieces.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language_id, packing, rule_ensemble, simhash
from millrace.llm.common import ensure_checkpoint_dir, fold, fresh, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; without a training text there is none."""
    learned = language_id.fit(language_id.training(docs, fold("doc_id", 5) == 0))
    names = fresh(docs, "lang_pred", "lang_score", "lang_accepted")
    return language_id.predict(docs, learned, names=names).where(F.col(names[2])).select(docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules take for good; without labels every score is 0.5 and all stay."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = rule_ensemble.fit(docs, labels, "quality")
    score = rule_ensemble.predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), model)
    return score.where("predicted = 1").select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, keep_unnamed=False)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 1024."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("language ID", known_language),
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("best-fit packing", packed),
]

#: SQL can't express compression, learned rules or bin packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before it keep is written to the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
