"""A corpus made ready for training: four stages over ``documents``, each written and read again.

Language ID drops what it can't identify, the quality classifier what it rates as bad, SimHash keeps
one document of each group of near-duplicates, and best-fit packing lays the rest out in sequences.

All stages but the last return rows as they are, with the columns of the table they are given; columns may
bear any names beside doc_id, text and, for the first, lang. What odd rows become:

* language ID: NULL texts and texts without a letter go; rows with NULL lang are judged but not learned from;
  without any labelled row nothing can be identified, and all rows go;
* quality classifier: every text has a score, the empty one too; rows without doc_id or label are judged alike;
  without labels all rows stay;
* SimHash near-dedup: of rows equal in doc_id and text one stays, of a group the one with the smallest doc_id;
  copies without doc_id become one; unrelated texts under one doc_id both stay;
* best-fit packing: each remaining row becomes one or more pieces, a NULL or empty text its end token alone.

An empty table gives an empty result at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from galewright.llm import language_id, packing, quality, simhash
from galewright.llm.catalog import BYTE_BPE, SEQUENCE
from galewright.llm.frames import materialize, table

#: No SQL can express the trained models and the packing; the tests hold the stages against brute force.
ORACLE_SQL = None


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.fit(docs))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, BYTE_BPE, SEQUENCE)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language ID", identified),
    ("quality classifier", good),
    ("SimHash near-dedup", distinct),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
