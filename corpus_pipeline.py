"""Corpus pipeline: toxic and poor documents go, then exact copies, then near copies; what stays is packed.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns the rows that stay with the
columns of documents; the last one returns the packed pieces. Between stages the rows are written as Parquet and read
again, so a lost executor costs no more than the stage in hand. What a stage wrote is deleted when the next one is written.

Defined results, of the stages and of the whole: null text counts as empty; a null id is kept like any other row, never
labelled, and stays of a group only if no other row of it has an id; of repeated rows one stays; without labels of both
classes the first stage keeps all rows unless the labels that there are call most texts toxic, the second unless they call
most texts poor; an empty table gives no rows; columns of documents beyond id and text, whatever their names, are carried
along to the last stage and never looked at.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fringelake.llm import exact_dedup, packing, quality_model, simhash, toxicity
from fringelake.llm.common import remove_folder, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(spark, docs, sf_dir)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.drop_poor(spark, docs, sf_dir)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("best-fit packing", pack),
]

#: Compression lengths, a trained network and a tokenizer are not SQL; run() is tested against the queries' verdicts, the least
#: ids of equal texts and brute-force links of fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage keeps is written to the shared checkpoint folder."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            remove_folder(spark, f"{folder}/{number - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
