"""A training corpus from raw documents: five stages, each written as Parquet and read by the next.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame of documents, the last
one with copies: how often a training run repeats a document.

In all stages: rows of a null id and null, empty or blank texts stay, unless a stage says otherwise; other columns ride
along, whatever their names; empty tables give empty results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landloom.llm.common import save, table
from landloom.llm.decontam import drop_contaminated
from landloom.llm.lines import dedup_documents
from landloom.llm.minhash import keep_one
from landloom.llm.mixing import mix_documents
from landloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; rows that repeat an id are judged one by one. Without labels of both classes
    all stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go, and documents of which nothing is left. Rows that repeat an id are one
    document."""
    return dedup_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id; rows of one id are one document and
    go or stay together, a text that only such a row has among them."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go; rows of one id go or stay together, rows of a null id are judged one by
    one. Items of fewer than 5 tokens are ignored."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; rows that the mix does not take go, those without words among them
    where their source is not repeated whole. A null source is one of its own; rows that are alike in id, source and
    text share evenly what is taken of them."""
    return mix_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Learning can't be said in SQL; tests/llm compares each stage with a plain version (toxicity: the scores of its short
#: texts).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
