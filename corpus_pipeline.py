"""From raw documents to token digests, in stages that are written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from plantmart.llm import line_dedup, mixing, near_copies, quality_rules
from plantmart.llm.queries import token_digests
from plantmart.session import shared_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filtered(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are cut out of the texts."""
    return line_dedup.cleaned(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: SimHash links verified by the similarity of five-word
    shingles, 0.8 or more, and the pairs with that similarity whose fingerprints are further apart."""
    return near_copies.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the slot and the place in it that the mix of their sources gives them."""
    return mixing.placed(docs, mixing.tempered(docs))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, digests of the tokens and of the decoded bytes, slot and place of each document."""
    return token_digests(docs, carried=("slot", "place"))


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", keep_one_of_near_copies),
    ("source mix", mix_sources),
    ("byte-level BPE", encode_tokens),
]

# Language references, 64-bit fingerprints and merge replay are beyond SQL; tests compare the stages and the
# whole with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the table documents; each reads what its predecessor has written.

    Rows come in the order of the mix; the last stage's files also hold the slot and place that give it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs.orderBy("slot", "place").drop("slot", "place")
