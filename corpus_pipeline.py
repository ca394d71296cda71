"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rolescope.llm import toxicity
from rolescope.llm.base import documents, materialize
from rolescope.llm.exact_dedup import drop_exact
from rolescope.llm.mixing import mix
from rolescope.llm.ngram_join import drop_near
from rolescope.llm.packing import pack
from rolescope.llm.queries import TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    It learns from the labels that are not held out, and judges every row by its own text, whatever
    its id. NULL and empty texts stay.
    """
    return toxicity.drop_predicted(docs, toxicity.train(docs, documents(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (the smallest id, a row without id if none has).

    NULL is an empty text. Different texts that share an id stay each.
    """
    return drop_exact(docs, without_id=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by n-gram similarity (the smallest id, NULL last).

    Texts without a word are linked to nothing and stay; rows that share an id are told apart by
    their texts.
    """
    return drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes, in training order.

    Rows that share an id, or have none, take the copies of the first of them. The columns stay as
    they are, also one named ``position``.
    """
    return mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every copy with its sequence and its place there (see ``pack``)."""
    return pack(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Signatures, a learned classifier and a tokenizer are beyond SQL; tests hold the result against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
