"""From raw documents to packed training sequences, in five stages.

Each stage gets the rows that the one before has kept, all columns, and reads them as often as it
needs; only the last returns rows of another form. Operators state what becomes of nulls, empty
texts, repeated rows and empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import minmax, mixing, packing, quality, repeats
from tidemark.llm.queries import MIX
from tidemark.session import materialize


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.learnt(docs, labels))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, 0.8 or more alike."""
    return minmax.one_of_each(docs, width=5, percent=80)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 300 bytes or more (about fifty words) that also stand elsewhere are cut out."""
    return repeats.without_repeats(docs, length=300)


def balanced(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by temperature; a document may come more than once, or not at all."""
    return mixing.remixed(docs, **MIX)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good),
    ("near-duplicates", distinct),
    ("repeated passages", unrepeated),
    ("source mixing", balanced),
    ("packing", sequences),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
