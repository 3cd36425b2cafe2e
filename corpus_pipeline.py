"""From raw documents to packed training sequences: five stages, each one operator over all its predecessor kept.

In every stage null and empty texts count as texts without words: the network gives them the score of its bias alone, no
text is near them, they hold no personal data, the mix never takes them. Repeated rows are rows like others until one
of each group of copies stays; ties go to the smaller doc_id, null last. Empty tables give empty tables; extra columns,
whatever their names, pass all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import jaccard, mixing, packing, pii, toxicity
from panelkit.llm.common import table, written
from panelkit.llm.queries import tokenizer_path


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    out = pii.mask(docs, pii.fit(docs))
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of the sources takes them."""
    return mixing.repeat(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mix, packed into sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", clean), ("near_duplicates", distinct), ("pii", private), ("mixing", mixed), ("packing", packed)]

#: SQL can express neither the networks nor the tokenizer; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
