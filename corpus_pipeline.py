"""A corpus from raw documents to shards: each stage is written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontamination, jaccard, mixing, quality, sharding
from corpusmill.llm.common import stash, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1. Documents that the classifier rejects go; a score at its threshold stays.

    Null and empty texts are judged as texts without words, repeated rows alike. All columns
    pass unchanged, whatever their names; no rows give no rows.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), "text")
    return quality.score(rows, model).where("predicted = 1").select("row.*")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7. One document of each class of exact and near copies stays, that with the least doc_id.

    Null and empty texts are copies of each other, as are repeated rows. Documents without
    an id stay only where their class has no id. All columns pass unchanged, whatever their
    names; no rows give no rows.
    """
    return jaccard.keep_one(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9. Documents of which a twentieth of the words or more is hit go, the others stay as they are.

    Null and empty texts have no words and stay; repeated rows are judged each. All columns
    pass unchanged, whatever their names; no rows, or no items, change nothing.
    """
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8. Documents are taken once, repeatedly or not at all.

    A null source is a source, a null text has no words and costs nothing; repeated rows are
    documents of their own. All columns pass unchanged, whatever their names; no rows give no
    rows.
    """
    return mixing.mixed_documents(docs)


def sharded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2. Shard and slot of each document of the mix.

    Documents with the same id, or without one, share a shard and have slots of their own; a
    null text has size 1. Other columns are not returned; no rows give no rows.
    """
    return sharding.shard_documents(docs)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("mixing", mixed_documents),
    ("sharding", sharded_documents),
]

#: The first stage trains a network, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
    return docs
