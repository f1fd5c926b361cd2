"""A training-corpus pipeline: each stage calls one operator of ``cardsentry.llm``.

Stages run in order over what their predecessor kept; every stage's result is
written as Parquet and read again.  All but the last return the columns of
``documents``.

1. toxicity: train on the labelled documents, drop those predicted toxic.
2. near_duplicates: one document of every class of near copies stays.
3. decontamination: documents contaminated by the benchmark go.
4. secrets: found secrets are replaced by a mark, ``n_chars`` follows.
5. mixing: documents with the words that the mix takes of them; those of which it
   takes none go.

Defined cases are those of the operators; a stage on an empty table returns an
empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm import op2_toxicity, op3_mixing, op5_jaccard, op6_secrets, op9_decontamination
from cardsentry.llm.common import checkpoint_root, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = op2_toxicity.score(docs, op2_toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.filter(F.col("score") < op2_toxicity.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        .select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_mixing.mix(docs).filter(F.col("taken") > 0)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("mixing", mixing)]

#: SQL cannot express the trained stage; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared checkpoint folder."""
    folder = f"{checkpoint_root(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
