"""Documents to training tokens: each stage is written, reread and handed to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldbalance.llm import decontaminate, mixing, ngram_join, tokens, toxicity
from fieldbalance.llm.common import stored, table
from fieldbalance.session import new_shared_path


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.accepted(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.first_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), least_words=1)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "pipeline-tokens")
    tokens.write_tokens(docs, path, tokens.public_vocabulary())
    return tokens.read_tokens(spark, path)


STAGES = [("toxicity", not_toxic), ("ngram_join", one_of_each), ("decontamination", decontaminated),
          ("mixing", mixed), ("tokens", tokenized)]

#: A trained model and a tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
