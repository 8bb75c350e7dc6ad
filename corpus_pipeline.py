"""A training corpus from raw documents: five stages, each written and read again.

Toxic documents go, then documents of boilerplate, then near-duplicates but one of each
group; what stays is mixed to the sources' target weights and encoded.

Every stage takes the columns of ``documents``, whatever others there are, and all but the last return
the columns they were given. Null texts, ids and sources, empty tables and repeated
rows have the results that the modules of the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm import bpe, mixing, quality_lines, setsketch, toxicity
from tallyroom.llm.common import table, written
from tallyroom.llm.queries import is_remainder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"),
                           usable=~is_remainder("doc_id", 4, 2))
    return toxicity.drop_toxic(docs, model)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the measures and hold enough content lines."""
    model = quality_lines.train_lines(docs, table(spark, sf_dir, "labels"))
    return quality_lines.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return setsketch.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate says."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per emitted document: doc_id, n_tokens, ids_sha256, decoded_sha256, token_ids."""
    tokens = bpe.round_trip(docs)
    return tokens.select(F.col("id").alias("doc_id"), "n_tokens",
                         F.sha2("token_ids", 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"), "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode_tokens),
]

#: Dictionaries, line models, sketches and merges are nothing SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
