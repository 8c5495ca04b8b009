"""A training corpus from raw documents, in five stages; each is stored before the next one reads it."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettera.llm import byte_bpe, jaccard, language, mixture, pseudonyms
from lettera.llm.common import documents, stored
from lettera.llm.queries import DEMO_KEY, RANKS


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are too far from every language go; a missing lang is filled in."""
    d = language.identify(docs).filter(~F.col("lang_rejected"))
    return d.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return jaccard.keep_one(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by pseudonyms of the same format; n_chars follows the new text."""
    d = pseudonyms.pseudonymize(docs, DEMO_KEY)
    return d.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixture.take(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, tokens, and the text that they decode to."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path(RANKS))
    d = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return d.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                    F.decode(byte_bpe.decode(F.col("ids"), ranks), "UTF-8").alias("text"))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("personal_data", replace_personal_data),
    ("mixture", mix_sources),
    ("tokens", encode_texts),
]

#: Fits, MinHash, keyed permutations and merges are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of `sf_dir`."""
    d = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        d = stored(stage(spark, d, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, d, sf_dir)
