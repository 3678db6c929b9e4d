"""Corpus pipeline: the stages of STAGES in order, over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept
and returns a DataFrame; its decisions take effect. All but the last return
the columns of their input, whatever they are, in the same order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import exact_dedup, simhash
from shelfwise.llm.decontam import decontaminate
from shelfwise.llm.language_id import UNKNOWN, identify, learn
from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.queries import fold
from shelfwise.llm.tables import documents, table, written

#: A document stays if this share of its letters is in learned languages.
MIN_LANGUAGE_SHARE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those with less than
    MIN_LANGUAGE_SHARE of their letters in words of learned languages'
    scripts. However many learned languages share a document, it stays.
    Learned from the labelled documents of folds 1 to 4 of 5."""
    found = identify(docs, learn(docs.where(fold(5) != 0)), carry=docs.columns)
    clear = (F.col("lang_pred") != UNKNOWN) & (F.col("known") >= MIN_LANGUAGE_SHARE)
    return found.where(clear).select("carried.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (3-word shingles, at
    most 3 differing bits): one with the smallest id."""
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word inside an occurring benchmark window go."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=docs.columns)
    return found.where(F.size("items") == 0).select("carried.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds size, source_size, target and taken to every document; of an
    input column of the same name the added one stays."""
    mixed = mix_sources(docs, carry=docs.columns)
    new = ["size", "source_size", "target", "taken"]
    return mixed.select(*[F.col(f"carried.`{c}`").alias(c) for c in docs.columns if c not in new], *new)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix),
]

#: Fingerprints, components and the learned language model are not
#: expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's result is written
    to the shared folder and read again as the next one's input."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
