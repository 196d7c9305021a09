"""The stages of the corpus pipeline, each one of the operators applied to all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import ship, table
from .jaccard import Join, keep_one
from .mixing import mix, take
from .packing import pack
from .quality import Rules, keep_good, train
from .queries import TOKENIZER
from .secret_scan import redact

NEAR = Join(words=5, percent=80)
"""What counts as a near copy in the pipeline: five-word shingles, at least 80 in 100 shared."""


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed limits and the trees accept; the trees are fitted on the labels of these documents."""
    return keep_good(docs, Rules(train(docs, table(spark, sf_dir, "labels"))))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs, NEAR)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets replaced."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target asks for."""
    return take(docs, mix(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full windows, with their ids."""
    return pack(docs, TOKENIZER)


def _shipped(stage):
    return lambda spark, docs, sf_dir: stage(ship(spark), docs, sf_dir)


STAGES = [(f.__name__, _shipped(f)) for f in (quality_rules, near_copies, secrets, mixing, packing)]
