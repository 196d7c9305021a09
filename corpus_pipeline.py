"""A corpus pipeline over the operators of ``eventloom.llm``: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import stages
from eventloom.llm.common import store, table

STAGES = stages.STAGES
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
