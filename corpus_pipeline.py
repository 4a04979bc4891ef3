"""Corpus pipeline: toxicity, exact dedup, near duplicates, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes what a stage returns as Parquet to the shared folder and hands the next
one what it reads back.  All stages but the last return the columns of
``documents``.  The stages are not expressible in SQL (a learned grammar,
similarity links, seeded block selection, best-fit bins): ``ORACLE_SQL`` is
None and the tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from outcomekit.llm import content_sort, mixing, packing, parity_join, toxicity
from outcomekit.llm.common import table, written

STAGES = [
    ("toxicity", toxicity.stage),
    ("exact_dedup", content_sort.stage),
    ("near_duplicates", parity_join.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
