"""The corpus pipeline: five stages over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``; the last adds how often the mix takes a
document (``mix_size``, ``mix_repeats``, ``mix_taken``).

Defined results: documents without text count as empty texts in every stage;
an empty table stays empty; columns beside doc_id, text and source are carried
along; a stage's own tables (labels, benchmark) are read from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm.common import stored, table
from matchlake.llm.decontaminate import clean_documents
from matchlake.llm.exact_dedup import drop_copies
from matchlake.llm.mixing import mixed_documents
from matchlake.llm.quality import good_documents
from matchlake.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints one document stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; documents taken no time go."""
    return mixed_documents(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("simhash_near_dedup", near),
          ("decontamination", decontaminate), ("mixing", mix)]

# The classifier and XXH64 fingerprints cannot be written in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
