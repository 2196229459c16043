"""A corpus made ready for training, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it
to the shared checkpoint folder and reads it again as the next one's ``docs``,
so a lost executor never costs more than the stage at work. All stages but
the last return documents with their columns. What a stage has staged on its
way is removed when its result is written; the results of the stages stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nimbus.llm import bpe, decontaminate, exact_dedup, jaccard_join, lang_id
from nimbus.llm.common import read_table, remove_staged, staged, staged_folders
from nimbus.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear margin."""
    return lang_id.accepted(docs, lang_id.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity."""
    return jaccard_join.representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages of any weight."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their decoded text, as digests."""
    path = tokenizer_path()
    return bpe.digests(bpe.decode_documents(bpe.encode_documents(docs, path), path))


STAGES = [("language", language), ("exact_dedup", exact), ("jaccard_join", near), ("decontamination", benchmark), ("bpe", tokens)]

# Language identification by compression is not a matter of SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = staged_folders(spark)
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        remove_staged(spark, [f for f in staged_folders(spark) if f not in before and f"/pipeline-{name}-" not in f])
    return docs
