"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before it
kept.  ``run`` writes each result as Parquet to the shared folder and reads it back, so a
lost executor never costs an earlier stage.  All stages but the last return the columns they were
given, whatever these are called, and an empty table for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veloclima.llm import decontaminate, line_dedup, mixing, quality_rules, simhash
from veloclima.session import scratch_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go.

    Null and empty texts have too few words and go.  Rows are judged one by one: those that repeat a
    document stay or go together, whatever their doc_id, null included.
    """
    return quality_rules.apply_policy(docs, "v1")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has are cut; what is left stays.

    Earlier is the smaller doc_id, null last.  A document that loses its last word goes; null and
    empty texts lose nothing and stay.  Rows that repeat doc_id and text are cut alike.
    """
    return line_dedup.keep_texts(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest doc_id, null last.

    Groups are those of the operator with its own shingles of 3 words and 2 differing bits.  Null and
    empty texts are one group.  Of rows that repeat doc_id and text one stays; of different texts under
    one doc_id in a group, the one whose hashes are least.
    """
    return simhash.keep_first(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go.

    Null and empty texts hold none and stay, and so do all where the benchmark is empty.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least one copy in the mix, with copies, size, source_size, target and taken.

    Null and empty texts have no words and no copies.  A null source is a source.  Columns of these names
    are replaced.
    """
    return mixing.mix(docs).where("copies > 0")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", contamination),
    ("source mixture", mixture),
]

# Alignment, fingerprints and the dual have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
