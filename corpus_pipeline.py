"""From raw documents to sharded training data, in stages that are stored one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm import chosen_path, curriculum, decontam, feistel, quality_model
from folioloom.llm.frames import table
from folioloom.session import write_once

QUALITY_THRESHOLD = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of these documents.

    A classifier that has not met both labels would give all documents one score, so that is an error.
    """
    model = quality_model.from_labels(docs, table(spark, sf_dir, "labels"))
    if not model.both_classes and not docs.isEmpty():
        raise ValueError(f"quality: {model.rows} usable labelled texts, {model.ones} with label 1; both labels are needed")
    scored = quality_model.score(docs, model, name="_score")
    return scored.filter(F.col("_score") >= QUALITY_THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by five-word shingles at 0.8 (op7's are four words)."""
    return chosen_path.one_of_each(docs, chosen_path.Settings(shingle=5))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    judged = decontam.judge(docs, table(spark, sf_dir, "benchmark"))
    return judged.filter(~F.col("contaminated")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents as the mix takes them, stored in order of their training position.

    A copy has no column for its position, because stages keep the columns of documents: its place in the table tells.
    """
    return curriculum.mix(docs).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot.

    ``docs`` is the stored mix. Its order holds between windows of 65,536 rows, which are shuffled in themselves,
    so reading all shards slot by slot follows the curriculum. Rows that are not a read of stored files have no
    such order and are numbered by id and text.
    """
    return feistel.shard_stored(docs) if docs.inputFiles() else feistel.shard_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shards", shards),
]

#: The classifier and the near-duplicate join have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
