"""The corpus pipeline: documents in, a weighted mix of clean documents out.

Each stage takes all rows that the one before kept; every stage but the last returns the columns
of ``documents``, others than ``doc_id``, ``text`` and ``n_chars`` as they came. Rows with a null id
or text, empty texts and repeated rows are documents like any other: see each operator. Empty
tables give empty results; without labels no document is rejected, without a benchmark none has
a passage of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm import decontaminate, mixing, near_dup, quality, secrets
from clickmill.llm.common import keeping, read_table
from clickmill.session import remove, scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; all of them if no labels of both kinds taught it anything."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.accept(docs, model) if model.weights.any() else docs


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id."""
    return near_dup.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets blotted out and ``n_chars`` counted anew where the text changed."""
    names, mark = docs.columns, "before"
    while mark in names:
        mark += "_"
    after = secrets.redact(docs.withColumn(mark, F.xxhash64("text")))
    changed = F.xxhash64("text") != F.col(mark)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        after = after.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return after.select(*names)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document with the words that the mix takes of it."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_dup_stage),
    ("decontamination", decontaminate_stage),
    ("secret scan", secrets_stage),
    ("mixing", mixing_stage),
]

#: SQL has no word for a trained classifier, nor for the draws of the mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written to the shared folder and read again.

    What a stage has kept on its way, and the stage before, are removed when it is written.
    """
    docs, last = read_table(spark, sf_dir, "documents"), None
    root = scratch_dir(spark, "corpus")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/stage-{number}"
        with keeping(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
