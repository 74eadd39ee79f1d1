"""Keeping the partials of a long-running stream few and pruned by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clickmill.operators.kpis import PARTIAL_COLUMNS, merge_partials
from clickmill.schemas import PARTIALS
from clickmill.sources.readers import read_if_present
from clickmill.sources.writers import by_partition, replace_partitions
from clickmill.streaming.kpi_stream import read_batches


def _compacted(spark: SparkSession, compacted_path: str | None, schema: StructType) -> DataFrame:
    """Merged partials, each with the batch ``through`` which its date is merged."""
    keyed = StructType([*schema.fields, StructField("through", LongType())])
    if compacted_path is None:
        return spark.createDataFrame([], keyed)
    return read_if_present(spark, compacted_path, keyed)


def _unmerged(spark: SparkSession, partials_path: str, compacted: DataFrame, schema: StructType) -> DataFrame:
    """Partials of batches after the one through which their date is merged."""
    # One row per date, so small enough to broadcast after any number of years.
    dates = compacted.groupBy("date").agg(F.max("through").alias("through"))
    batches = read_batches(spark, partials_path, schema)
    return batches.join(F.broadcast(dates), "date", "left").where(
        F.col("batch_id") > F.coalesce("through", F.lit(-1))).drop("through")


def compact_partials(
    spark: SparkSession, partials_path: str, compacted_path: str, through: int | None = None,
    schema: StructType = PARTIALS,
) -> None:
    """Merge the batches up to ``through``, all if not given, into one row per key, kept by date.

    One grouped rewrite of the dates those batches touch; other dates stay as they are. Every row
    tells through which batch its date is merged, and a date is replaced as a whole: a run that is
    lost halfway has finished some dates and left the others, and readers see each event once
    before, during and after it. Batches merged may be removed when no reader is at them any more.
    """
    compacted = _compacted(spark, compacted_path, schema)
    fresh = _unmerged(spark, partials_path, compacted, schema)
    if through is not None:
        fresh = fresh.where(F.col("batch_id") <= through)
    newest = fresh.agg(F.max("batch_id")).first()[0]
    if newest is None:
        return
    touched = compacted.join(F.broadcast(fresh.select("date").distinct()), "date", "left_semi")
    merged = merge_partials(fresh.select(*PARTIAL_COLUMNS).unionByName(touched.select(*PARTIAL_COLUMNS)))
    stamped = merged.select(*PARTIAL_COLUMNS, F.lit(newest).cast("bigint").alias("through"))
    replace_partitions(by_partition(stamped, "date"), compacted_path, "date")


def served_partials(
    spark: SparkSession, partials_path: str, compacted_path: str | None = None,
    schema: StructType = PARTIALS,
) -> DataFrame:
    """Merged dates and the batches after them, to be merged by ``kpi_merged``."""
    compacted = _compacted(spark, compacted_path, schema)
    recent = _unmerged(spark, partials_path, compacted, schema)
    return compacted.select(*PARTIAL_COLUMNS).unionByName(recent.select(*PARTIAL_COLUMNS))
