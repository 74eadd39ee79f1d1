"""Reading the event log, the reference tables and the sink's watermark."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType, TimestampType

from clickmill.functions.time_uuid import utc_instant
from clickmill.operators.tracking import LOG_DATE, LOG_TIME
from clickmill.schemas import FIRST_WATERMARK, JOB, PUBLISHER, TRACKING
from clickmill.sources.contract import require_schema

# Formats that take a schema at read time; the others bring their own.
_FILE_FORMATS = {"parquet", "orc", "json", "csv", "avro"}
_SELF_DESCRIBING = {"parquet", "orc", "avro"}


def read_table(
    spark: SparkSession, fmt: str = "parquet", schema: StructType | None = None,
    stream: bool = False, **options: str,
) -> DataFrame:
    """Any Spark source by name; a ``path`` option is the place of a file format."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt)
    if schema is not None and fmt in _FILE_FORMATS:
        reader = reader.schema(schema)
    path = options.pop("path", None)
    reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def read_checked(
    spark: SparkSession, name: str, schema: StructType, fmt: str, stream: bool = False, **options: str,
) -> DataFrame:
    """A table that has the columns declared, with their types, or ``ContractError``.

    Of files that carry a schema one footer is read; texts take the schema given.
    """
    if fmt in _FILE_FORMATS - _SELF_DESCRIBING:
        return read_table(spark, fmt, schema, stream, **options)
    if not stream:
        found = read_table(spark, fmt, **options)
        require_schema(found.select(*[c for c in found.columns if c in schema.names]), name, schema)
    table = read_table(spark, fmt, schema, stream, **options)
    return table.select(*schema.names)


def read_events(
    spark: SparkSession, fmt: str = "parquet", stream: bool = False, kept: bool = False,
    **options: str,
) -> DataFrame:
    """The raw event log, as a batch or a stream; ``kept`` if ``write_log`` wrote it."""
    times = [StructField(LOG_TIME, TimestampType()), StructField(LOG_DATE, DateType())]
    schema = StructType(TRACKING.fields + (times if kept else []))
    return read_checked(spark, "tracking", schema, fmt, stream, **options)


def read_jobs(spark: SparkSession, fmt: str = "parquet", **options: str) -> DataFrame:
    return read_checked(spark, "job", JOB, fmt, **options)


def read_publishers(spark: SparkSession, fmt: str = "parquet", **options: str) -> DataFrame:
    return read_checked(spark, "publisher", PUBLISHER, fmt, **options)


def jdbc_options(
    url: str, table: str, columns: list[str] | None = None, driver: str | None = None,
    partition_column: str | None = None, bounds: tuple[int, int] | None = None,
    partitions: int = 16, fetch_size: int = 10_000, **login: str,
) -> dict[str, str]:
    """Options of a parallel JDBC read.

    Spark allows either a query or a partitioned read, so the projection is a derived table; with
    a numeric ``partition_column`` it is read in ``partitions`` ranges.
    """
    projection = f"(SELECT {', '.join(columns)} FROM {table}) source" if columns else table
    options = {"url": url, "dbtable": projection, "fetchsize": str(fetch_size), **login}
    if driver:
        options["driver"] = driver
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned JDBC read needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet table, or no rows if nothing was written there yet; other errors are raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def is_present(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("text").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def sink_watermark(sink: DataFrame, default: str = FIRST_WATERMARK) -> DataFrame:
    """One row: the sink's newest ``updated_at``, or the default for a sink without rows."""
    first = utc_instant(default)
    return sink.agg(F.coalesce(F.max("updated_at"), first).alias("watermark"))


def watermark_value(sink: DataFrame, default: str = FIRST_WATERMARK) -> int:
    """The watermark as a literal for pruning: microseconds, in which no time zone is involved."""
    return sink_watermark(sink, default).select(F.unix_micros("watermark")).first()[0]
