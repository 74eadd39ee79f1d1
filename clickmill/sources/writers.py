"""Writing KPI rows, and tables kept by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickmill.operators.enrich import to_sink_types
from clickmill.operators.tracking import LOG_DATE, with_event_time
from clickmill.session import observed, scratch
from clickmill.sources.contract import require_schema
from clickmill.sources.readers import read_if_present


def by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of one partition value together before a partitioned write.

    Without it every task writes a file into every partition. The rebalance is sized at run time:
    small partitions share a task, and a hot date is split over several.
    """
    return df.hint("rebalance", *columns)


def replace_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Write rows in place of the partitions they belong to; other partitions stay.

    A job that fails leaves the table as it was, and one that is tried again replaces what an
    earlier try has left.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def write_log(log: DataFrame, path: str) -> None:
    """Add raw events to a log kept with their event times and partitioned by date, each id once.

    Later reads skip dates, row groups and the ids themselves. An event whose ``create_time`` is in
    the log already, or came earlier among the new ones, is not added again, so that a call
    may be repeated, also one that was lost halfway. Events without an id are all kept. One call
    at a time: two at once do not see each other's events.

    The new events are decoded once, into the shared folder, where the dates they span are
    observed. Of the log the ids of those dates are read, and only those of new events, found
    through a bloom filter where the log is large, meet them again.
    """
    spark = log.sparkSession
    with scratch(spark, "log") as folder:
        seen, key = Observation(), F.col("create_time")
        timed = with_event_time(log).observe(
            seen, F.min(LOG_DATE).alias("first"), F.max(LOG_DATE).alias("last"), F.count_if(F.col(LOG_DATE).isNull()).alias("undated"))
        timed.write.parquet(folder)
        fresh = spark.read.schema(timed.schema).parquet(folder)
        first, last, undated = observed(seen, "first", "last", "undated")
        span = F.col(LOG_DATE).between(F.lit(first), F.lit(last)) if first else F.lit(False)
        kept = read_if_present(spark, path, fresh.schema).where(span | F.col(LOG_DATE).isNull() if undated else span)
        ids = kept.select("create_time").join(fresh.select("create_time"), "create_time", "left_semi")
        once = fresh.where(key.isNotNull()).dropDuplicates(["create_time"]).join(ids, "create_time", "left_anti")
        added = once.select(*fresh.columns).unionAll(fresh.where(key.isNull()))
        by_partition(added, LOG_DATE).write.mode("append").partitionBy(LOG_DATE).parquet(path)


def append_kpis(rows: DataFrame, path: str) -> None:
    """Append sink rows to a parquet table partitioned by date."""
    typed = by_partition(to_sink_types(rows), "dates")
    typed.write.mode("append").partitionBy("dates").parquet(path)


def jdbc_write_options(
    url: str, table: str, driver: str | None = None, partitions: int = 16,
    batch_size: int = 10_000, **login: str,
) -> dict[str, str]:
    """Options of a JDBC append; ``numPartitions`` bounds the connections opened."""
    options = {
        "url": url, "dbtable": table, "numPartitions": str(partitions),
        "batchsize": str(batch_size), **login,
    }
    return options | ({"driver": driver} if driver else {})


def append_kpis_jdbc(rows: DataFrame, **connection: str) -> None:
    """Append sink rows to a relational table, which numbers the rows itself."""
    typed = to_sink_types(rows).drop("id")
    typed.write.format("jdbc").options(**jdbc_write_options(**connection)).mode("append").save()


def create_table_if_missing(
    spark: SparkSession, name: str, schema: StructType, defaults: dict[str, str] | None = None,
    partition_by: str | None = None, location: str | None = None,
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` from a schema; ``defaults`` are SQL literals by column."""
    defaults = defaults or {}
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
        for f in schema
    )
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partition_by:
        ddl += f" PARTITIONED BY (`{partition_by}`)"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


def bootstrap(
    spark: SparkSession, name: str, schema: StructType, source: DataFrame, location: str,
    defaults: dict[str, str] | None = None,
) -> bool:
    """Make a reference table if it is missing, check its columns, fill it if it is empty."""
    create_table_if_missing(spark, name, schema, defaults, location=location)
    require_schema(spark.table(name), name, schema)
    filled = bootstrap_if_empty(spark, require_schema(source, name, schema), location)
    if filled:
        spark.catalog.refreshTable(name)
    return filled


def bootstrap_if_empty(spark: SparkSession, source: DataFrame, path: str) -> bool:
    """Fill a reference table unless it holds rows already; tells whether it did."""
    if not read_if_present(spark, path, source.schema).isEmpty():
        return False
    source.write.mode("append").parquet(path)
    return True
