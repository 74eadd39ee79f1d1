"""Where incremental batches go: rows are published whole or not at all, and in one run each."""

from __future__ import annotations

import re
from abc import ABC, abstractmethod
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickmill.functions.time_uuid import utc_instant
from clickmill.operators.enrich import to_sink_types
from clickmill.schemas import FIRST_WATERMARK, HOURLY_KPI, TAILS, struct
from clickmill.session import remove
from clickmill.sources.readers import is_present, jdbc_options, read_if_present, watermark_value
from clickmill.sources.writers import by_partition, jdbc_write_options, replace_partitions

#: One row per published run: its name, where it starts, and its newest event, in microseconds.
RUNS = struct("run string, since bigint, mark bigint")
#: Columns that a run's rows get only when its mark is known.
LATE_COLUMNS = {"id", "updated_at"}


def _of_runs(schema: StructType) -> StructType:
    return StructType([f for f in schema.fields if f.name not in LATE_COLUMNS] + [StructField("run", StringType())])


@dataclass(frozen=True)
class Run:
    """A run to be published. ``tails`` are the partials of its newest second; an ``inclusive`` run
    has read the newest second of the run before again."""

    name: str
    since: int
    mark: int
    inclusive: bool
    tails: DataFrame


class Sink(ABC):
    """A table of sink rows, written run by run.

    ``write`` brings a run's rows in, unseen; ``publish`` makes them count, ``discard`` takes them
    away. Of runs that start at the same mark only the first published counts, so that two
    writers at once do no harm and a lost run is simply run again.
    """

    @abstractmethod
    def mark(self) -> int:
        """The newest published mark, or the default of an empty sink."""

    @abstractmethod
    def has(self, name: str) -> bool:
        """Whether a run of this name has been published."""

    @abstractmethod
    def write(self, rows: DataFrame, name: str) -> None: ...

    @abstractmethod
    def publish(self, run: Run) -> None: ...

    @abstractmethod
    def discard(self, name: str) -> None: ...

    @abstractmethod
    def rows(self) -> DataFrame: ...

    @abstractmethod
    def recounted(self) -> DataFrame:
        """The partials of seconds that are in two runs' rows."""


class ParquetSink(Sink):
    """Tables partitioned by run, and one of the published runs, whose row is appended last."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _runs(self) -> DataFrame:
        """Published runs. The time a run's row was stored tells which was the first from its mark."""
        if not is_present(self.spark, f"{self.path}/runs"):
            return self.spark.createDataFrame([], RUNS)
        stored = self.spark.read.schema(RUNS).parquet(f"{self.path}/runs").select(
            "*", F.struct("_metadata.file_modification_time", "run").alias("place"))
        first = stored.groupBy("since").agg(F.min_by(F.struct("run", "mark"), "place").alias("first"))
        return first.select("first.run", "since", "first.mark")

    def _read(self, part: str, schema: StructType) -> DataFrame:
        return read_if_present(self.spark, f"{self.path}/{part}", _of_runs(schema))

    def mark(self) -> int:
        newest = self._runs().agg(F.max("mark")).first()[0]
        return _first_mark(self.spark) if newest is None else newest

    def has(self, name: str) -> bool:
        return not self._runs().where(F.col("run") == name).isEmpty()

    def rows(self) -> DataFrame:
        stamped = self._read("rows", HOURLY_KPI).join(self._runs(), "run")
        return to_sink_types(stamped.withColumn("updated_at", F.timestamp_micros("mark")))

    def recounted(self) -> DataFrame:
        return self._read("recounted", TAILS).join(self._runs().select("run"), "run", "left_semi").drop("run")

    def _put(self, df: DataFrame, name: str, part: str, *partitions: str) -> None:
        named = df.drop(*LATE_COLUMNS).withColumn("run", F.lit(name))
        replace_partitions(named, f"{self.path}/{part}", "run", *partitions)

    def write(self, rows: DataFrame, name: str) -> None:
        if not re.fullmatch(r"[\w.-]+", name):
            raise ValueError(f"{name!r} is no name of a run: letters, digits, '.', '_' and '-'")
        self._put(by_partition(to_sink_types(rows), "dates"), name, "rows", "dates")

    def publish(self, run: Run) -> None:
        self._put(run.tails, run.name, "tails")
        if run.inclusive:
            before = self._runs().where(F.col("mark") == run.since).select("run")
            tails = self._read("tails", TAILS).join(before, "run", "left_semi")
            self._put(tails.drop("run"), run.name, "recounted")
        row = self.spark.createDataFrame([(run.name, run.since, run.mark)], RUNS)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/runs")

    def discard(self, name: str) -> None:
        for part in ("rows", "tails", "recounted"):
            remove(self.spark, f"{self.path}/{part}/run={name}")


def parquet_sink(spark: SparkSession, path: str) -> ParquetSink:
    return ParquetSink(spark, path)


def _first_mark(spark: SparkSession) -> int:
    return spark.range(1).select(F.unix_micros(utc_instant(FIRST_WATERMARK))).first()[0]


#: An SQL statement with the values of its markers: texts, or microseconds for times.
Statement = tuple[str, tuple[str | int, ...]]


def publish_statements(table: str, run: Run) -> list[Statement]:
    """One transaction that moves a run's staged rows and tails into their tables.

    Nothing is moved if the table has rows newer than where the run starts: another run has been
    there. The rows come last, so that all statements see the same table; run them serializable.
    """
    unchanged = f"NOT EXISTS (SELECT 1 FROM {table} t WHERE t.updated_at > ?)"

    def move(columns: list[str], source: str, target: str) -> Statement:
        names = ", ".join(columns)
        return (f"INSERT INTO {target} ({names}, updated_at) SELECT {names}, ? FROM {source} s "
                f"WHERE s.run = ? AND {unchanged}", (run.mark, run.name, run.since))

    tails = [f.name for f in TAILS if f.name != "updated_at"]
    rows = [f.name for f in HOURLY_KPI if f.name not in LATE_COLUMNS]
    names = ", ".join([*tails, "updated_at"])
    recount = (f"INSERT INTO {table}_recounted ({names}) SELECT {names} FROM {table}_tails b "
               f"WHERE b.updated_at = ? AND {unchanged}", (run.since, run.since))
    return [
        move(tails, f"{table}_tails_staging", f"{table}_tails"),
        *([recount] if run.inclusive else []),
        move(rows, f"{table}_staging", table),
        *discard_statements(table, run.name),
    ]


def discard_statements(table: str, name: str) -> list[Statement]:
    return [(f"DELETE FROM {table}{part} WHERE run = ?", (name,)) for part in ("_staging", "_tails_staging")]


def _through_driver(spark: SparkSession, url: str, connection: dict[str, str]) -> Callable[[list[Statement]], None]:
    def transact(statements: list[Statement]) -> None:
        properties = spark._jvm.java.util.Properties()
        for key, value in connection.items():
            properties.setProperty(key, value)
        database = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
        try:
            database.setAutoCommit(False)
            database.setTransactionIsolation(8)  # serializable
            for statement, values in statements:
                prepared = database.prepareStatement(statement)
                for place, value in enumerate(values, 1):
                    if isinstance(value, str):
                        prepared.setString(place, value)
                    else:
                        moment = spark._jvm.java.sql.Timestamp(value // 1000)
                        moment.setNanos(value % 1_000_000 * 1000)
                        prepared.setTimestamp(place, moment)
                prepared.executeUpdate()
            database.commit()
        finally:
            database.close()

    return transact


class JdbcSink(Sink):
    """A relational table; the newest mark is found by the database.

    A run's rows are staged under its name in ``<table>_staging`` and its tails in
    ``<table>_tails_staging``, as Spark commits each partition for itself, and moved in one
    transaction. Tails go to ``<table>_tails``, what is counted twice to ``<table>_recounted``.
    """

    def __init__(self, spark: SparkSession, url: str, table: str,
                 transact: Callable[[list[Statement]], None] | None = None, **connection: str) -> None:
        self.spark, self.url, self.table, self.connection = spark, url, table, connection
        self.transact = transact or _through_driver(spark, url, connection)

    def _read(self, query: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**jdbc_options(self.url, query, **self.connection)).load()

    def _stage(self, df: DataFrame, name: str, part: str) -> None:
        options = jdbc_write_options(url=self.url, table=f"{self.table}{part}", **self.connection)
        named = df.drop(*LATE_COLUMNS).withColumn("run", F.lit(name))
        named.write.format("jdbc").options(**options).mode("append").save()

    def mark(self) -> int:
        return watermark_value(self._read(f"(SELECT MAX(updated_at) AS updated_at FROM {self.table}) newest"))

    def has(self, name: str) -> bool:
        """A database keeps no names: a run published before is found to have nothing to add."""
        return False

    def write(self, rows: DataFrame, name: str) -> None:
        self.discard(name)
        self._stage(to_sink_types(rows), name, "_staging")

    def publish(self, run: Run) -> None:
        self._stage(run.tails, run.name, "_tails_staging")
        self.transact(publish_statements(self.table, run))

    def discard(self, name: str) -> None:
        self.transact(discard_statements(self.table, name))

    def rows(self) -> DataFrame:
        return self._read(self.table)

    def recounted(self) -> DataFrame:
        return self._read(f"{self.table}_recounted")


def jdbc_sink(
    spark: SparkSession, url: str, table: str,
    transact: Callable[[list[Statement]], None] | None = None, **connection: str,
) -> JdbcSink:
    return JdbcSink(spark, url, table, transact, **connection)
