import pytest
from pyspark.sql import functions as F

from clickmill.schemas import HOURLY_KPI, JOB, PUBLISHER, TRACKING
from clickmill.session import SETTINGS, scratch_dir
from clickmill.sources.contract import ContractError, require_schema, schema_contract
from clickmill.sources.readers import (
    is_present, jdbc_options, read_events, read_jobs, read_publishers,
)
from clickmill.sources.sinks import jdbc_sink
from clickmill.sources.writers import (
    append_kpis, bootstrap, bootstrap_if_empty, create_table_if_missing, jdbc_write_options,
)
from tests.helpers import at, event, rows


def test_declared_tables():
    assert [len(s) for s in (TRACKING, JOB, PUBLISHER, HOURLY_KPI)] == [29, 30, 20, 17]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_events_from_any_file_format(spark, log, tmp_path, fmt):
    raw = log(event(at(1, 8), bid=2, ua="x"))
    raw.write.format(fmt).save(str(tmp_path / "log"))
    found = read_events(spark, fmt, path=str(tmp_path / "log"))
    assert found.schema.names == TRACKING.names and rows(found) == rows(raw)
    assert read_events(spark, fmt, stream=True, path=str(tmp_path / "log")).isStreaming


def test_dimensions(spark, tmp_path):
    for read, schema in ((read_jobs, JOB), (read_publishers, PUBLISHER)):
        place = str(tmp_path / read.__name__)
        spark.createDataFrame([], schema).write.parquet(place)
        assert read(spark, path=place).schema == schema


def test_jdbc_reads_push_the_projection_and_run_in_ranges():
    options = jdbc_options(
        "jdbc:x", "job", ["id AS job_id", "company_id"], driver="d", user="u", password="p",
        partition_column="job_id", bounds=(1, 1000), partitions=4,
    )
    assert options == {
        "url": "jdbc:x", "dbtable": "(SELECT id AS job_id, company_id FROM job) source",
        "fetchsize": "10000", "user": "u", "password": "p", "driver": "d",
        "partitionColumn": "job_id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "job", partition_column="id")
    assert jdbc_options("jdbc:x", "job")["dbtable"] == "job"


def test_jdbc_writes_are_batched_over_few_connections():
    assert jdbc_write_options("jdbc:x", "events", "d", partitions=8, user="u") == {
        "url": "jdbc:x", "dbtable": "events", "numPartitions": "8", "batchsize": "10000",
        "user": "u", "driver": "d",
    }


def test_a_database_out_of_reach_is_an_error_not_an_empty_sink(spark):
    sink = jdbc_sink(spark, "jdbc:nosuch:x", "events", user="u")
    with pytest.raises(Exception, match="No suitable driver"):
        sink.mark()


def test_contract_reports_and_requires(spark):
    table = spark.createDataFrame([(1, None), (2, "x")], "id int, publisher_name string")
    narrow = type(PUBLISHER)([PUBLISHER["id"], PUBLISHER["publisher_name"]])
    assert require_schema(table, "publisher", narrow) is table
    found = {r.column: r for r in schema_contract(table, "publisher", PUBLISHER, counts=True).collect()}
    assert len(found) == 20 and not found["min_bid"].ok and found["min_bid"].actual is None
    name = found["publisher_name"]
    assert (name.ok, name.rows, name.nulls) == (True, 2, 1)
    with pytest.raises(ContractError, match="min_bid: missing"):
        require_schema(table, "publisher", PUBLISHER)
    with pytest.raises(ContractError, match="id: bigint instead of int; extra: not declared"):
        wide = table.withColumn("id", F.col("id").cast("bigint")).withColumn("extra", F.lit(1))
        require_schema(wide, "publisher", narrow)


def test_tables_are_created_once_with_their_defaults(spark, tmp_path):
    place = str(tmp_path / "kpis")
    for _ in range(2):
        create_table_if_missing(
            spark, "hourly_kpi_test", HOURLY_KPI, {"impression": "0", "sources": "'Cassandra'"},
            partition_by="dates", location=place,
        )
    try:
        spark.sql("INSERT INTO hourly_kpi_test (job_id, dates) VALUES (1, DATE'2024-03-01')")
        row = spark.table("hourly_kpi_test").first()
        assert (row.impression, row.sources, row.clicks) == (0, "Cassandra", None)
    finally:
        spark.sql("DROP TABLE hourly_kpi_test")


def test_contract_without_counts_reads_nothing(spark, tmp_path):
    spark.createDataFrame([(1, None)], "id int, publisher_name string").write.parquet(str(tmp_path / "p"))
    checks = schema_contract(spark.read.parquet(str(tmp_path / "p")), "publisher", PUBLISHER)
    assert "FileScan" not in checks._jdf.queryExecution().executedPlan().toString()
    assert {r.rows for r in checks.collect()} == {None}


def test_readers_check_what_they_read(spark, tmp_path):
    place = str(tmp_path / "job")
    spark.createDataFrame([(1, "x")], "id bigint, title string").write.parquet(place)
    with pytest.raises(ContractError, match="id: bigint instead of int"):
        read_jobs(spark, path=place)


def test_bootstrap_makes_checks_and_fills(spark, tmp_path):
    source = spark.createDataFrame([(1, 2)], "id int, company_id int")
    place = str(tmp_path / "boot")
    try:
        for expected in (True, False):
            assert bootstrap(spark, "job_boot_test", source.schema, source, place) is expected
        assert spark.table("job_boot_test").count() == 1
        with pytest.raises(ContractError):
            bootstrap(spark, "job_boot_test", PUBLISHER, source, place)
    finally:
        spark.sql("DROP TABLE IF EXISTS job_boot_test")


def test_bootstrap_fills_an_empty_table_only(spark, tmp_path):
    place = str(tmp_path / "job")
    source = spark.createDataFrame([(1, 2)], "id int, company_id int")
    assert bootstrap_if_empty(spark, source, place)
    assert not bootstrap_if_empty(spark, source, place)
    assert spark.read.parquet(place).count() == 1


def test_the_sink_is_kept_by_date(spark, tmp_path):
    place = str(tmp_path / "sink")
    names = [f.name for f in HOURLY_KPI if f.name != "id"]
    row = spark.range(1).select(*[F.lit(None).alias(n) for n in names]).withColumns(
        {"dates": F.lit("2024-03-01"), "job_id": F.lit(1)}
    )
    append_kpis(row, place)
    append_kpis(row, place)
    assert is_present(spark, place + "/dates=2024-03-01")
    assert spark.read.schema(HOURLY_KPI).parquet(place).count() == 2


def test_scratch_is_below_the_shared_folder(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if before:
        assert first.startswith(before.rstrip("/") + "/x-")


def test_the_session_carries_the_settings(spark):
    assert {k: spark.conf.get(k) for k in SETTINGS} == SETTINGS
