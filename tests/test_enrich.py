from pyspark.sql import functions as F

from clickmill.operators import enrich, kpis
from clickmill.operators.tracking import tracking_events
from clickmill.schemas import HOURLY_KPI
from tests.helpers import at, event, rows


def _facts(log, hot=60):
    events = [event(at(1 + i % 5, i % 24), job=7, node=i) for i in range(hot)]
    return kpis.hourly_kpis(tracking_events(log(*events, event(at(1, 1), job=8), event(at(1, 1), job=0))))


def _jobs(spark):
    return spark.createDataFrame(
        [(7, 70, 700, 9), (8, 80, None, 9), (9, 90, 1, 1)],
        "id int, company_id int, group_id int, campaign_id int",
    )


def test_the_company_is_added_and_the_facts_keep_their_own_ids(log, spark):
    facts = _facts(log)
    found = enrich.company_enriched(facts, _jobs(spark))
    assert found.count() == facts.count()
    assert {(r.job_id, r.company_id) for r in found.collect()} == {(7, 70), (8, 80), (0, None)}
    assert {r.group_id for r in found.collect()} == {1}


def test_a_large_lookup_is_joined_over_salts_with_equal_rows(log, spark):
    facts, jobs = _facts(log), _jobs(spark)
    small = enrich.company_enriched(facts, jobs)
    large = enrich.company_enriched(facts, jobs, broadcast_bytes=40, salts=4)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan and "salt" in plan
    assert rows(small) == rows(large)


def test_lookups_are_measured_by_their_values(spark):
    lookup = spark.createDataFrame([(1, "four"), (2, "é"), (3, None)], "id int, name string")
    assert enrich.lookup_bytes(lookup) == 3 * 8 + 4 + 2
    assert enrich.lookup_bytes(lookup.filter("id > 3")) == 0
    assert enrich.lookup_bytes(lookup.drop("name")) == 24


def test_salts_split_a_hot_key(log):
    rest = ["date", "hour", "publisher_id", "campaign_id", "group_id"]
    salted = _facts(log).filter("job_id = 7").groupBy(F.pmod(F.xxhash64(*rest), F.lit(4))).count()
    assert salted.count() == 4


def test_dimension_projections(spark):
    jobs = _jobs(spark)
    assert enrich.job_dim(jobs).columns == ["job_id", "company_id", "group_id", "campaign_id"]
    assert rows(enrich.job_group_ids(jobs)) == [(1,), (700,)]
    assert rows(enrich.publisher_ids(jobs.union(jobs))) == [(7,), (8,), (9,)]


def test_sink_rows_in_declared_types_with_a_repeatable_id(log, spark):
    enriched = enrich.company_enriched(_facts(log), _jobs(spark))
    mark = F.lit("2024-03-05 00:00:00").cast("timestamp")
    plain = enrich.sink_rows(enriched, mark, "somewhere")
    assert plain.columns == enrich.SINK_ORDER + ["impression", "sources"]
    typed = enrich.to_sink_types(plain)
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in HOURLY_KPI]
    first, again = rows(typed), rows(enrich.to_sink_types(plain.repartition(3)))
    assert first == again
    assert typed.select("id").distinct().count() == typed.count()


def test_tables_in_buckets_are_joined_where_they_lie(log, spark, tmp_path):
    facts, jobs = _facts(log), enrich.job_dim(_jobs(spark))
    try:
        kept = [enrich.keep_bucketed(df, f"bucketed_{name}", str(tmp_path / name), buckets=4)
                for name, df in (("facts", facts), ("jobs", jobs))]
        joined = enrich.company_bucketed(*kept)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2
        assert rows(joined) == rows(enrich.company_enriched(facts, _jobs(spark)))
    finally:
        for name in ("facts", "jobs"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")
