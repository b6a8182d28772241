import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rows import values
from auditlens.operators import reports
from auditlens.plans.pipeline import DIMENSIONS, Build
from auditlens.plans.warehouse import Warehouse
from auditlens.sources.event_log import FIXTURE_SETTINGS as SETTINGS
from auditlens.sources.event_log import event_log

SF_DIR = "/root/testdata/sf0.001"
BY_DAY = {
    "fct_statements": "statement_date",
    "table_active_users": "event_date",
    "threat_score": "statement_date",
    "importance_score": "score_date",
    "rpt_table_usage": "report_date",
    "rpt_query_alerting": "start_date",
}
REBUILT = ["rpt_usage_cost", "rpt_user_metrics", "rpt_dbt_metrics"]


def build(spark, root, settings, log, incremental=False):
    warehouse = Warehouse(spark, str(root), settings)
    Build([log], warehouse, incremental).run()
    return warehouse


@pytest.fixture(scope="module")
def warehouses(spark, tmp_path_factory):
    """A full build, and a full build two days earlier with an incremental one on top."""
    log = event_log(spark, SF_DIR)
    full = build(spark, tmp_path_factory.mktemp("full"), SETTINGS, log)
    before = replace(SETTINGS, as_of=SETTINGS.as_of - dt.timedelta(days=2))
    earlier = log.filter(F.to_date("timestamp") <= F.lit(before.as_of))
    root = tmp_path_factory.mktemp("incremental")
    build(spark, root, before, earlier)
    return full, build(spark, root, SETTINGS, log, incremental=True)


def rows(df):
    return values(df, *sorted(df.columns))


@pytest.mark.parametrize("name, day", BY_DAY.items())
def test_replaced_days_equal_a_full_build(warehouses, name, day):
    full, incremental = warehouses
    recent = F.col(day) >= F.lit(SETTINGS.lookback_start)
    found = rows(incremental.read(name).filter(recent))
    assert found == rows(full.read(name).filter(recent)) and found


@pytest.mark.parametrize("name", [*DIMENSIONS, *REBUILT])
def test_tables_equal_a_full_build(warehouses, name):
    full, incremental = warehouses
    assert rows(incremental.read(name)) == rows(full.read(name))


def test_older_days_of_the_fact_stay(warehouses):
    full, incremental = warehouses
    assert rows(incremental.read("fct_statements")) == rows(full.read("fct_statements"))


def test_reports_can_be_left_out_and_dev_is_limited(spark, tmp_path):
    settings = replace(SETTINGS, enable_reports=False, target="dev", dev_limit_days=5)
    warehouse = build(spark, tmp_path, settings, event_log(spark, SF_DIR))
    assert not (tmp_path / "rpt_usage_cost").exists()
    first = warehouse.read("fct_statements").agg(F.min("statement_date")).first()[0]
    assert first >= settings.dev_limit_start


def test_alerting_reads_statements_of_recent_jobs_only(warehouses):
    _, incremental = warehouses
    tables = (incremental.read(n) for n in ("fct_statements", "dim_users", "dim_query_statements"))
    plan = reports.rpt_query_alerting(*tables, SETTINGS)._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "last_day" in line]
    assert pushed and all("GreaterThanOrEqual(last_day,2024-01-" in line for line in pushed if "version" not in line)


def test_a_late_start_is_alerted_on(spark, tmp_path):
    """Logged long before it starts, and logged again for an earlier start in between."""
    log = event_log(spark, SF_DIR).limit(1).withColumn("timestamp", F.lit("2024-01-03 01:00:00").cast("timestamp"))

    def started(logged, start):
        metadata = F.lit(
            '{"jobChange":{"job":{"jobName":"projects/p/jobs/late","jobConfig":{"queryConfig":{"query":"q"}},'
            f'"jobStats":{{"startTime":"{start}T00:00:00Z"}}}}}}}}'
        )
        payload = F.col("protopayload_auditlog").withField("metadataJson", metadata)
        stamp = F.lit(f"{logged} 01:00:00").cast("timestamp")
        return log.withColumns({"timestamp": stamp, "protopayload_auditlog": payload})

    first, again = started("2024-01-03", "2024-01-31"), started("2024-01-12", "2024-01-12")
    root = tmp_path / "late"
    build(spark, root, replace(SETTINGS, as_of=dt.date(2024, 1, 4)), first)
    middle = replace(SETTINGS, as_of=dt.date(2024, 1, 12))
    build(spark, root, middle, first.unionByName(again), incremental=True)
    warehouse = Warehouse(spark, str(root), SETTINGS)
    tables = (warehouse.read(n) for n in ("fct_statements", "dim_users", "dim_query_statements"))
    found = reports.rpt_query_alerting(*tables, SETTINGS)
    assert values(found, "query_statement", "start_time") == [("q", dt.datetime(2024, 1, 31))]
