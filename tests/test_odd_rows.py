"""Marts, scores and reports on rows that the given tables do not bring, against the direct SQL.

A third of the rows has no job id and a third shares one; some have no start, start after today,
lack a project, or repeat each other.
"""

import datetime as dt
import random

import pytest

import __spark_entry__ as contract
import oracle_queries
from compare import duckdb_rows, spark_rows
from auditlens.operators import reports
from auditlens.sources.event_log import FIXTURE_SETTINGS

QUERIES = {
    "dim_job": lambda t: t.jobs,
    "dim_query_statements": lambda t: t.statements,
    "dim_job_labels": lambda t: t.labels,
    "dim_references": lambda t: t.refs,
    "dim_users": lambda t: t.users,
    "dim_user_agents": lambda t: t.agents,
    "dim_errors": lambda t: t.errors,
    "fct_statements": lambda t: t.facts,
    "table_active_users": lambda t: t.active_users,
    "threat_score": lambda t: t.threat,
    "importance_score": lambda t: t.importance,
    "rpt_table_usage": contract._rpt_table_usage,
    "rpt_usage_cost": contract._rpt_usage_cost,
    "rpt_user_metrics": contract._rpt_user_metrics,
    "rpt_dbt_metrics": lambda t: reports.rpt_dbt_metrics(t.facts, t.jobs, t.labels, t.settings),
    "rpt_query_alerting": lambda t: reports.rpt_query_alerting(
        t.facts, t.users, t.statements, t.settings
    ),
}


def odd_rows(seed, count=240):
    pick = random.Random(seed)
    objects = [
        "",
        "projects/p",
        *(f"projects/p/datasets/{d}/tables/t{i}" for d in ("marts", "staging", "raw") for i in range(3)),
    ]
    labels = [None, "{}", '{"a":"1"}', *(f'{{"dbt_invocation_id":"i{i}"}}' for i in range(3))]
    kinds = ["model", "test", "snapshot", "seed"]
    emails = ["UNKNOWN", "a@x.com", "b@x.com", "c@p.iam.gserviceaccount.com", "d@p.iam.gserviceaccount.com"]

    def some_objects():
        return pick.choice([None, [""], pick.sample(objects, 1), pick.sample(objects, 3)])

    rows = []
    for n in range(count):
        if rows and pick.random() < 0.1:
            rows.append(pick.choice(rows))
            continue
        logged = dt.datetime(2024, 1, pick.randint(5, 31), pick.randint(0, 23))
        start = pick.choice([None, logged, logged, logged, logged + dt.timedelta(days=pick.randint(0, 5))])
        error = pick.choice([None, None, "5"])
        statement = f'/* {{"node_id": "{pick.choice(kinds)}.p.m{pick.randint(0, 2)}"}} */ select 1'
        rows.append(
            dict(
                job_id=pick.choice([None, "hot", f"job{n}"]),
                event_type="JobChangeEvent",
                event_timestamp=logged,
                principal_email=pick.choice(emails),
                project_id=pick.choice([None, "p", "q"]),
                caller_ip_address=pick.choice([None, "1", "2"]),
                caller_supplied_user_agent=pick.choice([None, "Mozilla/5", "dbt/1", "other"]),
                error_result_code=error,
                error_result_message=error and f"m{pick.randint(0, 1)}",
                start_time=start,
                end_time=start and pick.choice([None, start + dt.timedelta(microseconds=pick.randint(0, 10**7))]),
                total_slot_ms=pick.choice([None, pick.randint(0, 5000)]),
                total_billed_bytes=pick.choice([None, 0, pick.randint(1, 50) * 2**30]),
                referenced_tables=some_objects(),
                referenced_views=some_objects(),
                cache_hit=pick.choice([None, True, False]),
                config_labels=pick.choice(labels),
                query_statement=pick.choice([None, "select 1", statement]),
                statement_type=pick.choice([None, "SELECT", "INSERT"]),
            )
        )
    return rows


SCHEMA = """
    dashboard_id string, panel_id string, job_id string, event_type string,
    event_timestamp timestamp, resource_name string, principal_email string, project_id string,
    caller_ip_address string, caller_supplied_user_agent string, method_name string,
    error_result_code string, error_result_message string, start_time timestamp,
    end_time timestamp, total_slot_ms long, total_processed_bytes string, total_billed_bytes long,
    billing_tier string, referenced_tables array<string>, referenced_views array<string>,
    output_row_count string, cache_hit boolean, config_labels string, query_statement string,
    create_disposition string, query_priority string, statement_type string
"""


class OddTables(contract.Tables):
    def __init__(self, spark, staged):
        self.spark, self.settings, self.staged = spark, FIXTURE_SETTINGS, staged


@pytest.fixture(scope="module", params=[1, 2])
def odd(spark, request, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "staged")
    spark.createDataFrame(odd_rows(request.param), SCHEMA).coalesce(1).write.parquet(path)
    times = ", ".join(
        f"CAST({c} AS TIMESTAMP) AS {c}" for c in ("event_timestamp", "start_time", "end_time")
    )
    sql = f"SELECT * REPLACE ({times}) FROM read_parquet('{path}/*.parquet')"
    return OddTables(spark, spark.read.parquet(path)), oracle_queries.oracle_sql(sql)


@pytest.mark.parametrize("name", QUERIES)
def test_query(odd, name):
    tables, oracle = odd
    expected = duckdb_rows(oracle[name], "/root/testdata/sf0.001")
    assert expected[1], "the SQL finds no row to compare"
    assert spark_rows(QUERIES[name](tables)) == expected


@pytest.mark.parametrize("name", ["threat_score", "importance_score", "rpt_table_usage"])
def test_query_with_large_dimensions(odd, name):
    """No dimension is small enough to be sent to all executors."""
    tables, oracle = odd
    fresh = OddTables(tables.spark, tables.staged)
    expected = duckdb_rows(oracle[name], "/root/testdata/sf0.001")
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for setting in settings:
        tables.spark.conf.set(setting, "-1")
    try:
        assert spark_rows(QUERIES[name](fresh)) == expected
    finally:
        for setting in settings:
            tables.spark.conf.unset(setting)


def test_table_usage_keeps_short_keys_and_the_columns_it_reads(odd, monkeypatch):
    """Settled tables hold keys of 16 bytes and no column that the report does not read."""
    tables, _ = odd
    settled = {}

    def note(df, name):
        settled[name] = dict(df.dtypes)
        return df

    monkeypatch.setattr(contract, "settle", note)
    contract._rpt_table_usage(OddTables(tables.spark, tables.staged))
    keys = {"job_key", "user_key", "user_agent_key"}
    for name in ("facts", "jobs", "refs", "users", "agents"):
        assert {t for c, t in settled[name].items() if c in keys} == {"binary"}
    assert "start_time" not in settled["facts"]
    assert len(settled["jobs"]) == 3
