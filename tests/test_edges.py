"""Builds with empty tables, objects in two layers, a price of 0, and the run of all rules."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from auditlens.operators.scores import threat_score
from auditlens.plans.pipeline import DIMENSIONS, Build
from auditlens.plans.rules import broken_rules
from auditlens.session import settle
from auditlens.plans.warehouse import Warehouse
from auditlens.sources.event_log import FIXTURE_SETTINGS as SETTINGS
from auditlens.sources.event_log import event_log

TIB = 2**40
DAYS = [dt.date(2024, 1, n) for n in (10, 11)]


@pytest.fixture(scope="module")
def log(spark):
    return event_log(spark, "/root/testdata/sf0.001").filter("hash(insertId) % 10 = 0")


def test_empty_log_builds_empty_tables(spark, log, tmp_path):
    for incremental in (False, True):
        warehouse = Warehouse(spark, str(tmp_path), SETTINGS)
        Build([log.filter("false")], warehouse, incremental).run()
        for name in (*DIMENSIONS, "fct_statements", "threat_score", "rpt_dbt_metrics", "rpt_query_alerting"):
            assert warehouse.read(name).count() == 0


def test_rules_hold_and_a_broken_table_is_reported(spark, log, tmp_path):
    later = replace(SETTINGS, as_of=dt.date(2024, 2, 10))  # nothing to alert on
    warehouse = Warehouse(spark, str(tmp_path), later)
    Build([log], warehouse).run()
    assert warehouse.read("rpt_query_alerting").count() == 0
    assert not [rule for rule in broken_rules(warehouse) if rule[0] in ("dim_users", "dim_user_agents")]
    users = warehouse.read("dim_users")
    twice = users.unionByName(users).unionByName(users.limit(1).withColumn("user_key", F.lit(None).cast("string")))
    warehouse.replace("dim_users", twice)
    broken = {rule[1]: rule[-1] for rule in broken_rules(warehouse) if rule[0] == "dim_users"}
    assert broken == {"not_null": 1, "unique": users.count()}
    days = warehouse.read("dim_date")
    assert days.count() == 14611 and not [rule for rule in broken_rules(warehouse) if rule[0] == "dim_date"]
    first = days.orderBy("date_day").limit(1)
    twice = days.unionByName(first.withColumns({"day_name": F.lit(None).cast("string"), "date_actual": F.lit(None).cast("date")}))
    warehouse.write_full("dim_date", settle(twice, "days"))
    assert {rule[1:] for rule in broken_rules(warehouse) if rule[0] == "dim_date"} == {
        ("not_null", ("day_name",), 1), ("not_null", ("date_actual",), 1),
        ("unique", ("date_key",), 1), ("unique", ("date_day",), 1),
    }


def scored(spark, settings):
    rows = [("raw", DAYS[0], TIB), ("prod", DAYS[0], 2 * TIB), ("prod2", DAYS[1], TIB), ("else", DAYS[0], TIB)]
    facts = spark.createDataFrame(
        [(job, day, "u", "none", size, 0) for job, day, size in rows],
        "job_key string, statement_date date, user_key string, error_message_key string, "
        "total_billed_bytes long, total_slot_ms long",
    )
    jobs = spark.createDataFrame([(r[0], None) for r in rows], "job_key string, dbt_execution_type string")
    layers = {"raw": "raw", "prod": "prod", "prod2": "prod", "else": "prod"}
    refs = spark.createDataFrame(
        [(job, "b" if job == "else" else "a", layer, "table") for job, layer in layers.items()],
        "job_key string, referenced_view_or_table string, layer_used string, object_type string",
    )
    users = spark.createDataFrame([("u", "User", "u@x")], "user_key string, user_type string, principal_email string")
    return threat_score(facts, jobs, refs, users, settings).collect()


def test_costs_of_an_object_count_over_its_layers(spark):
    found = {(r.referenced_view_or_table, r.statement_date): r for r in scored(spark, SETTINGS)}
    for day in DAYS:
        row = found["a", day]
        assert row.sum_daily_query_cost_median == pytest.approx(12.45)
        assert row.percent_rank_sum_daily_query_cost == 0.5


def test_without_a_price_no_cost_ranks_above_another(spark):
    free = replace(SETTINGS, on_demand_price_per_tib=0.0)
    assert all(r.percent_rank_sum_daily_query_cost == 0 for r in scored(spark, free))
