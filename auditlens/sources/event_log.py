"""An audit log derived from the `events` table, one log row per event.

The given tables hold no audit log. This adapter maps each event to a job with statement, labels,
referenced objects, cost and errors, by integer rules on its id, user and `k` (see FIXTURES.md), so
that the log grows with the table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from auditlens.settings import Settings

# The log covers January 2024; the settings below name its datasets.
FIXTURE_SETTINGS = Settings(
    as_of=dt.date(2024, 1, 31), prod_datasets=("marts",), stage_datasets=("staging",)
)

_EVENT = (
    "event_id",
    "user_id",
    "event_type AS kind",
    "CAST(ts AS TIMESTAMP) AS ts",
    "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k",
    "'proj-' || user_id % 2 AS project",
    "CAST(floor(value * 1000) AS BIGINT) AS ms",
)

_LABELS = """
    CASE
        WHEN kind = 'purchase' THEN map('dbt_invocation_id', 'inv-' || k % 4)
        WHEN kind = 'click' AND k % 10 = 0 THEN map('sheets_trigger', 'user')
        WHEN kind = 'click' AND k % 10 = 1 THEN map('sheets_trigger', 'schedule')
        WHEN kind = 'click' AND k % 10 = 4 THEN map('sheets_trigger', '@nested')
        WHEN kind = 'view' AND k % 10 = 2 THEN map('data_source_id', 'scheduled_query')
        WHEN k % 10 = 9 THEN CAST(map() AS MAP<STRING, STRING>)
        WHEN kind = 'signup' THEN map('x-dashboard-uid', 'd' || k % 3, 'x-panel-id', 'p' || k % 5)
    END
"""

_STATEMENT = """
    CASE WHEN kind = 'purchase' THEN concat(
        '/* {"app": "dbt", "dbt_version": ',
        CASE WHEN k % 16 = 3 THEN '{"v": "1.3.0"}' ELSE '"1.3.0"' END, ', "profile_name": "shop", ',
        '"target_name": "prod", "node_id": "',
        CASE k % 3 WHEN 0 THEN 'model' WHEN 1 THEN 'test' ELSE 'snapshot' END,
        '.pkg.m', k % 10, '"} */ select 1')
    ELSE concat('select ', k, ' from t') END
"""

_TABLES = """
    CASE WHEN k % 11 = 10 THEN NULL WHEN k % 13 = 12 THEN CAST(array() AS ARRAY<STRING>)
    ELSE array_compact(array(
        concat('projects/', project, '/datasets/',
            CASE k % 4 WHEN 0 THEN 'marts' WHEN 1 THEN 'staging' ELSE 'raw_a' END,
            '/tables/t', k % 20),
        CASE WHEN k % 3 = 0 THEN 'projects/proj-0/datasets/marts/tables/common' END))
    END
"""

_VIEWS = """
    CASE WHEN k % 5 = 0
        THEN array(concat('projects/', project, '/datasets/marts/tables/v', k % 7)) END
"""

_JOB = f"""
    named_struct(
        'jobName', concat('projects/', project, '/jobs/job',
            CASE WHEN event_id % 40 = 39 THEN event_id - 1 ELSE event_id END),
        'jobConfig', named_struct(
            'type', 'QUERY',
            'labels', {_LABELS},
            'queryConfig', named_struct(
                'statementType', CASE WHEN k % 6 = 5 THEN 'INSERT' ELSE 'SELECT' END,
                'query', {_STATEMENT})),
        'jobStatus', named_struct(
            'jobState', 'DONE',
            'errorResult', CASE WHEN kind = 'error' THEN
                named_struct('code', 5 + k % 3, 'message', 'err ' || k % 4) END),
        'jobStats', named_struct(
            'startTime', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
            'endTime', date_format(
                timestampadd(MILLISECOND, ms, ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
            'totalSlotMs', CAST(ms AS STRING),
            'queryStats', named_struct(
                'totalBilledBytes', CAST(ms * 1048576 AS STRING),
                'cacheHit', k % 2 = 0,
                'referencedTables', {_TABLES},
                'referencedViews', {_VIEWS})))
"""

# Objects and lists where a text is expected; those are no scalars, and count as missing.
_NESTED = """
    replace(replace(replace({text}, '"@nested"', '{{"by":"user"}}'),
        CASE WHEN event_id % 211 = 5 THEN '"jobState":"DONE"' ELSE '' END, '"jobState":{{"state":"DONE"}}'),
        CASE WHEN event_id % 223 = 7 THEN '"type":"QUERY"' ELSE '' END, '"type":["QUERY"]')
"""

_EMAIL = """
    CASE
        WHEN event_id % 101 = 0 THEN NULL
        WHEN user_id % 5 = 0 THEN concat('svc', user_id, '@p.iam.gserviceaccount.com')
        ELSE concat('user', user_id, '@example.com')
    END
"""

_AGENT = """
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE
        CASE kind
            WHEN 'click' THEN 'Mozilla/5.0'
            WHEN 'view' THEN 'gl-python/3.9'
            WHEN 'purchase' THEN 'dbt/1.3'
            WHEN 'signup' THEN 'gcloud-golang-bigquery/1'
            WHEN 'error' THEN 'SimbaJDBCDriver/1.6'
        END
    END
"""

_LOG_ROW = (
    "'ins-' || event_id AS insertId",
    "ts AS timestamp",
    """named_struct('labels', named_struct(
        'project_id', project, 'dataset_id', CAST(NULL AS STRING), 'location', 'US')) AS resource""",
    f"""named_struct(
        'resourceName', 'projects/' || project,
        'serviceName', 'bigquery',
        'methodName', 'InsertJob',
        'metadataJson', CASE WHEN event_id % 50 = 7 THEN '{{"tableDataRead":{{}}}}'
            ELSE {_NESTED.format(text=f"to_json(named_struct('jobChange', named_struct('job', {_JOB})))")} END,
        'authenticationInfo', named_struct('principalEmail', {_EMAIL}),
        'requestMetadata', named_struct(
            'callerIp', '10.0.0.' || user_id % 250, 'callerSuppliedUserAgent', {_AGENT})
    ) AS protopayload_auditlog""",
)


def log_from_events(events: DataFrame) -> DataFrame:
    """Log rows in the shape of `audit_log.LOG_SCHEMA`."""
    return events.selectExpr(*_EVENT).selectExpr(*_LOG_ROW)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return log_from_events(events.repartition(spark.sparkContext.defaultParallelism))
