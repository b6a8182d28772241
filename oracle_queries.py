"""The same results in plain SQL over the given tables, to check the engine against.

Where the engine rewrites a query to scale, the SQL here stays with the direct form: dense calendars,
joins that repeat rows, and window functions over everything.
"""

from __future__ import annotations

import textwrap

from auditlens.sources.event_log import FIXTURE_SETTINGS

AS_OF = f"DATE '{FIXTURE_SETTINGS.as_of}'"

# Named steps. Each may use any step above it.
_STEPS: dict[str, str] = {}


def _step(name: str, sql: str) -> None:
    _STEPS[name] = textwrap.dedent(sql).strip()


def _key(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(CAST({p} AS VARCHAR), '<null>')" for p in parts) + ")"


NO_ERROR = "md5('NONE-NONE')"


def _on_demand(amount: str) -> str:
    return f"(CAST({amount} AS DOUBLE) / 1099511627776::DOUBLE * 6.225::DOUBLE)"


def _slots(amount: str) -> str:
    return f"(CAST({amount} AS DOUBLE) / (3600000::DOUBLE * 0.04::DOUBLE))"


_step(
    "ev",
    """
    SELECT event_id, user_id, event_type AS kind, ts,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
        'proj-' || (user_id % 2) AS project,
        CAST(floor(value * 1000) AS BIGINT) AS ms
    FROM events
    """,
)
_step(
    "staged",
    """
    SELECT
        'ins-' || event_id AS insert_id,
        CASE WHEN kind = 'signup' AND k % 10 <> 9 THEN 'd' || (k % 3) END AS dashboard_id,
        CASE WHEN kind = 'signup' AND k % 10 <> 9 THEN 'p' || (k % 5) END AS panel_id,
        project || ':job' || (CASE WHEN event_id % 40 = 39 THEN event_id - 1 ELSE event_id END)
            AS job_id,
        'JobChangeEvent' AS event_type,
        ts AS event_timestamp,
        'projects/' || project AS resource_name,
        CASE
            WHEN event_id % 101 = 0 THEN 'UNKNOWN'
            WHEN user_id % 5 = 0 THEN 'svc' || user_id || '@p.iam.gserviceaccount.com'
            ELSE 'user' || user_id || '@example.com'
        END AS principal_email,
        project AS project_id,
        CAST(NULL AS VARCHAR) AS dataset_id,
        'US' AS location,
        '10.0.0.' || (user_id % 250) AS caller_ip_address,
        CASE WHEN event_id % 97 = 0 THEN NULL ELSE
            CASE kind
                WHEN 'click' THEN 'Mozilla/5.0'
                WHEN 'view' THEN 'gl-python/3.9'
                WHEN 'purchase' THEN 'dbt/1.3'
                WHEN 'signup' THEN 'gcloud-golang-bigquery/1'
                WHEN 'error' THEN 'SimbaJDBCDriver/1.6'
            END
        END AS caller_supplied_user_agent,
        'bigquery' AS service_name,
        'InsertJob' AS method_name,
        CASE WHEN event_id % 211 <> 5 THEN 'DONE' END AS job_state,
        CASE WHEN event_id % 223 <> 7 THEN 'QUERY' END AS config_type,
        CASE WHEN kind = 'error' THEN CAST(5 + k % 3 AS VARCHAR) END AS error_result_code,
        CASE WHEN kind = 'error' THEN 'err ' || (k % 4) END AS error_result_message,
        CAST(NULL AS TIMESTAMP) AS create_time,
        ts AS start_time,
        ts + to_milliseconds(ms) AS end_time,
        ms AS total_slot_ms,
        CAST(NULL AS VARCHAR) AS total_processed_bytes,
        ms * 1048576 AS total_billed_bytes,
        CAST(NULL AS VARCHAR) AS billing_tier,
        CASE
            WHEN k % 11 = 10 THEN NULL
            WHEN k % 13 = 12 THEN ['']
            ELSE list_concat(
                ['projects/' || project || '/datasets/'
                    || (CASE k % 4 WHEN 0 THEN 'marts' WHEN 1 THEN 'staging' ELSE 'raw_a' END)
                    || '/tables/t' || (k % 20)],
                CASE WHEN k % 3 = 0 THEN ['projects/proj-0/datasets/marts/tables/common'] END)
        END AS referenced_tables,
        CASE WHEN k % 5 = 0 THEN ['projects/' || project || '/datasets/marts/tables/v' || (k % 7)]
        END AS referenced_views,
        CAST(NULL AS VARCHAR) AS output_row_count,
        k % 2 = 0 AS cache_hit,
        CAST(NULL AS BIGINT) AS total_output_bytes,
        CASE
            WHEN kind = 'purchase' THEN '{"dbt_invocation_id":"inv-' || (k % 4) || '"}'
            WHEN kind = 'click' AND k % 10 = 0 THEN '{"sheets_trigger":"user"}'
            WHEN kind = 'click' AND k % 10 = 1 THEN '{"sheets_trigger":"schedule"}'
            WHEN kind = 'click' AND k % 10 = 4 THEN '{"sheets_trigger":{"by":"user"}}'
            WHEN kind = 'view' AND k % 10 = 2 THEN '{"data_source_id":"scheduled_query"}'
            WHEN k % 10 = 9 THEN '{}'
            WHEN kind = 'signup' THEN
                '{"x-dashboard-uid":"d' || (k % 3) || '","x-panel-id":"p' || (k % 5) || '"}'
        END AS config_labels,
        CASE WHEN kind = 'purchase' THEN
            '/* {"app": "dbt", "dbt_version": '
            || (CASE WHEN k % 16 = 3 THEN '{"v": "1.3.0"}' ELSE '"1.3.0"' END) || ', "profile_name": "shop", '
            || '"target_name": "prod", "node_id": "'
            || (CASE k % 3 WHEN 0 THEN 'model' WHEN 1 THEN 'test' ELSE 'snapshot' END)
            || '.pkg.m' || (k % 10) || '"} */ select 1'
        ELSE 'select ' || k || ' from t' END AS query_statement,
        CAST(NULL AS BOOLEAN) AS is_query_truncated,
        CAST(NULL AS VARCHAR) AS destination_table,
        CAST(NULL AS VARCHAR) AS create_disposition,
        CAST(NULL AS VARCHAR) AS write_disposition,
        CAST(NULL AS VARCHAR) AS default_dataset,
        CAST(NULL AS VARCHAR) AS query_priority,
        CASE WHEN k % 6 = 5 THEN 'INSERT' ELSE 'SELECT' END AS statement_type
    FROM ev
    WHERE event_id % 50 <> 7
    """,
)
_step(
    "commented",
    r"""
    SELECT *, nullif(replace(replace(regexp_extract(
        query_statement, '^/\* \{[\s\S]+?\} \*/'), '/', ''), '*', ''), '') AS dbt_info
    FROM staged
    """,
)


def _jobs(where: str = "") -> str:
    return f"""
    SELECT {_key('job_id')} AS job_key, *
    FROM (
        SELECT DISTINCT
            dashboard_id, panel_id, job_id, project_id, event_type, resource_name,
            caller_ip_address, method_name, create_disposition, statement_type, query_priority,
            CASE WHEN json_type(dbt_info, '$.dbt_version') NOT IN ('OBJECT', 'ARRAY')
                THEN json_extract_string(dbt_info, '$.dbt_version') END AS dbt_version,
            json_extract_string(dbt_info, '$.profile_name') AS dbt_profile_name,
            json_extract_string(dbt_info, '$.target_name') AS dbt_target_name,
            CASE split_part(json_extract_string(dbt_info, '$.node_id'), '.', 1)
                WHEN 'model' THEN 'DBT_RUN'
                WHEN 'snapshot' THEN 'DBT_SNAPSHOT'
                WHEN 'test' THEN 'DBT_TEST'
            END AS dbt_execution_type,
            split_part(json_extract_string(dbt_info, '$.node_id'), '.', 2) || '.'
                || split_part(json_extract_string(dbt_info, '$.node_id'), '.', 3) AS dbt_model_name,
            cache_hit
        FROM commented
        {where})
    """


_step("job", _jobs())
_step("job_earlier", _jobs(f"WHERE CAST(event_timestamp AS DATE) < {AS_OF} - 3"))
_step("job_recent", _jobs(f"WHERE CAST(event_timestamp AS DATE) >= {AS_OF} - 3"))
_step(
    "query_statements",
    f"""
    SELECT DISTINCT {_key('job_id')} AS job_key, query_statement, job_id, dbt_info FROM commented
    """,
)
_step(
    "labels",
    f"""
    SELECT DISTINCT {_key('job_id')} AS job_key,
        split_part(label, ':', 1) AS label_key,
        CASE WHEN contains(label, ':') THEN split_part(label, ':', 2) END AS label_value
    FROM (
        SELECT job_id, unnest(string_split(
            regexp_replace(config_labels, '[{{}}"]', '', 'g'), ',')) AS label
        FROM staged)
    WHERE label <> ''
    """,
)
_step(
    "refs",
    f"""
    SELECT job_key, object AS referenced_view_or_table, object_type, project_id, dataset_id,
        table_or_view_id,
        project_id || '.' || dataset_id || '.' || table_or_view_id AS qualified_table_name,
        CASE
            WHEN dataset_id IN ('staging') THEN 'stage'
            WHEN dataset_id IN ('marts') THEN 'prod'
            WHEN dataset_id IS NULL THEN 'None'
            ELSE 'raw'
        END AS layer_used
    FROM (
        SELECT DISTINCT {_key('job_id')} AS job_key, object, object_type,
            string_split(object, '/')[2] AS project_id,
            string_split(object, '/')[4] AS dataset_id,
            string_split(object, '/')[6] AS table_or_view_id
        FROM (
            SELECT job_id, unnest(referenced_views) AS object, 'view' AS object_type FROM staged
            UNION ALL
            SELECT job_id, unnest(referenced_tables), 'table' FROM staged))
    """,
)
_step(
    "users",
    f"""
    SELECT DISTINCT principal_email, project_id,
        nullif(split_part(principal_email, '@', 1), '') AS username,
        CASE WHEN principal_email LIKE '%.iam.gserviceaccount.com' THEN 'Service Account'
            ELSE 'User' END AS user_type,
        {_key('principal_email', 'project_id')} AS user_key
    FROM staged
    """,
)


def _agents(custom: str = "") -> str:
    return f"""
    SELECT DISTINCT
        {_key('caller_supplied_user_agent', 'principal_email', 'project_id')} AS user_agent_key,
        caller_supplied_user_agent, principal_email, project_id,
        CASE
            {custom}
            WHEN json_extract_string(config_labels, '$.sheets_trigger') = 'user'
                THEN 'Connected Sheet - User Initiated'
            WHEN json_extract_string(config_labels, '$.sheets_trigger') = 'schedule'
                THEN 'Connected Sheet - Scheduled'
            WHEN json_extract_string(config_labels, '$.data_source_id') = 'scheduled_query'
                THEN 'Scheduled Query'
            WHEN starts_with(caller_supplied_user_agent, 'Mozilla') THEN 'Web console'
            WHEN json_extract_string(config_labels, '$.dbt_invocation_id') IS NOT NULL
                OR starts_with(caller_supplied_user_agent, 'dbt') THEN 'dbt run'
            WHEN starts_with(caller_supplied_user_agent, 'gl-python') THEN 'Python Client'
            WHEN starts_with(caller_supplied_user_agent, 'gcloud-golang-bigquery')
                AND starts_with(principal_email, 'rudderstack') THEN 'Rudderstack'
            WHEN starts_with(caller_supplied_user_agent, 'gcloud-golang') THEN 'Golang Client'
            WHEN starts_with(caller_supplied_user_agent, 'SimbaJDBCDriver') THEN 'Java Client'
            ELSE coalesce(caller_supplied_user_agent, 'Unknown')
        END AS client_type
    FROM staged
    """


_step("agents", _agents())
_step(
    "agents_custom",
    _agents(
        "WHEN starts_with(caller_supplied_user_agent, 'Mozilla/5.0') "
        "AND contains(principal_email, 'user1') THEN 'Custom'"
    ),
)
_step(
    "errors",
    f"""
    SELECT DISTINCT {_key("coalesce(error_result_code, 'NONE')",
                          "coalesce(error_result_message, 'NONE')")} AS error_message_key,
        coalesce(error_result_code, 'NONE') AS error_result_code,
        coalesce(error_result_message, 'NONE') AS error_result_message
    FROM staged
    """,
)
_step(
    "fct",
    f"""
    SELECT DISTINCT
        {_key('job_id')} AS job_key,
        {_key("coalesce(error_result_code, 'NONE')", "coalesce(error_result_message, 'NONE')")}
            AS error_message_key,
        {_key('principal_email', 'project_id')} AS user_key,
        {_key('caller_supplied_user_agent', 'principal_email', 'project_id')} AS user_agent_key,
        start_time, CAST(start_time AS DATE) AS statement_date, end_time,
        total_processed_bytes, total_billed_bytes, output_row_count, total_slot_ms, billing_tier
    FROM staged
    """,
)
_step(
    "calendar",
    f"""
    SELECT CAST(unnest(generate_series(
        (SELECT min(statement_date) FROM fct)::TIMESTAMP, {AS_OF}::TIMESTAMP, INTERVAL 1 DAY))
        AS DATE) AS date_day
    """,
)
_step(
    "active_users",
    f"""
    WITH human AS (
        SELECT * FROM staged WHERE principal_email NOT LIKE '%.iam.gserviceaccount.com'),
    tables AS (
        SELECT DISTINCT job_id, unnest(referenced_tables) AS table_name FROM human),
    seen AS (
        SELECT DISTINCT CAST(event_timestamp AS DATE) AS event_date, table_name, principal_email
        FROM human JOIN tables USING (job_id)),
    days AS (
        SELECT CAST(unnest(generate_series(
            (SELECT min(CAST(event_timestamp AS DATE)) FROM human)::TIMESTAMP,
            {AS_OF}::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS event_date),
    dense AS (
        SELECT event_date, table_name, principal_email
        FROM days
        CROSS JOIN (SELECT DISTINCT table_name FROM tables)
        CROSS JOIN (SELECT DISTINCT principal_email FROM human)),
    counted AS (
        SELECT dense.*, count(seen.principal_email) OVER (
            PARTITION BY dense.table_name, dense.principal_email ORDER BY dense.event_date
            ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS days_active
        FROM dense LEFT JOIN seen USING (event_date, table_name, principal_email)),
    daily AS (
        SELECT event_date, table_name,
            count(DISTINCT CASE WHEN days_active >= 5 THEN principal_email END) AS weekly,
            count(DISTINCT CASE WHEN days_active BETWEEN 1 AND 4 THEN principal_email END)
                AS monthly
        FROM counted GROUP BY ALL)
    SELECT event_date, table_name,
        CAST(sum(weekly) OVER w AS BIGINT) AS human_weekly_active_users_30_day_cnt,
        CAST(sum(monthly) OVER w AS BIGINT) AS human_monthly_active_users_30_day_cnt
    FROM daily
    WINDOW w AS (PARTITION BY table_name ORDER BY event_date
        ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
    """,
)
_step(
    "threat_base",
    f"""
    SELECT statement_date, referenced_view_or_table, layer_used, principal_email, user_type,
        total_billed_bytes, error_message_key <> {NO_ERROR} AS is_errored, dbt_execution_type
    FROM fct
    JOIN refs ON fct.job_key = refs.job_key AND refs.object_type = 'table'
    LEFT JOIN job ON fct.job_key = job.job_key
    JOIN users ON fct.user_key = users.user_key
    """,
)
_step(
    "object_days",
    "SELECT DISTINCT referenced_view_or_table, statement_date FROM threat_base",
)


def _threat(emails: str = "") -> str:
    def ranked(measure: str, condition: str) -> str:
        return f"""
        SELECT referenced_view_or_table, date_day, median,
            percent_rank() OVER (ORDER BY median NULLS FIRST) AS rnk
        FROM (
            SELECT *, quantile_cont(daily, 0.5) OVER (PARTITION BY referenced_view_or_table)
                AS median
            FROM (
                SELECT referenced_view_or_table, calendar.date_day,
                    CAST({measure} AS DOUBLE) AS daily
                FROM threat_base LEFT JOIN calendar ON date_day = statement_date
                WHERE {condition}
                GROUP BY ALL))
        """

    amount = "coalesce(sum(total_billed_bytes), 0)"
    return f"""
    WITH egress AS (
        SELECT *, percent_rank() OVER (ORDER BY n NULLS FIRST) AS rnk
        FROM (
            SELECT referenced_view_or_table, calendar.date_day,
                count(principal_email) * (CASE WHEN layer_used <> 'prod' THEN 5 ELSE 1 END) AS n
            FROM threat_base LEFT JOIN calendar ON date_day = statement_date
            WHERE user_type = 'Service Account' {emails}
            GROUP BY referenced_view_or_table, calendar.date_day, layer_used)),
    query AS ({ranked(amount, "user_type = 'User'")}),
    build AS ({ranked(amount, "user_type = 'Service Account' AND dbt_execution_type IS NOT NULL")}),
    errors AS ({ranked("count(*)", "is_errored")})
    SELECT * FROM (
        SELECT o.referenced_view_or_table, o.statement_date,
            coalesce(egress.n, 0) AS count_queries_with_multiplier,
            coalesce(egress.rnk, 0) AS percent_rank_count_queries_with_multiplier,
            {_on_demand('coalesce(query.median, 0)')} AS sum_daily_query_cost_median,
            coalesce(query.rnk, 0) AS percent_rank_sum_daily_query_cost,
            {_on_demand('coalesce(build.median, 0)')} AS sum_daily_build_cost_median,
            coalesce(build.rnk, 0) AS percent_rank_daily_build_cost,
            coalesce(errors.median, 0) AS median_count_daily_errors,
            coalesce(errors.rnk, 0) AS percent_rank_daily_errors,
            coalesce(egress.rnk, 0) * 0.35::DOUBLE + coalesce(query.rnk, 0) * 0.3::DOUBLE
                + coalesce(build.rnk, 0) * 0.25::DOUBLE + coalesce(errors.rnk, 0) * 0.1::DOUBLE
                AS threat_score
        FROM object_days AS o
        LEFT JOIN egress ON o.referenced_view_or_table = egress.referenced_view_or_table
            AND o.statement_date = egress.date_day
        LEFT JOIN query ON o.referenced_view_or_table = query.referenced_view_or_table
            AND o.statement_date = query.date_day
        LEFT JOIN build ON o.referenced_view_or_table = build.referenced_view_or_table
            AND o.statement_date = build.date_day
        LEFT JOIN errors ON o.referenced_view_or_table = errors.referenced_view_or_table
            AND o.statement_date = errors.date_day)
    WHERE threat_score > 0
    """


_step("threat", _threat())
_step(
    "threat_listed",
    _threat(
        "AND principal_email IN "
        "('svc5@p.iam.gserviceaccount.com', 'svc10@p.iam.gserviceaccount.com')"
    ),
)


def _ranked_use(source: str, measure: str) -> str:
    return f"""
        SELECT referenced_view_or_table, date_day, median,
            percent_rank() OVER (ORDER BY median NULLS FIRST) AS rnk
        FROM (
            SELECT *, quantile_cont(daily, 0.5) OVER (PARTITION BY referenced_view_or_table)
                AS median
            FROM (
                SELECT referenced_view_or_table, calendar.date_day,
                    CAST({measure} AS DOUBLE) AS daily
                FROM {source} LEFT JOIN calendar ON date_day = statement_date
                GROUP BY ALL))
    """


_step(
    "importance",
    f"""
    WITH base AS (
        SELECT statement_date, fct.job_key, referenced_view_or_table, user_type, user_agent_key
        FROM fct
        JOIN refs ON fct.job_key = refs.job_key AND refs.object_type = 'table'
        JOIN users ON fct.user_key = users.user_key),
    service AS (SELECT * FROM base WHERE user_type = 'Service Account'),
    labelled AS (
        SELECT service.*, label_value FROM service
        LEFT JOIN labels ON service.job_key = labels.job_key
            AND label_key = 'dbt_invocation_id'),
    scored AS (
        SELECT service.*, CASE
            WHEN client_type = 'Web console' THEN 1
            WHEN client_type IN ('Connected Sheet - User Initiated',
                'Connected Sheet - Scheduled', 'Scheduled Query') THEN 2
            ELSE 0 END AS points
        FROM service JOIN agents ON service.user_agent_key = agents.user_agent_key),
    r_service AS ({_ranked_use('service', 'count(job_key)')}),
    r_dbt AS ({_ranked_use('labelled', 'count(label_value)')}),
    r_egress AS ({_ranked_use('scored', 'sum(points)')}),
    r_breadth AS (
        SELECT *, percent_rank() OVER (ORDER BY median NULLS FIRST) AS rnk
        FROM (
            SELECT table_name AS referenced_view_or_table, event_date AS date_day,
                quantile_cont(CAST(human_monthly_active_users_30_day_cnt AS DOUBLE), 0.5)
                    OVER (PARTITION BY table_name) AS median
            FROM active_users))
    SELECT o.referenced_view_or_table AS table_name, o.statement_date AS score_date,
        a.median AS service_acct_median_queries, a.rnk AS service_acct_percent_rank,
        b.median AS dbt_median_queries, b.rnk AS dbt_percent_rank,
        c.median AS egress_median_queries, c.rnk AS egress_percent_rank,
        d.median AS active_user_median, d.rnk AS active_user_percent_rank,
        a.rnk * 0.2::DOUBLE + b.rnk * 0.2::DOUBLE + c.rnk * 0.35::DOUBLE + d.rnk * 0.25::DOUBLE
            AS importance_score
    FROM object_days AS o
    LEFT JOIN r_service AS a ON o.referenced_view_or_table = a.referenced_view_or_table
        AND o.statement_date = a.date_day
    LEFT JOIN r_dbt AS b ON o.referenced_view_or_table = b.referenced_view_or_table
        AND o.statement_date = b.date_day
    LEFT JOIN r_egress AS c ON o.referenced_view_or_table = c.referenced_view_or_table
        AND o.statement_date = c.date_day
    LEFT JOIN r_breadth AS d ON o.referenced_view_or_table = d.referenced_view_or_table
        AND o.statement_date = d.date_day
    """,
)
_step(
    "table_usage",
    f"""
    WITH used AS (
        SELECT calendar.date_day AS report_date, t.table_name, refs.project_id, refs.dataset_id,
            refs.table_or_view_id, refs.qualified_table_name, refs.layer_used AS layer,
            agents.client_type,
            count(fct.job_key) AS total_queries_run,
            count(DISTINCT CASE WHEN dbt_execution_type = 'DBT_RUN' THEN dbt_model_name END)
                AS dbt_models_run,
            count(DISTINCT CASE WHEN dbt_execution_type = 'DBT_TEST' THEN dbt_model_name END)
                AS dbt_tests_run,
            count(DISTINCT CASE WHEN user_type = 'User' THEN fct.user_key END)
                AS total_human_users,
            count(DISTINCT CASE WHEN user_type = 'Service Account' THEN fct.user_key END)
                AS total_service_accounts,
            CAST(sum(CASE WHEN error_message_key <> {NO_ERROR} THEN 1 ELSE 0 END) AS BIGINT)
                AS total_errors
        FROM calendar
        CROSS JOIN (SELECT DISTINCT referenced_view_or_table AS table_name FROM refs) AS t
        LEFT JOIN refs ON t.table_name = refs.referenced_view_or_table
        LEFT JOIN fct ON refs.job_key = fct.job_key AND calendar.date_day = fct.statement_date
        LEFT JOIN agents ON fct.user_agent_key = agents.user_agent_key
        LEFT JOIN users ON fct.user_key = users.user_key
        LEFT JOIN job ON fct.job_key = job.job_key
        GROUP BY ALL)
    SELECT DISTINCT used.*, threat.threat_score, importance.importance_score,
        importance.importance_score * 0.35::DOUBLE + threat.threat_score * 0.65::DOUBLE
            AS priority_score
    FROM used
    LEFT JOIN threat ON used.table_name = threat.referenced_view_or_table
        AND used.report_date = threat.statement_date
    LEFT JOIN importance ON used.table_name = importance.table_name
        AND used.report_date = importance.score_date
    """,
)


def _amount(condition: str, measure: str = "total_billed_bytes") -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN {measure} END), 0)"


_step(
    "usage_cost",
    f"""
    SELECT calendar.date_day AS report_date, agents.client_type, agents.project_id,
        count(fct.job_key) AS total_queries_run,
        {_on_demand(_amount('true'))} AS total_estimated_cost_usd,
        {_on_demand(_amount("dbt_execution_type = 'DBT_RUN'"))}
            AS total_estimated_dbt_run_build_cost_usd,
        {_on_demand(_amount("dbt_execution_type = 'DBT_TEST'"))}
            AS total_estimated_dbt_test_build_cost_usd,
        CAST(coalesce(sum(total_slot_ms), 0) AS BIGINT) AS total_time_ms,
        {_on_demand(_amount("lower(statement_type) = 'select'"))}
            AS total_estimated_query_cost_usd,
        CAST({_amount("lower(statement_type) = 'select'", "total_slot_ms")} AS BIGINT)
            AS total_query_time_ms
    FROM calendar
    CROSS JOIN agents
    LEFT JOIN fct ON agents.user_agent_key = fct.user_agent_key
        AND calendar.date_day = fct.statement_date
    LEFT JOIN job ON fct.job_key = job.job_key
    GROUP BY ALL
    """,
)


def _rate(part: str, whole: str, scale: str = "") -> str:
    return (
        f"round(coalesce(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0), 0::DOUBLE)"
        f"{scale}, 3)"
    )


_step(
    "user_metrics",
    f"""
    WITH tables_per_job AS (
        SELECT fct.job_key,
            sum(CASE WHEN layer_used = 'prod' THEN 1 ELSE 0 END) AS prod,
            sum(CASE WHEN layer_used = 'stage' THEN 1 ELSE 0 END) AS stage,
            sum(CASE WHEN layer_used = 'raw' THEN 1 ELSE 0 END) AS raw,
            count(*) AS used
        FROM fct JOIN refs ON fct.job_key = refs.job_key
        GROUP BY fct.job_key),
    totals AS (
        SELECT calendar.date_day AS report_date, users.username, users.user_type,
            users.project_id,
            count(fct.job_key) AS total_queries_run,
            CAST(sum(CASE WHEN error_message_key <> {NO_ERROR} THEN 1 ELSE 0 END) AS BIGINT)
                AS total_errors,
            CAST(coalesce(sum(prod), 0) AS BIGINT) AS total_prod_tables_used,
            CAST(coalesce(sum(stage), 0) AS BIGINT) AS total_stage_tables_used,
            CAST(coalesce(sum(raw), 0) AS BIGINT) AS total_raw_tables_used,
            CAST(coalesce(sum(used), 0) AS BIGINT) AS total_tables_used,
            {_on_demand(_amount('true'))} AS total_estimated_cost_usd,
            CAST(coalesce(sum(total_slot_ms), 0) AS BIGINT) AS total_time_ms
        FROM calendar
        CROSS JOIN users
        LEFT JOIN fct ON fct.user_key = users.user_key AND fct.statement_date = calendar.date_day
        LEFT JOIN job ON fct.job_key = job.job_key AND lower(job.statement_type) = 'select'
        LEFT JOIN tables_per_job ON fct.job_key = tables_per_job.job_key
        GROUP BY ALL)
    SELECT *,
        {_rate('total_errors', 'total_queries_run', ' * 100::DOUBLE')} AS error_rate,
        {_rate('total_prod_tables_used', 'total_tables_used', ' * 100::DOUBLE')}
            AS prod_table_use_rate,
        {_rate('total_stage_tables_used', 'total_tables_used', ' * 100::DOUBLE')}
            AS stage_table_use_rate,
        {_rate('total_raw_tables_used', 'total_tables_used', ' * 100::DOUBLE')}
            AS raw_table_use_rate
    FROM totals
    """,
)


def _by_kind(template: str) -> str:
    kinds = (("build", "run", "DBT_RUN"), ("test", "test", "DBT_TEST"), ("snapshot", "snapshot", "DBT_SNAPSHOT"))
    return ",\n            ".join(template.format(kind=k, name=n, type=t) for k, n, t in kinds)


_step(
    "dbt_metrics",
    f"""
    WITH invocations AS (
        SELECT calendar.date_day AS report_date, job.dbt_model_name, label_value,
            {_by_kind("sum(CASE WHEN dbt_execution_type = '{type}' THEN 1 ELSE 0 END) AS {kind}s")},
            {_by_kind("coalesce(sum(CASE WHEN dbt_execution_type = '{type}' "
                      "THEN total_billed_bytes END), 0) AS {kind}_bytes")},
            {_by_kind("coalesce(sum(CASE WHEN dbt_execution_type = '{type}' "
                      "THEN date_sub('millisecond', start_time, end_time) END), 0) AS {kind}_ms")}
        FROM calendar
        JOIN fct ON calendar.date_day = fct.statement_date
        JOIN labels ON fct.job_key = labels.job_key
        JOIN job ON fct.job_key = job.job_key
        WHERE job.dbt_execution_type IS NOT NULL AND label_key = 'dbt_invocation_id'
        GROUP BY ALL),
    totals AS (
        SELECT report_date, dbt_model_name,
            {_by_kind("CAST(sum(CASE WHEN {kind}s > 0 THEN 1 ELSE 0 END) AS BIGINT) "
                      "AS total_dbt_{kind}s")},
            {_by_kind(_on_demand("sum({kind}_bytes)") + " AS total_estimated_dbt_{name}_cost_usd")},
            {_by_kind("CAST(sum({kind}_ms) AS BIGINT) AS total_estimated_dbt_{kind}_time_ms")}
        FROM invocations GROUP BY ALL)
    SELECT *,
        {_by_kind(_rate("total_estimated_dbt_{name}_cost_usd", "total_dbt_{kind}s")
                  + " AS average_{kind}_cost")},
        {_by_kind(_rate("total_estimated_dbt_{kind}_time_ms", "total_dbt_{kind}s")
                  + " AS average_{kind}_time_ms")}
    FROM totals
    """,
)
_step(
    "query_alerting",
    f"""
    SELECT fct.start_time, users.username, users.user_type,
        {_on_demand('total_billed_bytes')} AS query_cost, query_statement
    FROM fct
    JOIN users ON users.user_key = fct.user_key
    JOIN query_statements ON query_statements.job_key = fct.job_key
    WHERE CAST(fct.start_time AS DATE) >= {AS_OF} - 2
    """,
)
_step(
    "date_1",
    """
    SELECT date_day,
        CAST(month(date_day) AS BIGINT) AS month_actual,
        CAST(year(date_day) AS BIGINT) AS year_actual,
        CAST(quarter(date_day) AS BIGINT) AS quarter_actual,
        CAST(day(date_day) AS BIGINT) AS day_of_month,
        CAST(dayofweek(date_day) + 1 AS BIGINT) AS day_of_week,
        CAST(date_trunc('month', date_day) AS DATE) AS first_day_of_month,
        date_day - CAST(dayofweek(date_day) AS INTEGER) AS first_day_of_week,
        CAST(strftime(date_day, '%U') AS BIGINT) AS sunday_week,
        CASE WHEN month(date_day) = 1 THEN 12 ELSE month(date_day) - 1 END AS month_of_fiscal_year,
        CASE WHEN month(date_day) = 1 THEN year(date_day) ELSE year(date_day) + 1 END AS fiscal_year,
        CASE WHEN month(date_day) IN (2, 3, 4) THEN '1' WHEN month(date_day) IN (5, 6, 7) THEN '2'
            WHEN month(date_day) IN (8, 9, 10) THEN '3' ELSE '4' END AS fiscal_quarter
    FROM (SELECT CAST(unnest(generate_series(
        TIMESTAMP '2010-01-01', TIMESTAMP '2050-01-01', INTERVAL 1 DAY)) AS DATE) AS date_day)
    """,
)
_step(
    "date_2",
    """
    SELECT *,
        fiscal_year || '-Q' || fiscal_quarter AS fiscal_quarter_name,
        fiscal_year || '-' || month_actual AS fiscal_month_name,
        row_number() OVER (PARTITION BY year_actual, quarter_actual ORDER BY date_day)
            AS day_of_quarter,
        row_number() OVER (PARTITION BY year_actual ORDER BY date_day) AS day_of_year,
        row_number() OVER (PARTITION BY fiscal_year, fiscal_quarter ORDER BY date_day)
            AS day_of_fiscal_quarter,
        row_number() OVER (PARTITION BY fiscal_year ORDER BY date_day) AS day_of_fiscal_year,
        min(date_day) OVER (PARTITION BY year_actual) AS first_day_of_year,
        min(date_day) OVER (PARTITION BY year_actual, quarter_actual) AS first_day_of_quarter,
        min(date_day) OVER (PARTITION BY fiscal_year, fiscal_quarter)
            AS first_day_of_fiscal_quarter,
        max(date_day) OVER (PARTITION BY fiscal_year, fiscal_quarter)
            AS last_day_of_fiscal_quarter,
        min(date_day) OVER (PARTITION BY fiscal_year) AS first_day_of_fiscal_year,
        max(date_day) OVER (PARTITION BY fiscal_year) AS last_day_of_fiscal_year,
        max(date_day) OVER (PARTITION BY first_day_of_week) AS last_day_of_week,
        count(*) OVER (PARTITION BY first_day_of_month) AS days_in_month_count,
        count(*) FILTER (day_of_week = 1) OVER (ORDER BY date_day) AS sundays,
        strftime(first_day_of_month, '%U') AS week_at_month_start
    FROM date_1
    """,
)
_step(
    "dates",
    f"""
    SELECT d.date_day, d.date_day AS date_actual,
        CAST(d.date_day AS TIMESTAMP) AS start_of_day_timestamp,
        CAST(d.date_day + 1 AS TIMESTAMP) - INTERVAL 1 SECOND AS end_of_day_timestamp,
        strftime(d.date_day, '%A') AS day_name,
        strftime(d.date_day, '%B') AS month_name,
        strftime(d.date_day, '%b') AS abbreviated_month_name,
        strftime(d.date_day, '%b') || '''' || right(strftime(d.date_day, '%G'), 2)
            AS formatted_month_year_name,
        d.month_actual, d.year_actual, d.quarter_actual, d.day_of_month, d.day_of_week,
        d.sunday_week + 1 AS week_of_year,
        CAST(d.month_of_fiscal_year AS BIGINT) AS month_of_fiscal_year,
        CAST(d.fiscal_year AS BIGINT) AS fiscal_year, d.days_in_month_count,
        d.first_day_of_month, d.first_day_of_week,
        last_day(d.date_day) AS last_day_of_month,
        make_date(CAST(d.year_actual AS INTEGER), 12, 31) AS last_day_of_year,
        last_day(make_date(CAST(d.year_actual AS INTEGER), CAST(d.quarter_actual * 3 AS INTEGER), 1))
            AS last_day_of_quarter,
        CASE strftime(d.date_day, '%m%d') WHEN '0101' THEN 'New Years Day'
            WHEN '1225' THEN 'Christmas Day' WHEN '1226' THEN 'Boxing Day' END AS holiday_desc,
        strftime(d.date_day, '%m%d') IN ('0101', '1225', '1226') AS is_holiday,
        CASE WHEN d.date_day < {AS_OF}
                THEN CAST(d.date_day + 1 AS TIMESTAMP) - INTERVAL 1 SECOND
            WHEN d.date_day = {AS_OF} THEN CAST(d.date_day AS TIMESTAMP)
        END AS snapshot_join_timestamp,
        d.fiscal_quarter, d.fiscal_month_name, d.fiscal_quarter_name,
        d.year_actual || '-Q' || d.quarter_actual AS quarter_name,
        'FY' || substr(d.fiscal_month_name, 3, 8) AS fiscal_month_name_fy,
        'FY' || substr(d.fiscal_quarter_name, 3, 7) AS fiscal_quarter_name_fy,
        d.day_of_week = 1 AS is_first_day_of_week,
        d.date_day = last_day(d.date_day) AS is_last_day_of_month,
        d.day_of_week BETWEEN 2 AND 6 AS is_weekday,
        d.day_of_quarter, d.day_of_year, d.day_of_fiscal_quarter, d.day_of_fiscal_year,
        d.first_day_of_year, d.first_day_of_quarter, d.first_day_of_fiscal_quarter,
        d.last_day_of_fiscal_quarter, d.first_day_of_fiscal_year, d.last_day_of_fiscal_year,
        d.last_day_of_week,
        md5(CAST(d.date_day AS VARCHAR)) AS date_key,
        d.sundays - fy.sundays + 1 AS week_of_fiscal_year,
        d.sundays - fq.sundays + 1 AS week_of_fiscal_quarter,
        d.sunday_week + 1 - CAST(d.week_at_month_start AS BIGINT) AS week_of_month,
        dense_rank() OVER (ORDER BY d.fiscal_quarter_name) AS fiscal_quarter_number_absolute,
        CAST(date_trunc('month', d.last_day_of_fiscal_quarter) AS DATE)
            AS last_month_of_fiscal_quarter,
        CAST(date_trunc('month', d.last_day_of_fiscal_year) AS DATE) AS last_month_of_fiscal_year,
        CAST(date_trunc('month', d.last_day_of_fiscal_quarter) AS DATE) = d.date_day
            AS is_first_day_of_last_month_of_fiscal_quarter,
        CAST(date_trunc('month', d.last_day_of_fiscal_year) AS DATE) = d.date_day
            AS is_first_day_of_last_month_of_fiscal_year
    FROM date_2 AS d
    JOIN date_2 AS fy ON fy.date_day = d.first_day_of_fiscal_year
    JOIN date_2 AS fq ON fq.date_day = d.first_day_of_fiscal_quarter
    """,
)


def _uses(sql: str, name: str) -> bool:
    words = "".join(c if c.isalnum() or c == "_" else " " for c in sql).split()
    return name in words


def _query(sql: str, steps: dict[str, str]) -> str:
    """The statement with the steps it needs in front."""
    sql = textwrap.dedent(sql).strip()
    needed: list[str] = []
    text = sql
    for name in reversed(steps):
        if _uses(text, name):
            needed.insert(0, name)
            text += " " + steps[name]
    return "WITH " + ",\n".join(f"{name} AS (\n{steps[name]}\n)" for name in needed) + f"\n{sql}"


def oracle_sql(staged: str | None = None) -> dict[str, str]:
    """SQL by query name. `staged` is SQL for another staged log than that of the given tables."""
    steps = _STEPS if staged is None else _STEPS | {"staged": staged}
    whole = {
        "dim_job": "job",
        "dim_query_statements": "query_statements",
        "dim_job_labels": "labels",
        "dim_references": "refs",
        "dim_users": "users",
        "dim_user_agents": "agents",
        "dim_user_agents_custom": "agents_custom",
        "dim_errors": "errors",
        "fct_statements": "fct",
        "table_active_users": "active_users",
        "threat_score": "threat",
        "threat_score_egress_list": "threat_listed",
        "importance_score": "importance",
        "object_days": "object_days",
        "rpt_table_usage": "table_usage",
        "rpt_usage_cost": "usage_cost",
        "rpt_user_metrics": "user_metrics",
        "rpt_dbt_metrics": "dbt_metrics",
        "rpt_query_alerting": "query_alerting",
        "calendar_spine": "calendar",
        "write_full": "errors",
        "write_partitions": "fct",
    }
    queries = {name: f"SELECT * FROM {step}" for name, step in whole.items()}
    lists = ", ".join(
        f"array_to_string({c}, ' ') AS {c}" for c in ("referenced_tables", "referenced_views")
    )
    as_text = f"SELECT * REPLACE ({lists}) FROM staged"
    queries |= {
        "stage_audit_log": as_text,
        "incremental_lookback": f"{as_text} WHERE CAST(event_timestamp AS DATE) >= {AS_OF} - 3",
        "dev_limit": f"{as_text} WHERE CAST(event_timestamp AS DATE) >= {AS_OF} - 10",
        "upsert_by_key": """
            SELECT * FROM job_earlier AS e
            WHERE NOT EXISTS (SELECT * FROM job_recent AS r WHERE r.job_key = e.job_key
                AND r.caller_ip_address IS NOT DISTINCT FROM e.caller_ip_address)
            UNION ALL SELECT * FROM job_recent
        """,
        "dim_date": """
            SELECT dates.*, coalesce(n, 0) AS executed_statements
            FROM dates LEFT JOIN (SELECT statement_date, count(*) AS n FROM fct GROUP BY ALL) AS f
                ON dates.date_day = f.statement_date
        """,
        "job_cost": f"""
            SELECT job_key, start_time, {_on_demand('total_billed_bytes')} AS query_cost FROM fct
        """,
        "job_cost_slots": f"""
            SELECT job_key, start_time, {_slots('total_slot_ms')} AS query_cost FROM fct
        """,
        "read_report": f"""
            SELECT * FROM usage_cost
            WHERE report_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
        """,
        "check_unique_combination": """
            SELECT job_key, label_key FROM labels GROUP BY ALL HAVING count(*) > 1
        """,
        "check_unique": """
            SELECT user_agent_key, count(*) AS n_records FROM agents GROUP BY ALL HAVING count(*) > 1
        """,
        "check_not_null": "SELECT * FROM agents WHERE caller_supplied_user_agent IS NULL",
    }
    return {name: _query(sql, steps) for name, sql in queries.items()}
