"""Daily reports and the alerting feed.

Executions are added up per job, and where a job's attributes or references would repeat them, the
number of repeats is multiplied in. So no join emits a row per execution and repeat. Rows for days
without use are united with the measured rows before the last aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.columns import cost, cost_measure, exact, is_error, safe_rate
from auditlens.operators.dates import first_day, in_calendar, with_days
from auditlens.operators.marts import path_columns
from auditlens.operators.scores import OBJECT
from auditlens.session import settle
from auditlens.settings import Settings

# Fixed value: days before today that the alerting feed reaches back to.
ALERTING_DAYS = 2



def _limit(settings: Settings, since: dt.date | None) -> dt.date | None:
    """The first day to report, by the development limit and the run."""
    limits = [day for day in (settings.dev_limit_start, since) if day is not None]
    return max(limits, default=None)


def _reported(facts: DataFrame, settings: Settings, since: dt.date | None = None) -> DataFrame:
    """Executions on the days to report."""
    reported = facts.filter(in_calendar("statement_date", settings))
    limit = _limit(settings, since)
    return reported if limit is None else reported.filter(F.col("statement_date") >= F.lit(limit))


def _report_start(facts: DataFrame, settings: Settings, since: dt.date | None = None) -> Column:
    start = first_day(facts, "statement_date")
    limit = _limit(settings, since)
    # `greatest` skips NULL, and without executions there must be no day.
    return start if limit is None else F.when(start.isNotNull(), F.greatest(start, F.lit(limit)))


def _zero_filled(
    measured: DataFrame, entities: DataFrame, facts: DataFrame, settings: Settings
) -> DataFrame:
    """Measures added up per day and entity, with a row of zeros where there is none.

    Grouping takes NULL entities together, as a null-safe join would.
    """
    keys = ["report_date", *entities.columns]
    measures = [c for c in measured.columns if c not in keys]
    spine = with_days(
        entities.distinct(), _report_start(facts, settings), settings, "report_date"
    )
    zeros = spine.select(
        *keys, *(F.lit(0).cast(measured.schema[m].dataType).alias(m) for m in measures)
    )
    return (
        measured.select(*keys, *measures)
        .unionByName(zeros)
        .groupBy(*keys)
        .agg(*(F.sum(m).alias(m) for m in measures))
    )


def rpt_usage_cost(
    facts: DataFrame, jobs: DataFrame, agents: DataFrame, settings: Settings
) -> DataFrame:
    """Queries, cost and slot time per day, client type and project."""
    amount = exact(cost_measure(settings))
    executions = (
        _reported(facts, settings)
        .groupBy("job_key", "statement_date", "user_agent_key")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(amount), F.lit(0)).alias("amount"),
            F.coalesce(F.sum(exact("total_slot_ms")), F.lit(0)).alias("slot_ms"),
        )
    )
    repeats = jobs.groupBy("job_key").agg(
        F.count("*").alias("job_rows"),
        F.count_if(F.col("dbt_execution_type") == "DBT_RUN").alias("run_rows"),
        F.count_if(F.col("dbt_execution_type") == "DBT_TEST").alias("test_rows"),
        F.count_if(F.lower("statement_type") == "select").alias("select_rows"),
    )

    def times(measure: str, rows: str, default: int = 0) -> Column:
        return F.sum(F.col(measure) * F.coalesce(F.col(rows), F.lit(default)))

    by_agent = (
        executions.join(repeats, "job_key", "left")
        .groupBy("user_agent_key", F.col("statement_date").alias("report_date"))
        .agg(
            times("n", "job_rows", 1).alias("queries"),
            times("amount", "job_rows", 1).alias("amount"),
            times("amount", "run_rows").alias("run_amount"),
            times("amount", "test_rows").alias("test_amount"),
            times("slot_ms", "job_rows", 1).alias("slot_ms"),
            times("amount", "select_rows").alias("select_amount"),
            times("slot_ms", "select_rows").alias("select_slot_ms"),
        )
    )
    clients = agents.select("user_agent_key", "client_type", "project_id")
    measured = by_agent.join(clients, "user_agent_key").drop("user_agent_key")
    totals = _zero_filled(
        measured, clients.select("client_type", "project_id"), facts, settings
    )
    return totals.select(
        "report_date",
        "client_type",
        "project_id",
        F.col("queries").alias("total_queries_run"),
        cost("amount", settings).alias("total_estimated_cost_usd"),
        cost("run_amount", settings).alias("total_estimated_dbt_run_build_cost_usd"),
        cost("test_amount", settings).alias("total_estimated_dbt_test_build_cost_usd"),
        F.col("slot_ms").cast("bigint").alias("total_time_ms"),
        cost("select_amount", settings).alias("total_estimated_query_cost_usd"),
        F.col("select_slot_ms").cast("bigint").alias("total_query_time_ms"),
    )


def rpt_user_metrics(
    facts: DataFrame, jobs: DataFrame, refs: DataFrame, users: DataFrame, settings: Settings
) -> DataFrame:
    """Queries, errors, tables used, cost and rates per day and user.

    The tables of a job count once per execution of the job, for each of its executions; so a job
    with n executions brings n times n times its tables.
    """
    amount = exact(cost_measure(settings))
    executions = (
        _reported(facts, settings)
        .groupBy("job_key", "statement_date", "user_key")
        .agg(
            F.count("*").alias("n"),
            F.count_if(is_error("error_message_key")).alias("errors"),
            F.coalesce(F.sum(amount), F.lit(0)).alias("amount"),
            F.coalesce(F.sum(exact("total_slot_ms")), F.lit(0)).alias("slot_ms"),
        )
    )
    # All executions of a job count here, also those on days that are not reported.
    job_executions = facts.groupBy("job_key").agg(F.count("*").alias("job_executions"))
    selects = (
        jobs.filter(F.lower("statement_type") == "select")
        .groupBy("job_key")
        .agg(F.count("*").alias("select_rows"))
    )
    tables = refs.groupBy("job_key").agg(
        F.count_if(F.col("layer_used") == "prod").alias("prod"),
        F.count_if(F.col("layer_used") == "stage").alias("stage"),
        F.count_if(F.col("layer_used") == "raw").alias("raw"),
        F.count("*").alias("tables"),
    )
    rows = F.coalesce("select_rows", F.lit(1))

    # The product grows with the square of the executions of a job, so it is a decimal.
    def used(layer: str) -> Column:
        whole = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(19,0)")
        each = whole(F.col("n") * rows) * whole(F.col("job_executions"))
        return F.sum(each.cast("decimal(38,0)") * whole(F.col(layer))).alias(layer)

    by_user = (
        executions.join(job_executions, "job_key")
        .join(selects, "job_key", "left")
        .join(tables, "job_key", "left")
        .groupBy("user_key", F.col("statement_date").alias("report_date"))
        .agg(
            F.sum(F.col("n") * rows).alias("total_queries_run"),
            F.sum(F.col("errors") * rows).alias("total_errors"),
            used("prod"),
            used("stage"),
            used("raw"),
            used("tables"),
            F.sum(F.col("amount") * rows).alias("amount"),
            F.sum(F.col("slot_ms") * rows).alias("slot_ms"),
        )
    )
    people = users.select("user_key", "username", "user_type", "project_id")
    measured = by_user.join(people, "user_key").drop("user_key")
    totals = _zero_filled(measured, people.drop("user_key"), facts, settings)
    return totals.select(
        "report_date",
        "username",
        "user_type",
        "project_id",
        "total_queries_run",
        "total_errors",
        # NULL where a total is beyond a whole number of 64 bits.
        F.col("prod").try_cast("bigint").alias("total_prod_tables_used"),
        F.col("stage").try_cast("bigint").alias("total_stage_tables_used"),
        F.col("raw").try_cast("bigint").alias("total_raw_tables_used"),
        F.col("tables").try_cast("bigint").alias("total_tables_used"),
        cost("amount", settings).alias("total_estimated_cost_usd"),
        F.col("slot_ms").cast("bigint").alias("total_time_ms"),
        safe_rate("total_errors", "total_queries_run", 100.0).alias("error_rate"),
        safe_rate("prod", "tables", 100.0).alias("prod_table_use_rate"),
        safe_rate("stage", "tables", 100.0).alias("stage_table_use_rate"),
        safe_rate("raw", "tables", 100.0).alias("raw_table_use_rate"),
    )


def rpt_dbt_metrics(
    facts: DataFrame, jobs: DataFrame, labels: DataFrame, settings: Settings
) -> DataFrame:
    """Builds, tests and snapshots per day and model, with cost and time of each.

    The counts are of invocations that ran at least one such job.
    """
    executions = (
        _reported(facts, settings)
        .groupBy("job_key", F.col("statement_date").alias("report_date"))
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(exact(cost_measure(settings))), F.lit(0)).alias("amount"),
            F.coalesce(
                F.sum(F.timestamp_diff("MILLISECOND", F.col("start_time"), F.col("end_time"))),
                F.lit(0),
            ).alias("time_ms"),
        )
    )
    invocations = labels.filter("label_key = 'dbt_invocation_id'").select("job_key", "label_value")
    models = (
        jobs.filter("dbt_execution_type IS NOT NULL")
        .groupBy("job_key", "dbt_model_name", "dbt_execution_type")
        .agg(F.count("*").alias("rows"))
    )
    kinds = {"build": "DBT_RUN", "test": "DBT_TEST", "snapshot": "DBT_SNAPSHOT"}

    def of_kind(kind: str, measure: str) -> Column:
        hit = F.col("dbt_execution_type") == kinds[kind]
        return F.sum(F.when(hit, F.col(measure) * F.col("rows")).otherwise(F.lit(0)))

    by_invocation = (
        executions.join(models, "job_key")
        .join(invocations, "job_key")
        .groupBy("report_date", "dbt_model_name", "label_value")
        .agg(
            *(of_kind(k, "n").alias(f"{k}_jobs") for k in kinds),
            *(of_kind(k, "amount").alias(f"{k}_amount") for k in kinds),
            *(of_kind(k, "time_ms").alias(f"{k}_time") for k in kinds),
        )
    )
    totals = by_invocation.groupBy("report_date", "dbt_model_name").agg(
        *(F.count_if(F.col(f"{k}_jobs") > 0).alias(f"total_dbt_{k}s") for k in kinds),
        *(
            cost(F.sum(f"{k}_amount"), settings).alias(f"total_estimated_dbt_{name}_cost_usd")
            for k, name in (("build", "run"), ("test", "test"), ("snapshot", "snapshot"))
        ),
        *(F.sum(f"{k}_time").alias(f"total_estimated_dbt_{k}_time_ms") for k in kinds),
    )
    return totals.select(
        "*",
        *(
            safe_rate(f"total_estimated_dbt_{name}_cost_usd", f"total_dbt_{k}s").alias(
                f"average_{k}_cost"
            )
            for k, name in (("build", "run"), ("test", "test"), ("snapshot", "snapshot"))
        ),
        *(
            safe_rate(f"total_estimated_dbt_{k}_time_ms", f"total_dbt_{k}s").alias(
                f"average_{k}_time_ms"
            )
            for k in kinds
        ),
    )


def rpt_query_alerting(
    facts: DataFrame, users: DataFrame, statements: DataFrame, settings: Settings
) -> DataFrame:
    """Each execution of the last days with its user, cost and statement text.

    Where the statements have the last day of their job, those of jobs that ended before are not read;
    the table is kept in the order of these days. The rest meets the keys of the recent jobs before
    the texts are moved.
    """
    since = settings.as_of - dt.timedelta(days=ALERTING_DAYS)
    recent = facts.filter(F.col("statement_date") >= F.lit(since))
    if "last_day" in statements.columns:
        statements = statements.filter(F.col("last_day") >= F.lit(since))
    statements = statements.join(recent.select("job_key").distinct(), "job_key", "left_semi")
    people = users.select("user_key", "username", "user_type")
    return (
        recent.join(people, "user_key")
        .join(statements.select("job_key", "query_statement"), "job_key")
        .select(
            "start_time",
            "username",
            "user_type",
            cost(cost_measure(settings), settings).alias("query_cost"),
            "query_statement",
        )
    )


_USE_MEASURES = [
    "total_queries_run",
    "dbt_models_run",
    "dbt_tests_run",
    "total_human_users",
    "total_service_accounts",
    "total_errors",
]


def client_use(
    facts: DataFrame,
    jobs: DataFrame,
    refs: DataFrame,
    users: DataFrame,
    agents: DataFrame,
    settings: Settings,
    since: dt.date | None = None,
) -> DataFrame:
    """Use of tables and views per day and client type, on the days they were used.

    Users, with their executions, and models meet the objects of a job apart from each other, so the
    users of a job are never multiplied with its models.
    """
    clients = agents.select("user_agent_key", "client_type")
    people = users.select("user_key", "user_type")
    executions = (
        _reported(facts, settings, since)
        .select("job_key", "statement_date", "user_key", "user_agent_key", "error_message_key")
        .join(clients, "user_agent_key", "left")
        .join(people, "user_key", "left")
        .groupBy("job_key", "statement_date", "client_type", "user_key", "user_type")
        .agg(
            F.count("*").alias("n"),
            F.count_if(is_error("error_message_key")).alias("errors"),
        )
    )
    executions = settle(executions, "client-executions")
    job_rows = jobs.groupBy("job_key").agg(F.count("*").alias("job_rows"))
    objects = refs.groupBy("job_key", OBJECT, "layer_used").agg(F.count("*").alias("references"))
    by_client = ["statement_date", OBJECT, "layer_used", "client_type"]
    of_job = ["job_key", "statement_date", "client_type"]

    # The executions of a job count for each of its attribute rows and references.
    times = F.col("references") * F.coalesce("job_rows", F.lit(1))
    objects = objects.join(job_rows, "job_key", "left").select(
        "job_key", OBJECT, "layer_used", times.alias("times")
    )
    user_kinds = {"total_human_users": "User", "total_service_accounts": "Service Account"}
    known = F.col("user_type").isin(*user_kinds.values())
    by_user = executions.select(
        *of_job,
        F.when(known, F.col("user_type")).alias("kind"),
        F.when(known, F.col("user_key")).alias("key"),
        "n",
        "errors",
    )
    model_kinds = {"dbt_models_run": "DBT_RUN", "dbt_tests_run": "DBT_TEST"}
    models = (
        jobs.filter(F.col("dbt_execution_type").isin(*model_kinds.values()))
        .filter("dbt_model_name IS NOT NULL")
        .select("job_key", F.col("dbt_execution_type").alias("kind"), F.col("dbt_model_name").alias("key"))
        .distinct()
    )
    built = executions.select(*of_job).distinct().join(models, "job_key")
    # Executions without a known user have no kind. Rows of models have no executions; users and models
    # count once distinct, so totals need no rows of their own.
    parts = by_user.unionByName(built, allowMissingColumns=True)
    used = (
        parts.join(objects, "job_key")
        .groupBy(*by_client, "kind", "key")
        .agg(
            F.sum(F.col("n") * F.col("times")).alias("total_queries_run"),
            F.sum(F.col("errors") * F.col("times")).alias("total_errors"),
        )
    )
    return used.groupBy(*by_client).agg(
        F.sum("total_queries_run").alias("total_queries_run"),
        F.sum("total_errors").alias("total_errors"),
        *(
            F.count_if(F.col("kind") == value).alias(name)
            for name, value in (user_kinds | model_kinds).items()
        ),
    )


def rpt_table_usage(
    use: DataFrame,
    facts: DataFrame,
    refs: DataFrame,
    threat: DataFrame,
    importance: DataFrame,
    settings: Settings,
    since: dt.date | None = None,
) -> DataFrame:
    """`client_use` with the scores of the day, and the days without use.

    An object has a row of zeros without client on each day on which not all its references were
    executed. `since` reports the days from there on only. `use` is read twice.
    """
    day = [OBJECT, "statement_date"]
    executed = _reported(facts, settings, since).select("job_key", "statement_date").distinct()
    matches = (
        executed.join(refs.select("job_key", OBJECT, "layer_used"), "job_key")
        .groupBy(*day, "layer_used")
        .agg(F.count("*").alias("matched"))
    )
    # Use without client type takes the place of the row of zeros.
    no_client = use.filter("client_type IS NULL").select(*day, "layer_used").distinct()
    objects = refs.groupBy(OBJECT, "layer_used").agg(F.count("*").alias("references"))
    spine = with_days(objects, _report_start(facts, settings, since), settings, "statement_date")
    zero = F.lit(0).cast("bigint")
    zeros = (
        spine.join(matches, [*day, "layer_used"], "left")
        .filter(F.coalesce("matched", F.lit(0)) < F.col("references"))
        .join(no_client, [*day, "layer_used"], "left_anti")
        .select(
            *day,
            "layer_used",
            F.lit(None).cast("string").alias("client_type"),
            *(zero.alias(m) for m in _USE_MEASURES),
        )
    )
    importance = importance.select(
        F.col("table_name").alias(OBJECT),
        F.col("score_date").alias("statement_date"),
        "importance_score",
    )
    priority = (
        F.col("importance_score") * settings.priority_importance_weight
        + F.col("threat_score") * settings.priority_threat_weight
    )
    return (
        use.unionByName(zeros)
        .join(threat.select(*day, "threat_score"), day, "left")
        .join(importance, day, "left")
        .select(
            F.col("statement_date").alias("report_date"),
            F.col(OBJECT).alias("table_name"),
            *(column.alias(name) for name, column in path_columns(OBJECT).items()),
            F.col("layer_used").alias("layer"),
            "client_type",
            *_USE_MEASURES,
            "threat_score",
            "importance_score",
            priority.alias("priority_score"),
        )
    )
