"""Dimensions and the fact table, each from the staged log.

Rows are made distinct on the raw columns first; keys and texts that follow from them come after, so
that the shuffle carries less and the hashing is done once per distinct row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.columns import (
    NO_ERROR,
    CLIENT_LABELS,
    client_label,
    client_type,
    data_layer,
    job_key,
    statement_comment,
    surrogate_key,
    user_type,
)
from auditlens.functions.json import scalar, scalars
from auditlens.settings import Settings


# What the tables here and the active users read of the staged log.
STAGED_COLUMNS = [
    "dashboard_id",
    "panel_id",
    "job_id",
    "event_type",
    "event_timestamp",
    "resource_name",
    "principal_email",
    "project_id",
    "caller_ip_address",
    "caller_supplied_user_agent",
    "method_name",
    "error_result_code",
    "error_result_message",
    "start_time",
    "end_time",
    "total_slot_ms",
    "total_processed_bytes",
    "total_billed_bytes",
    "billing_tier",
    "referenced_tables",
    "referenced_views",
    "output_row_count",
    "cache_hit",
    "config_labels",
    "query_statement",
    "create_disposition",
    "query_priority",
    "statement_type",
]


# Keys that join the tables.
KEYS = ("job_key", "user_key", "user_agent_key")

# What the build tool tells about a job in the comment of its statement.
_BUILD_INFO = ("dbt_version", "profile_name", "target_name", "node_id")


def dim_job(staged: DataFrame) -> DataFrame:
    """Distinct attributes of jobs, with what the build tool wrote into the statement."""
    told = {c: F.expr(scalar(f"info.{c}")) for c in _BUILD_INFO}
    node = told["node_id"]
    parts = F.split(node, r"\.")
    execution = (
        F.when(node.startswith("model."), "DBT_RUN")
        .when(node.startswith("snapshot."), "DBT_SNAPSHOT")
        .when(node.startswith("test."), "DBT_TEST")
    )
    return (
        staged.withColumn("info", scalars(statement_comment("query_statement"), _BUILD_INFO))
        .select(
            "dashboard_id",
            "panel_id",
            "job_id",
            "project_id",
            "event_type",
            "resource_name",
            "caller_ip_address",
            "method_name",
            "create_disposition",
            "statement_type",
            "query_priority",
            told["dbt_version"].alias("dbt_version"),
            told["profile_name"].alias("dbt_profile_name"),
            told["target_name"].alias("dbt_target_name"),
            execution.alias("dbt_execution_type"),
            F.concat(F.get(parts, F.lit(1)), F.lit("."), F.get(parts, F.lit(2))).alias(
                "dbt_model_name"
            ),
            "cache_hit",
        )
        .distinct()
        .select(job_key(), "*")
    )


def dim_query_statements(staged: DataFrame) -> DataFrame:
    """Distinct statement texts of jobs."""
    return (
        staged.select("query_statement", "job_id")
        .distinct()
        .select(job_key(), "*", statement_comment("query_statement").alias("dbt_info"))
    )


def last_days(staged: DataFrame) -> DataFrame:
    """Rows (job_key, last_day): the last day on which a job was logged or started.

    No execution of a job starts after it, so a reader of executions since a day can leave out the
    statements of jobs whose last day is before, late starts included.
    """
    day = F.greatest(F.to_date("event_timestamp"), F.to_date("start_time"))
    return staged.groupBy("job_id").agg(F.max(day).alias("last_day")).select(job_key(), "last_day")


def dim_job_labels(staged: DataFrame) -> DataFrame:
    """One row per label. Labels are cut at commas and colons; an empty label is left out."""
    texts = F.split(F.regexp_replace("config_labels", r'[{}"]', ""), ",")
    pair = F.split("label", ":")
    return (
        staged.select("job_id", F.explode(texts).alias("label"))
        .filter("label <> ''")
        .select(
            "job_id",
            F.get(pair, F.lit(0)).alias("label_key"),
            F.get(pair, F.lit(1)).alias("label_value"),
        )
        .distinct()
        .select(job_key(), "label_key", "label_value")
    )


def path_columns(path: str) -> dict[str, Column]:
    """The parts of an object's path; NULL where the path is too short."""
    parts = F.split(path, "/")
    project, dataset, name = (F.get(parts, F.lit(i)) for i in (1, 3, 5))
    return {
        "project_id": project,
        "dataset_id": dataset,
        "table_or_view_id": name,
        "qualified_table_name": F.concat(project, F.lit("."), dataset, F.lit("."), name),
    }


def dim_references(staged: DataFrame, settings: Settings) -> DataFrame:
    """Tables and views each job read, with the parts of their path and their data layer."""

    def named(objects: str, kind: str):
        some = F.coalesce(F.col(objects), F.array().cast("array<string>"))
        return F.transform(
            some, lambda name: F.struct(name.alias("name"), F.lit(kind).alias("object_type"))
        )

    # Both lists of a row are unnested together: one scan and one shuffle for tables and views.
    both = F.concat(named("referenced_views", "view"), named("referenced_tables", "table"))
    return (
        staged.select("job_id", F.explode(both).alias("object"))
        .select(
            "job_id",
            F.col("object.name").alias("referenced_view_or_table"),
            F.col("object.object_type").alias("object_type"),
        )
        .distinct()
        .select(job_key(), "referenced_view_or_table", "object_type")
        .withColumns(path_columns("referenced_view_or_table"))
        .withColumn("layer_used", data_layer("dataset_id", settings))
    )


def dim_users(staged: DataFrame) -> DataFrame:
    """Principals per project."""
    return (
        staged.select("principal_email", "project_id")
        .distinct()
        .select(
            "*",
            F.nullif(F.regexp_extract("principal_email", "([^@]+)", 1), F.lit("")).alias("username"),
            user_type("principal_email").alias("user_type"),
            surrogate_key("principal_email", "project_id").alias("user_key"),
        )
    )


def dim_user_agents(staged: DataFrame, settings: Settings) -> DataFrame:
    """Client types seen per agent, principal and project. A key may have several.

    The labels of a row are parsed once, and reduced to the one thing they say about the client, before
    rows are made distinct; only distinct rows are classified.
    """
    names = ["caller_supplied_user_agent", "principal_email", "project_id"]
    seen = staged.select(*names, scalars("config_labels", CLIENT_LABELS).alias("labels"))
    seen = seen.select(*names, client_label("labels").alias("label")).distinct()
    return (
        seen.select(*names, client_type("label", settings).alias("client_type"))
        .distinct()
        .select(surrogate_key(*names).alias("user_agent_key"), "*")
    )


def _error_parts():
    return (
        F.coalesce("error_result_code", F.lit(NO_ERROR)).alias("error_result_code"),
        F.coalesce("error_result_message", F.lit(NO_ERROR)).alias("error_result_message"),
    )


def dim_errors(staged: DataFrame) -> DataFrame:
    """Distinct error codes and messages; NONE stands for no error."""
    return (
        staged.select(*_error_parts())
        .distinct()
        .select(
            surrogate_key("error_result_code", "error_result_message").alias("error_message_key"),
            "*",
        )
    )


def fct_statements(staged: DataFrame) -> DataFrame:
    """Distinct executions with their keys and measures."""
    return (
        staged.select(
            "start_time",
            "end_time",
            "total_processed_bytes",
            "total_billed_bytes",
            "output_row_count",
            "total_slot_ms",
            "billing_tier",
            *_error_parts(),
            "job_id",
            "principal_email",
            "project_id",
            "caller_supplied_user_agent",
        )
        .distinct()
        .select(
            job_key(),
            surrogate_key("error_result_code", "error_result_message").alias("error_message_key"),
            surrogate_key("principal_email", "project_id").alias("user_key"),
            surrogate_key("caller_supplied_user_agent", "principal_email", "project_id").alias(
                "user_agent_key"
            ),
            "start_time",
            F.to_date("start_time").alias("statement_date"),
            "end_time",
            "total_processed_bytes",
            "total_billed_bytes",
            "output_row_count",
            "total_slot_ms",
            "billing_tier",
        )
    )


def with_short_keys(table: DataFrame) -> DataFrame:
    """The table with its keys as the 16 bytes that their 32 hex digits stand for.

    Keys are random, so they make up most of what a shuffle or a settled table carries. Equal keys stay
    equal and others stay apart; all tables of a join need keys of the same form.
    """
    return table.withColumns({key: F.unhex(key) for key in KEYS if key in table.columns})
