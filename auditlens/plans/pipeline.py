"""Full and incremental builds of all tables.

Each table is written once and read back by the tables above it, so the JSON is parsed once and
every reader scans the columns it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.operators import marts, reports
from auditlens.operators.active_users import table_active_users
from auditlens.operators.dates import dim_date
from auditlens.operators.filters import dev_limit, incremental_lookback
from auditlens.operators.scores import importance_score, threat_score
from auditlens.operators.staging import stage_audit_log
from auditlens.plans.warehouse import Warehouse
from auditlens.session import settle, side_by_side

# Dimensions: key of the upsert, and columns to cluster by.
DIMENSIONS = {
    "dim_job": (("job_key", "caller_ip_address"), ("job_key", "dashboard_id", "panel_id")),
    "dim_query_statements": (("job_key",), ("last_day", "job_key", "query_statement")),
    "dim_job_labels": (("job_key", "label_key"), ("job_key", "label_key")),
    "dim_references": (
        ("job_key", "referenced_view_or_table", "layer_used", "object_type"),
        ("job_key", "referenced_view_or_table"),
    ),
    "dim_users": (("user_key",), ("user_type", "user_key")),
    "dim_user_agents": (("user_agent_key", "client_type"), ("user_agent_key", "client_type")),
    "dim_errors": (("error_message_key",), ("error_message_key",)),
}
# Dimensions that depend on the settings.
WITH_SETTINGS = {"dim_references", "dim_user_agents"}


class Build:
    """One run over the log tables into a warehouse."""

    def __init__(
        self, logs: Sequence[DataFrame], warehouse: Warehouse, incremental: bool = False
    ) -> None:
        self.logs = logs
        self.warehouse = warehouse
        self.settings = warehouse.settings
        self.incremental = incremental

    def run(self) -> None:
        staged = self._stage()
        side_by_side(
            self._calendar,
            partial(self._facts, staged),
            *(partial(self._dimension, name, staged) for name in DIMENSIONS),
        )
        side_by_side(self._threat, self._importance)
        if self.settings.enable_reports:
            side_by_side(
                self._table_usage,
                self._query_alerting,
                self._usage_cost,
                self._user_metrics,
                self._dbt_metrics,
            )

    def _table(self, name: str) -> DataFrame:
        return self.warehouse.read(name)

    def _tables(self, *names: str) -> list[DataFrame]:
        return [self._table(name) for name in names]

    def _write_days(self, name: str, df: DataFrame, day: str, *cluster_by: str) -> None:
        """The whole table, or in an incremental run the days of the lookback."""
        days = self.settings.lookback if self.incremental else None
        self.warehouse.write_days(name, df, day, cluster_by, days)

    def _stage(self) -> DataFrame:
        staged = dev_limit(stage_audit_log(self.logs), self.settings)
        if self.incremental:
            staged = incremental_lookback(staged, self.settings)
        staged = staged.withColumn("event_date", F.to_date("event_timestamp"))
        days = self.settings.lookback if self.incremental else None
        self.warehouse.write_days("staged", staged, "event_date", None, days)
        return self._since_lookback(self._table("staged"))

    def _since_lookback(self, staged: DataFrame) -> DataFrame:
        if not self.incremental:
            return staged
        return staged.filter(F.col("event_date") >= F.lit(self.settings.lookback_start))

    def _calendar(self) -> None:
        self.warehouse.write_full("dim_date", dim_date(self.warehouse.spark, self.settings))

    def _dimension(self, name: str, staged: DataFrame) -> None:
        build = getattr(marts, name)
        df = build(staged, self.settings) if name in WITH_SETTINGS else build(staged)
        if name == "dim_query_statements":
            df = df.join(self._last_days(staged), "job_key")
        keys, cluster_by = DIMENSIONS[name]
        if self.incremental:
            self.warehouse.upsert(name, df, keys, cluster_by)
        else:
            self.warehouse.replace(name, df, cluster_by, keys)

    def _last_days(self, staged: DataFrame) -> DataFrame:
        """The last day of each job. One that the table knows already keeps a later day, as an
        execution logged before the lookback may start after it."""
        days = marts.last_days(staged)
        if not self.incremental:
            return days
        known = self._table("dim_query_statements").select("job_key", "last_day")
        known = known.join(days.select("job_key"), "job_key", "left_semi")
        return days.unionByName(known).groupBy("job_key").agg(F.max("last_day").alias("last_day"))

    def _facts(self, staged: DataFrame) -> None:
        self._write_days(
            "fct_statements",
            marts.fct_statements(staged),
            "statement_date",
            "job_key",
            "user_key",
            "user_agent_key",
        )

    # Ranks and medians run over all history; an incremental run writes the last days of them.

    def _threat(self) -> None:
        inputs = self._tables("fct_statements", "dim_job", "dim_references", "dim_users")
        threat = threat_score(*inputs, self.settings)
        self._write_days("threat_score", threat, "statement_date", "referenced_view_or_table")

    def _importance(self) -> None:
        # Settled, since the table written day by day lacks the earlier days of new tables, which
        # count in the median.
        active = settle(table_active_users(self._table("staged"), self.settings), "active-users")
        self._write_days("table_active_users", active, "event_date", "table_name")
        inputs = self._tables(
            "fct_statements", "dim_references", "dim_users", "dim_job_labels", "dim_user_agents"
        )
        importance = importance_score(*inputs, active, self.settings)
        self._write_days("importance_score", importance, "score_date", "table_name")

    def _table_usage(self) -> None:
        since = self.settings.lookback_start if self.incremental else None
        facts, jobs, refs, users, agents, threat, importance = self._tables(
            "fct_statements",
            "dim_job",
            "dim_references",
            "dim_users",
            "dim_user_agents",
            "threat_score",
            "importance_score",
        )
        use = reports.client_use(facts, jobs, refs, users, agents, self.settings, since)
        usage = reports.rpt_table_usage(
            settle(use, "client-use"), facts, refs, threat, importance, self.settings, since
        )
        self._write_days("rpt_table_usage", usage, "report_date", "layer", "client_type")

    def _query_alerting(self) -> None:
        inputs = self._tables("fct_statements", "dim_users", "dim_query_statements")
        alerts = reports.rpt_query_alerting(*inputs, self.settings)
        alerts = alerts.withColumn("start_date", F.to_date("start_time"))
        self._write_days("rpt_query_alerting", alerts, "start_date", "username", "user_type")

    # These three are rebuilt in full on every run.

    def _usage_cost(self) -> None:
        inputs = self._tables("fct_statements", "dim_job", "dim_user_agents")
        report = reports.rpt_usage_cost(*inputs, self.settings)
        self.warehouse.write_days("rpt_usage_cost", report, "report_date", ["client_type"])

    def _user_metrics(self) -> None:
        inputs = self._tables("fct_statements", "dim_job", "dim_references", "dim_users")
        report = reports.rpt_user_metrics(*inputs, self.settings)
        self.warehouse.write_days(
            "rpt_user_metrics", report, "report_date", ["username", "user_type"]
        )

    def _dbt_metrics(self) -> None:
        inputs = self._tables("fct_statements", "dim_job", "dim_job_labels")
        report = reports.rpt_dbt_metrics(*inputs, self.settings)
        self.warehouse.write_days("rpt_dbt_metrics", report, "report_date", ["dbt_model_name"])
