"""Threat and importance scores of tables, per day.

Both are weighted sums of percent ranks. Executions are added up per job and day before they meet
the tables of the job, so a job with very many executions, such as the one that all executions
without a job id share, brings one row per day to the join.

The parts of a score are kept as rows (part, value) and ranked together in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.columns import cost, cost_measure, exact, is_error
from auditlens.functions.joins import sliced_join
from auditlens.functions.ranks import percent_ranks
from auditlens.operators.dates import in_calendar
from auditlens.operators.filters import dev_limit_days
from auditlens.session import settle, side_by_side
from auditlens.settings import Settings

# Fixed value: weight of egress from a table outside the prod layer.
OFF_PROD_EGRESS = 5

OBJECT = "referenced_view_or_table"


def tables_of(refs: DataFrame) -> DataFrame:
    return refs.filter("object_type = 'table'")


def object_days(facts: DataFrame, refs: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct (table, day) of executions with a known user."""
    days = facts.select("job_key", "statement_date", "user_key").distinct()
    known = days.join(users.select("user_key"), "user_key")
    return (
        known.select("job_key", "statement_date")
        .distinct()
        .join(tables_of(refs).select("job_key", OBJECT), "job_key")
        .select(OBJECT, "statement_date")
        .distinct()
    )


def _calendar_day(settings: Settings) -> Column:
    """The calendar day of an execution. All days off the calendar fall into one NULL day, which
    counts in medians and rank sizes and has no score."""
    return F.when(in_calendar("statement_date", settings), F.col("statement_date"))


def _median(value: str) -> Column:
    """Median over the days of a table, on the days that have a value."""
    median = F.percentile(value, F.lit(0.5)).over(Window.partitionBy(OBJECT))
    return F.when(F.col(value).isNotNull(), median)


def _as_parts(df: DataFrame, parts: list[str]) -> DataFrame:
    """One row (table, day, part, value) for each part that has a value."""
    pairs = ", ".join(f"'{part}', {part}" for part in parts)
    return df.selectExpr(
        OBJECT, "date_day", f"stack({len(parts)}, {pairs}) AS (part, value)"
    ).filter("value IS NOT NULL")


def _count_values(parts: DataFrame) -> DataFrame:
    return parts.groupBy("part", "value").agg(F.count("*").alias("rows"))


def _rank(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """Parts with the percent rank of their value. Many rows may share a value such as 0."""
    return sliced_join(parts, percent_ranks(counts), ["part", "value"], [OBJECT, "date_day"])


def _of_part(part: str, column: str) -> Column:
    return F.max(F.when(F.col("part") == part, F.col(column)))


def threat_score(
    facts: DataFrame, jobs: DataFrame, refs: DataFrame, users: DataFrame, settings: Settings
) -> DataFrame:
    """Threat of a table per day: egress by service accounts, cost to query and to build, errors.

    Egress ranks the daily count; the others rank the table's median over its days. A missing part
    counts as 0, and only scores above 0 are kept.
    """
    service = F.col("user_type") == "Service Account"
    human = F.col("user_type") == "User"
    egress = service
    if settings.egress_emails:
        egress = egress & F.col("principal_email").isin(*settings.egress_emails)
    amount = exact(cost_measure(settings))

    people = users.select("user_key", "user_type", "principal_email")
    by_user = dev_limit_days(facts, settings).groupBy("job_key", "statement_date", "user_key").agg(
        F.count("*").alias("n"),
        F.sum(amount).alias("amount"),
        F.count_if(is_error("error_message_key")).alias("errors"),
    )

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    executions = (
        by_user.join(people, "user_key")
        .groupBy("job_key", "statement_date")
        .agg(
            counted(egress).alias("egress"),
            counted(human).alias("queries"),
            F.sum(F.when(human, F.col("amount"))).alias("query_amount"),
            counted(service).alias("builds"),
            F.sum(F.when(service, F.col("amount"))).alias("build_amount"),
            F.sum("errors").alias("errors"),
        )
    )
    # A job may have several rows of attributes, and each repeats the executions of the job.
    repeats = jobs.groupBy("job_key").agg(
        F.count("*").alias("job_rows"), F.count("dbt_execution_type").alias("build_rows")
    )
    rows = F.coalesce("job_rows", F.lit(1))
    builds = F.coalesce("build_rows", F.lit(0))
    daily = (
        executions.join(repeats, "job_key", "left")
        .join(tables_of(refs).select("job_key", OBJECT, "layer_used"), "job_key")
        .groupBy(OBJECT, "layer_used", _calendar_day(settings).alias("date_day"))
        .agg(
            F.sum(F.col("egress") * rows).alias("egress"),
            F.sum(F.col("queries") * rows).alias("queries"),
            F.sum(F.col("query_amount") * rows).alias("query_amount"),
            F.sum(F.col("builds") * builds).alias("builds"),
            F.sum(F.col("build_amount") * builds).alias("build_amount"),
            F.sum(F.col("errors") * rows).alias("errors"),
        )
    )

    # Without a price all costs are equal, whatever was read.
    free = settings.pricing_schedule == "on_demand" and settings.on_demand_price_per_tib == 0

    def spent(total: str, when: str) -> Column:
        worth = F.lit(0.0) if free else F.coalesce(F.col(total).cast("double"), F.lit(0.0))
        return F.when(F.col(when) > 0, worth)

    # Egress is ranked for each layer that an object was used in, all else for the object.
    daily = settle(daily, "threat-days")
    factor = F.when(F.col("layer_used") == "prod", 1).otherwise(OFF_PROD_EGRESS)
    egress_parts = daily.filter("egress > 0").select(
        OBJECT,
        "date_day",
        F.lit("egress").alias("part"),
        (F.col("egress") * factor).cast("double").alias("value"),
    )
    measures = ("queries", "query_amount", "builds", "build_amount", "errors")
    whole = daily.groupBy(OBJECT, "date_day").agg(*(F.sum(m).alias(m) for m in measures))
    values = whole.select(
        OBJECT,
        "date_day",
        spent("query_amount", "queries").alias("query"),
        spent("build_amount", "builds").alias("build"),
        F.when(F.col("errors") > 0, F.col("errors").cast("double")).alias("errors"),
    )
    others = ["query", "build", "errors"]
    medians = settle(values.select(OBJECT, "date_day", *(_median(m).alias(m) for m in others)), "threat")
    parts = _as_parts(medians, others).unionByName(egress_parts)
    ranked = _rank(parts.filter("date_day IS NOT NULL"), _count_values(parts))
    of_layer = ranked.filter("part = 'egress'").select(
        OBJECT, "date_day", F.col("value").alias("egress"), F.col("percent_rank").alias("egress_rank")
    )

    def value(part: str) -> Column:
        return F.coalesce(_of_part(part, "value"), F.lit(0.0))

    def rank(part: str) -> Column:
        return F.coalesce(_of_part(part, "percent_rank"), F.lit(0.0))

    score = (
        F.col("percent_rank_count_queries_with_multiplier") * settings.threat_egress_weight
        + F.col("percent_rank_sum_daily_query_cost") * settings.threat_query_cost_weight
        + F.col("percent_rank_daily_build_cost") * settings.threat_build_cost_weight
        + F.col("percent_rank_daily_errors") * settings.threat_errors_weight
    )
    of_object = (
        ranked.filter("part <> 'egress'")
        .groupBy(OBJECT, "date_day")
        .agg(
            cost(value("query"), settings).alias("sum_daily_query_cost_median"),
            rank("query").alias("percent_rank_sum_daily_query_cost"),
            cost(value("build"), settings).alias("sum_daily_build_cost_median"),
            rank("build").alias("percent_rank_daily_build_cost"),
            value("errors").alias("median_count_daily_errors"),
            rank("errors").alias("percent_rank_daily_errors"),
        )
    )
    none = F.lit(0.0)
    return (
        of_object.join(of_layer, [OBJECT, "date_day"], "full")
        .select(
            OBJECT,
            F.col("date_day").alias("statement_date"),
            F.coalesce("egress", none).cast("bigint").alias("count_queries_with_multiplier"),
            F.coalesce("egress_rank", none).alias("percent_rank_count_queries_with_multiplier"),
            *(F.coalesce(c, none).alias(c) for c in of_object.columns if c not in (OBJECT, "date_day")),
        )
        .withColumn("threat_score", score)
        .filter("threat_score > 0")
    )


def _client_points(settings: Settings) -> Column:
    """Points of a client type, 0 to 4."""
    points: Column = F.lit(0)
    lists = (
        settings.importance_clients_1,
        settings.importance_clients_2,
        settings.importance_clients_3,
        settings.importance_clients_4,
    )
    # The first list that names a client counts, so later lists are tested inside.
    for number, clients in reversed(list(enumerate(lists, start=1))):
        if clients:
            points = F.when(F.col("client_type").isin(*clients), number).otherwise(points)
    return points


def _breadth(active_users: DataFrame) -> DataFrame:
    """Per table: the median of its monthly users, over a row for each calendar day."""
    return active_users.groupBy(F.col("table_name").alias(OBJECT)).agg(
        F.percentile("human_monthly_active_users_30_day_cnt", F.lit(0.5)).alias("breadth"),
        F.count("*").alias("days"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )


def importance_score(
    facts: DataFrame,
    refs: DataFrame,
    users: DataFrame,
    labels: DataFrame,
    agents: DataFrame,
    active_users: DataFrame,
    settings: Settings,
) -> DataFrame:
    """Importance of a table per day: use by service accounts, in builds, for egress, by people.

    Every part ranks the table's median over its days. The score is NULL if any part is missing.
    """
    service = F.col("user_type") == "Service Account"
    # An agent key may have several client types; their points add up per execution.
    points = agents.groupBy("user_agent_key").agg(F.sum(_client_points(settings)).alias("points"))
    by_user = (
        dev_limit_days(facts, settings)
        .groupBy("job_key", "statement_date", "user_key", "user_agent_key")
        .agg(F.count("*").alias("n"))
    )
    zero = F.lit(0)
    executions = (
        by_user.join(users.select("user_key", "user_type"), "user_key")
        .join(points, "user_agent_key", "left")
        .groupBy("job_key", "statement_date")
        .agg(
            F.sum(F.when(service, F.col("n")).otherwise(zero)).alias("service"),
            F.sum(F.when(service & F.col("points").isNotNull(), F.col("n")).otherwise(zero)).alias("scored"),
            F.coalesce(F.sum(F.when(service, F.col("points") * F.col("n"))), zero).alias("egress"),
        )
    )
    invocations = (
        labels.filter("label_key = 'dbt_invocation_id'")
        .groupBy("job_key")
        .agg(F.count("label_value").alias("invocations"))
    )
    per_day = (
        executions.join(invocations, "job_key", "left")
        .join(tables_of(refs).select("job_key", OBJECT), "job_key")
        .groupBy(OBJECT, "statement_date")
        .agg(
            F.sum("service").alias("service"),
            F.sum(F.col("service") * F.coalesce("invocations", F.lit(0))).alias("dbt"),
            F.sum("scored").alias("scored"),
            F.sum("egress").alias("egress"),
        )
    )
    usage, breadth = side_by_side(
        lambda: settle(per_day, "importance-usage"),
        lambda: settle(_breadth(active_users), "importance-breadth"),
    )

    daily = usage.groupBy(OBJECT, _calendar_day(settings).alias("date_day")).agg(
        *(F.sum(c).alias(c) for c in ("service", "dbt", "scored", "egress"))
    )

    def counted(value: str, when: str) -> Column:
        return F.when(F.col(when) > 0, F.col(value).cast("double")).alias(value)

    values = daily.select(
        OBJECT,
        "date_day",
        counted("service", "service"),
        counted("dbt", "service"),
        counted("egress", "scored"),
    )
    # The breadth table has a row for each day of the calendar, first to last.
    on_breadth_day = F.col("date_day").between(F.col("first_date"), F.col("last_date"))
    medians = (
        values.select(
            OBJECT, "date_day", *(_median(c).alias(c) for c in ("service", "dbt", "egress"))
        )
        .join(breadth, OBJECT, "left")
        .withColumn("breadth", F.when(on_breadth_day, F.col("breadth")))
    )
    medians = settle(medians, "importance")
    all_parts = ["service", "dbt", "egress", "breadth"]
    counts = _count_values(_as_parts(medians, all_parts[:3])).unionByName(
        breadth.filter("breadth IS NOT NULL")
        .groupBy(F.lit("breadth").alias("part"), F.col("breadth").alias("value"))
        .agg(F.sum("days").alias("rows"))
    )
    on_calendar = medians.filter("date_day IS NOT NULL")
    ranked = _rank(_as_parts(on_calendar, all_parts), counts)
    # A row without part or rank for every table and day, so that days without any part remain.
    none = F.lit(None)
    base = usage.select(
        OBJECT,
        F.col("statement_date").alias("date_day"),
        none.cast("string").alias("part"),
        none.cast("double").alias("value"),
        none.cast("double").alias("percent_rank"),
    )
    score = (
        F.col("service_acct_percent_rank") * settings.importance_service_weight
        + F.col("dbt_percent_rank") * settings.importance_dbt_weight
        + F.col("egress_percent_rank") * settings.importance_egress_weight
        + F.col("active_user_percent_rank") * settings.importance_breadth_weight
    )
    return (
        ranked.unionByName(base)
        .groupBy(F.col(OBJECT).alias("table_name"), F.col("date_day").alias("score_date"))
        .agg(
            _of_part("service", "value").alias("service_acct_median_queries"),
            _of_part("service", "percent_rank").alias("service_acct_percent_rank"),
            _of_part("dbt", "value").alias("dbt_median_queries"),
            _of_part("dbt", "percent_rank").alias("dbt_percent_rank"),
            _of_part("egress", "value").alias("egress_median_queries"),
            _of_part("egress", "percent_rank").alias("egress_percent_rank"),
            _of_part("breadth", "value").alias("active_user_median"),
            _of_part("breadth", "percent_rank").alias("active_user_percent_rank"),
        )
        .withColumn("importance_score", score)
    )
