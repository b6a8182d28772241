"""Active users per table and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.columns import SERVICE_SUFFIX
from auditlens.operators.dates import first_day, last_day, with_days
from auditlens.settings import Settings

# Days in the window, and active days in it that make a user weekly.
WINDOW_DAYS = 30
WEEKLY_DAYS = 5


def _active_days(human: DataFrame, tables: DataFrame) -> DataFrame:
    """Distinct (table, user, day). A job counts with all its tables on each day it was logged."""
    visits = human.select(
        "job_id", "principal_email", F.to_date("event_timestamp").alias("event_date")
    ).distinct()
    return (
        visits.join(tables, "job_id")
        .select("table_name", "principal_email", "event_date")
        .distinct()
    )


def _status_changes(active: DataFrame, settings: Settings) -> DataFrame:
    """Per table and day, changes of the numbers of weekly and monthly users, to be added up.

    An active day counts from that day on and drops out when the window has passed. Two rows per
    active day stand for the window, where a row per user and calendar day would be needed to count
    in it.
    """
    enters = F.struct(F.col("event_date").alias("day"), F.lit(1).alias("step"))
    leaves = F.struct(F.date_add("event_date", WINDOW_DAYS).alias("day"), F.lit(-1).alias("step"))
    steps = (
        active.select("table_name", "principal_email", F.explode(F.array(enters, leaves)).alias("s"))
        .select("table_name", "principal_email", F.col("s.day").alias("event_date"), "s.step")
        .filter(F.col("event_date") <= F.lit(last_day(settings)))
    )
    history = Window.partitionBy("table_name", "principal_email").orderBy("event_date")
    # By range, so that rows of the same day see the same count and only the first is a change.
    days_active = F.sum("step").over(history.rangeBetween(Window.unboundedPreceding, 0))
    status = steps.select("*", days_active.alias("days_active")).select(
        "*",
        (F.col("days_active") >= WEEKLY_DAYS).cast("bigint").alias("is_weekly"),
        F.col("days_active").between(1, WEEKLY_DAYS - 1).cast("bigint").alias("is_monthly"),
    )

    def change(flag: str) -> Column:
        return F.col(flag) - F.lag(flag, 1, 0).over(history)

    return status.select(
        "table_name",
        "event_date",
        change("is_weekly").alias("weekly"),
        change("is_monthly").alias("monthly"),
    )


def table_active_users(staged: DataFrame, settings: Settings) -> DataFrame:
    """Rolling sums of weekly and monthly users for each table and calendar day.

    A user is weekly on a day with 5 or more active days among the last 30, monthly with 1 to 4.
    The daily numbers are added up over the last 30 days of the table. Service accounts are left
    out.
    """
    human = staged.filter(~F.endswith(F.col("principal_email"), F.lit(SERVICE_SUFFIX)))
    tables = human.select("job_id", F.explode("referenced_tables").alias("table_name")).distinct()
    changes = _status_changes(_active_days(human, tables), settings)

    start = first_day(human.select(F.to_date("event_timestamp").alias("day")), "day")
    zero = F.lit(0).cast("bigint")
    spine = with_days(tables.select("table_name").distinct(), start, settings, "event_date").select(
        "*", zero.alias("weekly"), zero.alias("monthly")
    )
    # One row per table and day: a table has as many rows as the calendar has days.
    daily = (
        spine.unionByName(changes)
        .groupBy("table_name", "event_date")
        .agg(F.sum("weekly").alias("weekly"), F.sum("monthly").alias("monthly"))
    )
    days = Window.partitionBy("table_name").orderBy("event_date")
    so_far = days.rowsBetween(Window.unboundedPreceding, 0)
    window = days.rowsBetween(1 - WINDOW_DAYS, 0)
    users = daily.select(
        "event_date",
        "table_name",
        F.sum("weekly").over(so_far).alias("weekly"),
        F.sum("monthly").over(so_far).alias("monthly"),
    )
    return users.select(
        "event_date",
        "table_name",
        F.sum("weekly").over(window).alias("human_weekly_active_users_30_day_cnt"),
        F.sum("monthly").over(window).alias("human_monthly_active_users_30_day_cnt"),
    )
