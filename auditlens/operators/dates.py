"""The calendar: the date dimension, and spines that give entities a row per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.functions.columns import surrogate_key
from auditlens.settings import Settings

# First and last day of the calendar.
CALENDAR_START = dt.date(2010, 1, 1)
CALENDAR_END = dt.date(2050, 1, 1)


def last_day(settings: Settings) -> dt.date:
    return min(settings.as_of, CALENDAR_END)


def in_calendar(day: str, settings: Settings) -> Column:
    """Whether a day lies on the calendar, today included. NULL does not."""
    return F.col(day).between(F.lit(CALENDAR_START), F.lit(last_day(settings)))


def first_day(df: DataFrame, day: str) -> Column:
    """The first day found in a frame, as a scalar subquery: one value, no join."""
    return df.agg(F.min(day)).scalar()


def with_days(
    entities: DataFrame, start: Column, settings: Settings, name: str = "date_day"
) -> DataFrame:
    """Each entity once per calendar day from `start` to today; none if there is no start."""
    begin = F.greatest(start, F.lit(CALENDAR_START))
    end = F.lit(last_day(settings))
    days = F.when(start.isNotNull() & (begin <= end), F.sequence(begin, end))
    return entities.select("*", F.explode(days).alias(name))


def calendar_spine(spark: SparkSession, start: Column, settings: Settings) -> DataFrame:
    """Calendar days from `start` to today."""
    return with_days(spark.range(1), start, settings).select("date_day")


# The fiscal year starts on 1 February: eleven months on, fiscal and calendar periods agree.
_BASIC = """
    date_day AS date_actual,
    CAST(date_day AS TIMESTAMP) AS start_of_day_timestamp,
    CAST(date_add(date_day, 1) AS TIMESTAMP) - INTERVAL 1 SECOND AS end_of_day_timestamp,
    date_format(date_day, 'EEEE') AS day_name,
    date_format(date_day, 'MMMM') AS month_name,
    date_format(date_day, 'MMM') AS abbreviated_month_name,
    month(date_day) AS month_actual,
    year(date_day) AS year_actual,
    quarter(date_day) AS quarter_actual,
    day(date_day) AS day_of_month,
    dayofweek(date_day) AS day_of_week,
    trunc(date_day, 'MM') AS first_day_of_month,
    date_sub(date_day, dayofweek(date_day) - 1) AS first_day_of_week,
    last_day(date_day) AS last_day_of_month,
    date_sub(add_months(trunc(date_day, 'YEAR'), 12), 1) AS last_day_of_year,
    date_sub(add_months(trunc(date_day, 'QUARTER'), 3), 1) AS last_day_of_quarter,
    add_months(date_day, 11) AS fiscal_day,
    CASE date_format(date_day, 'MM-dd')
        WHEN '01-01' THEN 'New Years Day'
        WHEN '12-25' THEN 'Christmas Day'
        WHEN '12-26' THEN 'Boxing Day'
    END AS holiday_desc
"""

_FISCAL = """
    abbreviated_month_name || "'" || lpad(extract(YEAROFWEEK FROM date_day) % 100, 2, '0')
        AS formatted_month_year_name,
    (dayofyear(date_day) + 7 - day_of_week) DIV 7 + 1 AS week_of_year,
    (dayofyear(first_day_of_month) + 7 - dayofweek(first_day_of_month)) DIV 7
        AS weeks_before_month,
    month(fiscal_day) AS month_of_fiscal_year,
    year(fiscal_day) AS fiscal_year,
    CAST(quarter(fiscal_day) AS STRING) AS fiscal_quarter
"""

# Edges of periods come from the days of the calendar, so the calendar's own ends cut them off.
_EDGES = """
    min(date_day) OVER (PARTITION BY year_actual) AS first_day_of_year,
    min(date_day) OVER (PARTITION BY year_actual, quarter_actual) AS first_day_of_quarter,
    count(*) OVER (PARTITION BY year_actual, first_day_of_month) AS days_in_month_count,
    min(date_day) OVER (PARTITION BY fiscal_year) AS first_day_of_fiscal_year,
    max(date_day) OVER (PARTITION BY fiscal_year) AS last_day_of_fiscal_year,
    min(date_day) OVER (PARTITION BY fiscal_year, fiscal_quarter) AS first_day_of_fiscal_quarter,
    max(date_day) OVER (PARTITION BY fiscal_year, fiscal_quarter) AS last_day_of_fiscal_quarter,
    max(date_day) OVER (PARTITION BY first_day_of_week) AS last_day_of_week
"""

_NAMES = """
    fiscal_year || '-' || month_actual AS fiscal_month_name,
    fiscal_year || '-Q' || fiscal_quarter AS fiscal_quarter_name,
    year_actual || '-Q' || quarter_actual AS quarter_name,
    trunc(last_day_of_fiscal_quarter, 'MM') AS last_month_of_fiscal_quarter,
    trunc(last_day_of_fiscal_year, 'MM') AS last_month_of_fiscal_year,
    fiscal_year * 4 + CAST(fiscal_quarter AS INT) AS fiscal_quarter_index
"""


def _weeks_since(first: str) -> Column:
    """Sundays after the first day, up to the day."""
    sunday = F.date_sub(F.col(first), F.dayofweek(first) - 1)
    return (F.datediff("first_day_of_week", sunday) / 7).cast("bigint")


def dim_date(spark: SparkSession, settings: Settings) -> DataFrame:
    """The date dimension, one row per day of the calendar (a fixed 14,611 rows)."""

    def adding(df: DataFrame, expressions: str) -> DataFrame:
        return spark.sql(f"SELECT *, {expressions} FROM {{df}}", df=df)

    spine = spark.range(1).select(
        F.explode(F.sequence(F.lit(CALENDAR_START), F.lit(CALENDAR_END))).alias("date_day")
    )
    days = spine
    for step in (_BASIC, _FISCAL, _EDGES, _NAMES):
        days = adding(days, step)

    day = F.col("date_day")
    today = F.lit(settings.as_of)
    first_index = CALENDAR_START.year * 4 + 4  # the calendar starts in a fourth fiscal quarter

    def count_from(first: str) -> Column:
        return F.datediff(day, F.col(first)) + 1

    def whole(column: Column | str) -> Column:
        return (F.col(column) if isinstance(column, str) else column).cast("bigint")

    return days.select(
        "date_day",
        "date_actual",
        "start_of_day_timestamp",
        "end_of_day_timestamp",
        "day_name",
        "month_name",
        "abbreviated_month_name",
        "formatted_month_year_name",
        *(
            whole(c).alias(c)
            for c in (
                "month_actual",
                "year_actual",
                "quarter_actual",
                "day_of_month",
                "day_of_week",
                "week_of_year",
                "month_of_fiscal_year",
                "fiscal_year",
                "days_in_month_count",
            )
        ),
        "first_day_of_month",
        "first_day_of_week",
        "last_day_of_month",
        "last_day_of_year",
        "last_day_of_quarter",
        "holiday_desc",
        F.col("holiday_desc").isNotNull().alias("is_holiday"),
        # Past days end at their last second, today at its start, and the future is open.
        F.when(day < today, F.col("end_of_day_timestamp"))
        .when(day == today, F.col("start_of_day_timestamp"))
        .alias("snapshot_join_timestamp"),
        "fiscal_quarter",
        "fiscal_month_name",
        "fiscal_quarter_name",
        "quarter_name",
        F.concat(F.lit("FY"), F.substring("fiscal_month_name", 3, 8)).alias("fiscal_month_name_fy"),
        F.concat(F.lit("FY"), F.substring("fiscal_quarter_name", 3, 7)).alias(
            "fiscal_quarter_name_fy"
        ),
        (F.col("first_day_of_week") == day).alias("is_first_day_of_week"),
        (F.col("last_day_of_month") == day).alias("is_last_day_of_month"),
        F.col("day_of_week").between(2, 6).alias("is_weekday"),
        whole(count_from("first_day_of_quarter")).alias("day_of_quarter"),
        whole(count_from("first_day_of_year")).alias("day_of_year"),
        whole(count_from("first_day_of_fiscal_quarter")).alias("day_of_fiscal_quarter"),
        whole(count_from("first_day_of_fiscal_year")).alias("day_of_fiscal_year"),
        "first_day_of_year",
        "first_day_of_quarter",
        "first_day_of_fiscal_quarter",
        "last_day_of_fiscal_quarter",
        "first_day_of_fiscal_year",
        "last_day_of_fiscal_year",
        "last_day_of_week",
        surrogate_key("date_day").alias("date_key"),
        (_weeks_since("first_day_of_fiscal_year") + 1).alias("week_of_fiscal_year"),
        (_weeks_since("first_day_of_fiscal_quarter") + 1).alias("week_of_fiscal_quarter"),
        whole(F.col("week_of_year") - F.col("weeks_before_month")).alias("week_of_month"),
        whole(F.col("fiscal_quarter_index") - first_index + 1).alias(
            "fiscal_quarter_number_absolute"
        ),
        "last_month_of_fiscal_quarter",
        "last_month_of_fiscal_year",
        (F.col("last_month_of_fiscal_quarter") == day).alias(
            "is_first_day_of_last_month_of_fiscal_quarter"
        ),
        (F.col("last_month_of_fiscal_year") == day).alias(
            "is_first_day_of_last_month_of_fiscal_year"
        ),
    )
