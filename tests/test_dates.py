import datetime as dt
from dataclasses import replace

import pytest

from rows import values
from auditlens.operators.dates import calendar_spine, dim_date, first_day, with_days
from auditlens.sources.event_log import FIXTURE_SETTINGS as SETTINGS


@pytest.fixture(scope="module")
def days(spark):
    rows = dim_date(spark, SETTINGS).collect()
    assert len(rows) == 14611
    return {row.date_day.isoformat(): row for row in rows}


def test_known_days(days):
    d = days["2019-02-02"]
    assert (d.day_name, d.month_name, d.abbreviated_month_name) == ("Saturday", "February", "Feb")
    assert (d.fiscal_year, d.fiscal_quarter, d.month_of_fiscal_year) == (2020, "1", 1)
    assert (d.fiscal_month_name, d.fiscal_quarter_name) == ("2020-2", "2020-Q1")
    assert (d.fiscal_month_name_fy, d.fiscal_quarter_name_fy) == ("FY20-2", "FY20-Q1")
    assert (d.day_of_fiscal_year, d.day_of_year, d.week_of_year) == (2, 33, 5)
    assert d.first_day_of_week == dt.date(2019, 1, 27)
    assert d.last_day_of_week == dt.date(2019, 2, 2)
    assert not d.is_weekday and not d.is_holiday


def test_year_starts(days):
    assert days["2021-01-01"].formatted_month_year_name == "Jan'20"
    assert days["2023-01-01"].week_of_year == 2
    assert days["2019-01-01"].holiday_desc == "New Years Day"
    assert days["2019-12-26"].holiday_desc == "Boxing Day"
    assert days["2020-02-29"].days_in_month_count == 29
    assert days["2020-12-31"].day_of_year == 366


def test_periods_end_with_the_calendar(days):
    first, last = days["2010-01-01"], days["2050-01-01"]
    assert (first.day_of_fiscal_year, first.fiscal_quarter_number_absolute) == (1, 1)
    assert first.first_day_of_fiscal_year == dt.date(2010, 1, 1)
    assert last.last_day_of_fiscal_year == dt.date(2050, 1, 1)
    assert (last.days_in_month_count, last.last_day_of_week) == (1, dt.date(2050, 1, 1))


def test_keys_are_unique(days):
    assert len({row.date_key for row in days.values()}) == len(days)


def test_snapshot_time_follows_today(days):
    assert days["2024-01-30"].snapshot_join_timestamp == dt.datetime(2024, 1, 30, 23, 59, 59)
    assert days["2024-01-31"].snapshot_join_timestamp == dt.datetime(2024, 1, 31)
    assert days["2024-02-01"].snapshot_join_timestamp is None


@pytest.mark.parametrize(
    "start, count", [("2024-01-29", 3), ("2024-02-01", 0), (None, 0), ("2009-12-30", 5144)]
)
def test_spine(spark, start, count):
    start = start and dt.date.fromisoformat(start)
    df = spark.createDataFrame([(start,), (None,)], "day date")
    assert calendar_spine(spark, first_day(df, "day"), SETTINGS).count() == count


def test_days_of_entities(spark):
    entities = spark.createDataFrame([("a",), (None,)], "e string")
    df = spark.createDataFrame([(dt.date(2024, 1, 30),)], "day date")
    found = values(with_days(entities, first_day(df, "day"), replace(SETTINGS, as_of=dt.date(2024, 1, 31))))
    assert len(found) == 4
