"""Filters on the days of a build.

They compare the timestamp itself with the start of a day, so that the filter reaches the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.settings import Settings


def _since(staged: DataFrame, day: dt.date) -> DataFrame:
    return staged.filter(F.col("event_timestamp") >= F.lit(f"{day} 00:00:00 UTC").cast("timestamp"))


def incremental_lookback(staged: DataFrame, settings: Settings) -> DataFrame:
    """Events of today and the lookback days before."""
    return _since(staged, settings.lookback_start)


def dev_limit(staged: DataFrame, settings: Settings) -> DataFrame:
    """Events within the development limit, on the targets it applies to."""
    start = settings.dev_limit_start
    return staged if start is None else _since(staged, start)


def dev_limit_days(facts: DataFrame, settings: Settings) -> DataFrame:
    """Executions that started within the development limit, on the targets it applies to."""
    start = settings.dev_limit_start
    return facts if start is None else facts.filter(F.col("statement_date") >= F.lit(start))
