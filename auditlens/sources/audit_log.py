"""The audit log: its shape, and how one or more log tables are read as one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

LOG_SCHEMA = """
    insertId STRING,
    timestamp TIMESTAMP,
    resource STRUCT<labels: STRUCT<project_id: STRING, dataset_id: STRING, location: STRING>>,
    protopayload_auditlog STRUCT<
        resourceName: STRING,
        serviceName: STRING,
        methodName: STRING,
        metadataJson: STRING,
        authenticationInfo: STRUCT<principalEmail: STRING>,
        requestMetadata: STRUCT<callerIp: STRING, callerSuppliedUserAgent: STRING>>
"""


def union_logs(logs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all log tables, duplicates kept."""
    if not logs:
        raise ValueError("at least one audit log is needed")
    return reduce(DataFrame.unionByName, logs)


def read_logs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Read log tables kept as Parquet. Columns the engine does not know are never read."""
    return union_logs([spark.read.schema(LOG_SCHEMA).parquet(path) for path in paths])
