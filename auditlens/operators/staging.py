"""Staging: one flat row per job event, out of the JSON document of each log row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from auditlens.functions.json import scalar
from auditlens.sources.audit_log import union_logs

# The part of the job document that is read, all of it by one parse. Scalars and labels are variants,
# so that an object or a list in their place is told from a text.
JOB_DOCUMENT = """
    jobChange STRUCT<job: STRUCT<
        jobName: VARIANT,
        jobConfig: STRUCT<
            type: VARIANT,
            labels: MAP<STRING, VARIANT>,
            queryConfig: STRUCT<
                query: VARIANT, queryTruncated: VARIANT, destinationTable: VARIANT,
                createDisposition: VARIANT, writeDisposition: VARIANT, defaultDataset: VARIANT,
                priority: VARIANT, statementType: VARIANT>,
            loadConfig: STRUCT<
                destinationTable: VARIANT, createDisposition: VARIANT, writeDisposition: VARIANT>>,
        jobStatus: STRUCT<jobState: VARIANT, errorResult: STRUCT<code: VARIANT, message: VARIANT>>,
        jobStats: STRUCT<
            createTime: VARIANT, startTime: VARIANT, endTime: VARIANT, totalSlotMs: VARIANT,
            queryStats: STRUCT<
                totalProcessedBytes: VARIANT, totalBilledBytes: VARIANT, billingTier: VARIANT,
                referencedTables: ARRAY<STRING>, referencedViews: ARRAY<STRING>,
                outputRowCount: VARIANT, cacheHit: VARIANT>,
            loadStats: STRUCT<totalOutputBytes: VARIANT>>>>
"""

# The fields of a log row outside the document. They are taken out of their structs first, so that
# a scan reads those a query uses and no others.
_LOG_FIELDS = {
    "insert_id": "insertId",
    "event_timestamp": "timestamp",
    "resource_name": "protopayload_auditlog.resourceName",
    "principal_email": "protopayload_auditlog.authenticationInfo.principalEmail",
    "project_id": "resource.labels.project_id",
    "dataset_id": "resource.labels.dataset_id",
    "location": "resource.labels.location",
    "caller_ip_address": "protopayload_auditlog.requestMetadata.callerIp",
    "caller_supplied_user_agent": "protopayload_auditlog.requestMetadata.callerSuppliedUserAgent",
    "service_name": "protopayload_auditlog.serviceName",
    "method_name": "protopayload_auditlog.methodName",
}

# A plain filter on the parsed document would be pushed below the parse and repeat it. A list of no
# or one document keeps test and use on the same parse.
_JOB_CHANGES = f"""
    explode(filter(
        array(from_json(metadata, '{JOB_DOCUMENT}')),
        document -> document.jobChange IS NOT NULL)) AS document
"""

_SECTIONS = (
    "document.jobChange.job AS job",
    f"split({scalar('document.jobChange.job.jobName')}, '/') AS name_parts",
    "document.jobChange.job.jobConfig.labels AS labels",
    "document.jobChange.job.jobConfig.queryConfig AS query",
    "document.jobChange.job.jobConfig.loadConfig AS load",
    "document.jobChange.job.jobStatus AS status",
    "document.jobChange.job.jobStats AS stats",
    "document.jobChange.job.jobStats.queryStats AS usage",
)

_COLUMNS = {
    "insert_id": "insert_id",
    "dashboard_id": "CAST(labels['x-dashboard-uid'] AS STRING)",
    "panel_id": "CAST(labels['x-panel-id'] AS STRING)",
    # projects/<project>/jobs/<job>; NULL if a part is missing.
    "job_id": "get(name_parts, 1) || ':' || get(name_parts, 3)",
    "event_type": "'JobChangeEvent'",
    "event_timestamp": "event_timestamp",
    "resource_name": "resource_name",
    "principal_email": "coalesce(principal_email, 'UNKNOWN')",
    "project_id": "project_id",
    "dataset_id": "dataset_id",
    "location": "location",
    "caller_ip_address": "caller_ip_address",
    "caller_supplied_user_agent": "caller_supplied_user_agent",
    "service_name": "service_name",
    "method_name": "method_name",
    "job_state": scalar("status.jobState"),
    "config_type": scalar("job.jobConfig.type"),
    "error_result_code": scalar("status.errorResult.code"),
    "error_result_message": scalar("status.errorResult.message"),
    "create_time": f"try_to_timestamp({scalar('stats.createTime')})",
    "start_time": f"try_to_timestamp({scalar('stats.startTime')})",
    "end_time": f"try_to_timestamp({scalar('stats.endTime')})",
    "total_slot_ms": f"try_cast({scalar('stats.totalSlotMs')} AS BIGINT)",
    "total_processed_bytes": scalar("usage.totalProcessedBytes"),
    "total_billed_bytes": f"try_cast({scalar('usage.totalBilledBytes')} AS BIGINT)",
    "billing_tier": scalar("usage.billingTier"),
    # An empty list counts as one reference without a name.
    "referenced_tables": "if(size(usage.referencedTables) = 0, array(''), usage.referencedTables)",
    "referenced_views": "if(size(usage.referencedViews) = 0, array(''), usage.referencedViews)",
    "output_row_count": scalar("usage.outputRowCount"),
    "cache_hit": f"try_cast({scalar('usage.cacheHit')} AS BOOLEAN)",
    "total_output_bytes": f"try_cast({scalar('stats.loadStats.totalOutputBytes')} AS BIGINT)",
    "config_labels": "to_json(labels)",
    "query_statement": scalar("query.query"),
    "is_query_truncated": f"try_cast({scalar('query.queryTruncated')} AS BOOLEAN)",
    "destination_table": f"coalesce({scalar('query.destinationTable')}, {scalar('load.destinationTable')})",
    "create_disposition": f"coalesce({scalar('query.createDisposition')}, {scalar('load.createDisposition')})",
    "write_disposition": f"coalesce({scalar('query.writeDisposition')}, {scalar('load.writeDisposition')})",
    "default_dataset": scalar("query.defaultDataset"),
    "query_priority": scalar("query.priority"),
    "statement_type": scalar("query.statementType"),
}


def stage_audit_log(logs: Sequence[DataFrame]) -> DataFrame:
    """Job events of all `logs`, flattened. Rows that are no job change are left out."""
    fields = _aliased(_LOG_FIELDS)
    return (
        union_logs(logs)
        .selectExpr(*fields, "protopayload_auditlog.metadataJson AS metadata")
        .selectExpr(*_LOG_FIELDS, _JOB_CHANGES)
        .selectExpr(*_LOG_FIELDS, *_SECTIONS)
        .selectExpr(*_aliased(_COLUMNS))
    )


def _aliased(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]
