import json

from rows import values
from auditlens.operators.staging import stage_audit_log
from auditlens.sources.audit_log import LOG_SCHEMA, read_logs


def log_row(document, insert_id="i", email="a@b.com"):
    text = document if isinstance(document, str) or document is None else json.dumps(document)
    place = ("p", None, "US")
    payload = ("r", "s", "m", text, (email,), ("1.2.3.4", "agent"))
    return (insert_id, None, (place,), payload)


def stage(spark, *rows):
    return stage_audit_log([spark.createDataFrame(list(rows), LOG_SCHEMA)])


def job(**parts):
    return {"jobChange": {"job": parts}}


def test_only_job_changes_are_kept(spark):
    staged = stage(
        spark,
        log_row({"tableDataRead": {}}, "other"),
        log_row("{broken", "broken"),
        log_row(None, "none"),
        log_row({"jobChange": None}, "null"),
        log_row(job(), "empty"),
        log_row(job(jobName="projects/p/jobs/j"), "job"),
    )
    assert values(staged, "insert_id", "job_id") == [("empty", None), ("job", "p:j")]


def test_values_that_do_not_fit_become_null(spark):
    stats = {
        "startTime": "2024-01-02T03:04:05.678901Z",
        "totalSlotMs": "many",
        "queryStats": {"totalBilledBytes": "12.5", "cacheHit": "perhaps"},
        "loadStats": {"totalOutputBytes": "77"},
    }
    staged = stage(spark, log_row(job(jobStats=stats)))
    row = staged.first()
    assert str(row.start_time) == "2024-01-02 03:04:05.678901"
    assert (row.total_slot_ms, row.total_billed_bytes, row.cache_hit) == (None, None, None)
    assert row.total_output_bytes == 77


def test_numbers_and_booleans_in_the_document(spark):
    stats = {"totalSlotMs": 5, "queryStats": {"totalBilledBytes": 6, "cacheHit": True, "billingTier": 1}}
    status = {"errorResult": {"code": 11, "message": "m"}}
    row = stage(spark, log_row(job(jobStats=stats, jobStatus=status))).first()
    assert (row.total_slot_ms, row.total_billed_bytes, row.cache_hit) == (5, 6, True)
    assert (row.billing_tier, row.error_result_code) == ("1", "11")


def test_job_id_needs_both_parts(spark):
    staged = stage(spark, log_row(job(jobName="projects/p"), "a"), log_row(job(jobName="x/p/y/j"), "b"))
    assert values(staged, "insert_id", "job_id") == [("a", None), ("b", "p:j")]


def test_references_absent_empty_and_listed(spark):
    def tables(value):
        return job(jobStats={"queryStats": {"referencedTables": value} if value is not None else {}})

    staged = stage(
        spark, log_row(tables(None), "a"), log_row(tables([]), "b"), log_row(tables(["x", "y"]), "c")
    )
    assert values(staged, "insert_id", "referenced_tables") == [
        ("a", None),
        ("b", [""]),
        ("c", ["x", "y"]),
    ]


def test_labels_and_configurations(spark):
    config = {
        "labels": {"x-dashboard-uid": "d", "x-panel-id": "p"},
        "loadConfig": {"destinationTable": "t", "writeDisposition": "W"},
        "queryConfig": {"writeDisposition": "Q", "queryTruncated": False},
    }
    row = stage(spark, log_row(job(jobConfig=config))).first()
    assert (row.dashboard_id, row.panel_id) == ("d", "p")
    assert json.loads(row.config_labels) == config["labels"]
    assert (row.destination_table, row.write_disposition) == ("t", "Q")
    assert row.is_query_truncated is False


def test_missing_principal_is_unknown(spark):
    assert stage(spark, log_row(job(), email=None)).first().principal_email == "UNKNOWN"


def test_sources_are_united_with_duplicates(spark):
    log = spark.createDataFrame([log_row(job(jobName="a/b/c/d"))], LOG_SCHEMA)
    assert stage_audit_log([log, log, log]).count() == 3


def test_logs_are_read_from_parquet(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("one", "two")]
    for path in paths:
        spark.createDataFrame([log_row(job())], LOG_SCHEMA).write.parquet(path)
    assert stage_audit_log([read_logs(spark, paths)]).count() == 2


def test_objects_and_lists_are_no_scalars(spark):
    status = {"jobState": {"a": 1}, "errorResult": {"code": ["x"], "message": "{plain text"}}
    config = {
        "type": "[also plain",
        "labels": {"k": {"z": 1}, "l": ["x"], "m": "{t}", "n": 5},
        "queryConfig": {"query": {"q": 1}, "destinationTable": ["t"], "priority": None},
        "loadConfig": {"destinationTable": "{t}"},
    }
    stats = {"startTime": {"s": 1}, "totalSlotMs": [5], "queryStats": {"cacheHit": {}, "billingTier": []}}
    row = stage(spark, log_row(job(jobName=["projects/p/jobs/j"], jobStatus=status, jobConfig=config, jobStats=stats))).first()
    assert (row.job_state, row.error_result_code, row.error_result_message) == (None, None, "{plain text")
    assert (row.config_type, row.query_statement, row.destination_table) == ("[also plain", None, "{t}")
    assert (row.job_id, row.start_time, row.total_slot_ms, row.cache_hit, row.billing_tier) == (None,) * 5
    assert row.config_labels == '{"k":{"z":1},"l":["x"],"m":"{t}","n":5}'


def test_the_document_is_parsed_once(spark):
    plan = stage(spark, log_row(job()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and "get_json_object" not in plan
