import datetime as dt

import pytest

from rows import values
from auditlens import CustomClient, Settings
from auditlens.functions.columns import cost
from auditlens.operators import marts
from auditlens.operators.checks import check_not_null, check_unique, check_unique_combination

SETTINGS = Settings(as_of=dt.date(2024, 1, 31), prod_datasets=("marts",), stage_datasets=("stg",))


def test_labels(spark):
    rows = [
        ("a", None),
        ("b", "{}"),
        ("c", '{"k":"v"}'),
        ("d", '{"k":"x,y","l":"1:2"}'),
        ("e", '{"alone"}'),
        (None, '{"k":"v"}'),
    ]
    staged = spark.createDataFrame(rows, "job_id string, config_labels string")
    labels = marts.dim_job_labels(staged)
    assert values(labels, "label_key", "label_value") == [
        ("alone", None),
        ("k", "v"),
        ("k", "v"),
        ("k", "x"),
        ("l", "1"),
        ("y", None),
    ]
    assert labels.filter("length(job_key) <> 32").count() == 0


def test_references(spark):
    path = "projects/p/datasets/{}/tables/{}"
    rows = [
        ("a", None, [path.format("marts", "v")]),
        ("b", [""], None),
        ("c", ["projects/p"], None),
        ("d", [path.format("stg", "t")], [path.format("stg", "t")]),
        ("d", [path.format("stg", "t")], None),
    ]
    staged = spark.createDataFrame(
        rows, "job_id string, referenced_tables array<string>, referenced_views array<string>"
    )
    refs = marts.dim_references(staged, SETTINGS)
    assert values(refs, "object_type", "qualified_table_name", "layer_used") == [
        ("table", "p.stg.t", "stage"),
        ("table", None, "None"),
        ("table", None, "None"),
        ("view", "p.marts.v", "prod"),
        ("view", "p.stg.t", "stage"),
    ]


AGENTS = [
    ("x", "a@b", '{"sheets_trigger":"user"}', "Connected Sheet - User Initiated"),
    ("x", "a@b", '{"sheets_trigger":"schedule"}', "Connected Sheet - Scheduled"),
    ("x", "a@b", '{"data_source_id":"scheduled_query"}', "Scheduled Query"),
    ("Mozilla/5.0", "a@b", None, "Web console"),
    ("Mozilla/5.0", "a@b", '{"dbt_invocation_id":"1"}', "Web console"),
    ("Mozilla/5.0", "a@b", '{"sheets_trigger":"user"}', "Connected Sheet - User Initiated"),
    ("x", "a@b", '{"dbt_invocation_id":"1"}', "dbt run"),
    ("dbt/1", "a@b", None, "dbt run"),
    ("gl-python/3", "a@b", None, "Python Client"),
    ("Fivetran/1", "a@b", None, "Fivetran"),
    ("Hightouch/1", "a@b", None, "Hightouch"),
    ("gcloud-golang-bigquery/1", "rudderstack@b", None, "Rudderstack"),
    ("gcloud-golang-bigquery/1", "a@b", None, "Golang Client"),
    ("google-api-go/1", "a@b", None, "Golang Client"),
    ("gcloud-node/1", "a@b", None, "Node Client"),
    ("SimbaJDBCDriver/1", "a@b", None, "Java Client"),
    ("google-cloud-sdk/1", "a@b", None, "Google Cloud SDK"),
    ("a Mozilla", "a@b", None, "a Mozilla"),
    (None, "a@b", None, "Unknown"),
]


@pytest.fixture
def agents(spark):
    return spark.createDataFrame(
        [(agent, email, labels, "p") for agent, email, labels, _ in AGENTS],
        "caller_supplied_user_agent string, principal_email string, config_labels string, "
        "project_id string",
    )


def test_client_types(agents):
    found = values(marts.dim_user_agents(agents, SETTINGS), "caller_supplied_user_agent", "client_type")
    assert set(found) == {(agent, kind) for agent, _, _, kind in AGENTS}


def test_custom_clients_come_first_and_are_literal(agents):
    clients = (
        CustomClient("Sync", user_agent="gcloud", principal_email="rudder"),
        CustomClient("Web", user_agent="Mozilla"),
        CustomClient("None", user_agent="gl_python"),
    )
    settings = Settings(as_of=SETTINGS.as_of, custom_clients=clients)
    found = dict(values(marts.dim_user_agents(agents, settings), "principal_email", "client_type"))
    assert found["rudderstack@b"] == "Sync"
    kinds = {k for k, in values(marts.dim_user_agents(agents, settings), "client_type")}
    assert "Web" in kinds and "Web console" not in kinds and "None" not in kinds
    with pytest.raises(ValueError):
        CustomClient("nothing")


def test_users(spark):
    rows = [("a@b.com", "p"), ("a@b.com", "q"), ("UNKNOWN", "p"), ("s@x.iam.gserviceaccount.com", None)]
    users = marts.dim_users(spark.createDataFrame(rows, "principal_email string, project_id string"))
    assert values(users, "username", "user_type", "project_id") == [
        ("UNKNOWN", "User", "p"),
        ("a", "User", "p"),
        ("a", "User", "q"),
        ("s", "Service Account", None),
    ]
    assert check_unique(users, "user_key").count() == 0


def test_job_comment(spark):
    base = ["d", "p", "j", "proj", "e", "r", "ip", "m", "c", "SELECT", "prio"]
    texts = [
        '/* {"node_id": "model.shop.orders", "dbt_version": "1.3"} */ select 1',
        '/* {"node_id": "test.shop.x.y"} */\nselect 2',
        '/* {"node_id": "snapshot.shop"} */ select 3',
        '/* {"node_id": "seed.shop.s"} */ select 4',
        'select 5 /* {"node_id": "model.shop.orders"} */',
        "/* {broken} */ select 6",
        None,
    ]
    names = (
        "dashboard_id panel_id job_id project_id event_type resource_name "
        "caller_ip_address method_name create_disposition statement_type query_priority"
    ).split()
    schema = ", ".join(f"{n} string" for n in names) + ", query_statement string, cache_hit boolean"
    staged = spark.createDataFrame([(*base[:2], str(i), *base[3:], t, True) for i, t in enumerate(texts)], schema)
    jobs = marts.dim_job(staged)
    assert values(jobs, "job_id", "dbt_execution_type", "dbt_model_name", "dbt_version") == [
        ("0", "DBT_RUN", "shop.orders", "1.3"),
        ("1", "DBT_TEST", "shop.x", None),
        ("2", "DBT_SNAPSHOT", None, None),
        ("3", None, "shop.s", None),
        ("4", None, None, None),
        ("5", None, None, None),
        ("6", None, None, None),
    ]
    infos = dict(values(marts.dim_query_statements(staged), "job_id", "dbt_info"))
    assert infos["5"] == " {broken} " and infos["4"] is None


def test_keys_of_missing_job_ids_are_equal(spark):
    staged = spark.createDataFrame(
        [(None, '{"a":"b"}'), (None, '{"c":"d"}'), ("x", '{"a":"b"}')],
        "job_id string, config_labels string",
    )
    assert marts.dim_job_labels(staged).select("job_key").distinct().count() == 2


def test_cost_by_schedule(spark):
    df = spark.createDataFrame([(2**40, 3_600_000), (None, None)], "b long, ms long")
    slots = Settings(as_of=SETTINGS.as_of, pricing_schedule="enterprise")
    found = values(df.select(cost("b", SETTINGS).alias("d"), cost("ms", slots).alias("s")))
    assert found == [(6.225, 1 / 0.06), (None, None)]
    with pytest.raises(ValueError):
        Settings(as_of=SETTINGS.as_of, pricing_schedule="monthly")


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, None)], "k int, v string")
    assert values(check_unique_combination(df, ["k", "v"])) == [(1, "a")]
    assert values(check_unique(df, "v")) == [("a", 2)]
    assert values(check_not_null(df, "v")) == [(2, None), (3, None)]
