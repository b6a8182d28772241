"""Column builders: keys, statement comments, data layers, client types and cost."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlens.functions.json import scalar
from auditlens.settings import CustomClient, Settings

# Fixed values that results depend on: the mark of service accounts, the leading comment of a
# statement, and the texts for what is missing.
SERVICE_SUFFIX = ".iam.gserviceaccount.com"
STATEMENT_COMMENT = r"(?s)^/\* \{.+?\} \*/"
NO_ERROR = "NONE"
NO_LAYER = "None"
NO_CLIENT = "Unknown"

# Stands for NULL inside keys. Keys are internal, so any text that no field holds will do.
_NULL_IN_KEY = "<null>"


def surrogate_key(*fields: str) -> Column:
    """MD5 over the fields as text. Fields that are all missing give one and the same key."""
    texts = (f"coalesce(CAST({field} AS STRING), '{_NULL_IN_KEY}')" for field in fields)
    return F.expr(f"md5(concat_ws('-', {', '.join(texts)}))")


def job_key() -> Column:
    return surrogate_key("job_id").alias("job_key")


def is_error(error_message_key: str) -> Column:
    """Whether a key stands for anything but code and message NONE. Spark folds the constant."""
    return F.col(error_message_key) != surrogate_key(f"'{NO_ERROR}'", f"'{NO_ERROR}'")


def statement_comment(statement: str) -> Column:
    """The JSON text in the comment that leads a statement, or NULL."""
    comment = F.regexp_extract(statement, STATEMENT_COMMENT, 0)
    return F.nullif(F.translate(comment, "/*", ""), F.lit(""))


def user_type(email: str) -> Column:
    return F.when(F.endswith(F.col(email), F.lit(SERVICE_SUFFIX)), "Service Account").otherwise("User")


def data_layer(dataset: str, settings: Settings) -> Column:
    """Stage before prod, where both lists name a dataset; all other datasets are raw."""
    name = F.col(dataset)
    return (
        F.when(name.isNull(), NO_LAYER)
        .when(name.isin(*settings.stage_datasets), "stage")
        .when(name.isin(*settings.prod_datasets), "prod")
        .otherwise("raw")
    )


# Client types by the start of the agent text, first match wins.
_AGENTS = (
    ("gl-python", "Python Client"),
    ("Fivetran", "Fivetran"),
    ("Hightouch", "Hightouch"),
    ("gcloud-golang", "Golang Client"),
    ("google-api-go", "Golang Client"),
    ("gcloud-node", "Node Client"),
    ("SimbaJDBCDriver", "Java Client"),
    ("google-cloud-sdk", "Google Cloud SDK"),
)
_SHEETS = (("user", "Connected Sheet - User Initiated"), ("schedule", "Connected Sheet - Scheduled"))


def _custom_client(client: CustomClient, agent: Column, email: Column) -> Column:
    found = F.lit(True)
    if client.user_agent:
        found = found & agent.startswith(client.user_agent)
    if client.principal_email:
        found = found & email.contains(client.principal_email)
    return found


# Labels that tell the client type, and the kinds of label text that `client_label` gives.
CLIENT_LABELS = ("sheets_trigger", "data_source_id", "dbt_invocation_id")
_SCHEDULED, _BUILD = "scheduled", "build"


def client_label(labels: str) -> Column:
    """What the labels of a row say about its client: a sheet's trigger, a scheduled query, a build.

    The first that holds is enough: a sheet and a scheduled query come before all agents, a build last.
    """
    trigger, source, build = (F.expr(scalar(f"{labels}.{name}")) for name in CLIENT_LABELS)
    kind = F.when(trigger.isin(*(t for t, _ in _SHEETS)), trigger).when(source == "scheduled_query", _SCHEDULED)
    return kind.when(build.isNotNull(), _BUILD)


def client_type(label: str, settings: Settings) -> Column:
    """Client type of a row: custom clients, then its `client_label`, then the agent's name."""
    agent, email, kind = F.col("caller_supplied_user_agent"), F.col("principal_email"), F.col(label)
    rules: list[tuple[Column, str]] = [
        (_custom_client(client, agent, email), client.client_name)
        for client in settings.custom_clients
    ]
    rules += [(kind == trigger, name) for trigger, name in _SHEETS]
    rules += [
        (kind == _SCHEDULED, "Scheduled Query"),
        (agent.startswith("Mozilla"), "Web console"),
        ((kind == _BUILD) | agent.startswith("dbt"), "dbt run"),
    ]
    rules += _agent_rules(agent, email)
    return _first_match(rules, F.coalesce(agent, F.lit(NO_CLIENT)))


def _agent_rules(agent: Column, email: Column) -> list[tuple[Column, str]]:
    rules = [(agent.startswith(start), name) for start, name in _AGENTS]
    # One sender is told from other programs in its language by its account.
    rudderstack = agent.startswith("gcloud-golang-bigquery") & email.startswith("rudderstack")
    return [(rudderstack, "Rudderstack"), *rules]


def _first_match(rules: Iterable[tuple[Column, str]], fallback: Column) -> Column:
    result: Column | None = None
    for condition, name in rules:
        result = F.when(condition, name) if result is None else result.when(condition, name)
    return fallback if result is None else result.otherwise(fallback)


# Cost is linear in one measure of the execution. So builders add up that measure as whole numbers,
# exactly and in any order, and price the sum.


def cost_measure(settings: Settings) -> str:
    """The measure that the pricing schedule charges."""
    return "total_billed_bytes" if settings.pricing_schedule == "on_demand" else "total_slot_ms"


def exact(measure: str | Column) -> Column:
    """A measure to add up without overflow, however large the group."""
    column = F.col(measure) if isinstance(measure, str) else measure
    return column.cast("decimal(20,0)")


def cost(amount: str | Column, settings: Settings) -> Column:
    """Price of an amount of `cost_measure`.

    On demand: bytes in TiB times the price. By slot time: hours *divided* by the price of the
    edition, and always from `total_slot_ms`; both are how the figures are defined.
    """
    column = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    if settings.pricing_schedule == "on_demand":
        return column / F.lit(float(2**40)) * F.lit(settings.on_demand_price_per_tib)
    return column / F.lit(3_600_000 * settings.slot_prices[settings.pricing_schedule])


def safe_rate(part: str, whole: str, scale: float = 1.0) -> Column:
    """part / whole times scale to three decimals, 0 where the whole is 0."""
    ratio = F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))
    return F.round(F.coalesce(ratio, F.lit(0.0)) * scale, 3)
