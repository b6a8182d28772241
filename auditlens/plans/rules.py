"""The rules that built tables have to keep, and a run of all of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.operators.checks import check_not_null, check_unique, check_unique_combination
from auditlens.plans.warehouse import Warehouse

# Table, rule and columns.
RULES = [
    ("dim_references", "not_null", ("job_key",)),
    ("dim_users", "not_null", ("user_key",)),
    ("dim_users", "unique", ("user_key",)),
    ("dim_user_agents", "not_null", ("user_agent_key",)),
    ("dim_job_labels", "unique_combination", ("job_key", "label_key")),
    ("dim_job_labels", "not_null", ("job_key",)),
    ("dim_job", "not_null", ("job_key",)),
    ("dim_query_statements", "not_null", ("job_key",)),
    ("dim_date", "unique", ("date_key",)),
    ("dim_date", "unique", ("date_day",)),
    ("dim_date", "unique", ("date_actual",)),
]
# All columns of the calendar but these have a value.
CALENDAR_MAY_LACK = {
    "days_in_month_count",
    "holiday_desc",
    "is_first_day_of_last_month_of_fiscal_quarter",
    "is_first_day_of_last_month_of_fiscal_year",
    "snapshot_join_timestamp",
    "start_of_day_timestamp",
    "end_of_day_timestamp",
}


def rules_of(name: str, table: DataFrame) -> list[tuple[str, tuple[str, ...]]]:
    """Rules (kind, columns) of a table."""
    rules = [(rule, columns) for of, rule, columns in RULES if of == name]
    if name == "dim_date":
        rules += [("not_null", (c,)) for c in table.columns if c not in CALENDAR_MAY_LACK]
    return rules


def broken_rows(warehouse: Warehouse, table: str, rule: str, columns: tuple[str, ...]) -> DataFrame:
    """The rows, values or combinations of a built table that break a rule."""
    checks = {
        "not_null": lambda df: check_not_null(df, columns[0]),
        "unique": lambda df: check_unique(df, columns[0]),
        "unique_combination": partial(check_unique_combination, columns=list(columns)),
    }
    return checks[rule](warehouse.read(table))


def _broken_counts(table: DataFrame, rules: Sequence[tuple[str, tuple[str, ...]]]) -> DataFrame:
    """Rows (rule, n): how many rows, values or combinations break the rule of this number.

    Rows are added up by the columns that have to be unique, and missing values on the way: a scan for
    each such key, and one for a table without any. A missing value is none for `unique`.
    """
    unique = [(i, rule, columns) for i, (rule, columns) in enumerate(rules) if rule != "not_null"]
    missing = {i: columns[0] for i, (rule, columns) in enumerate(rules) if rule == "not_null"}
    sums = [F.count_if(F.col(column).isNull()).alias(f"missing_{i}") for i, column in missing.items()]

    def counted(groups: DataFrame, broken: dict[int, Column]) -> DataFrame:
        one = groups.agg(*(F.coalesce(n, F.lit(0)).alias(str(i)) for i, n in broken.items()))
        pairs = F.array(*(F.struct(F.lit(i).alias("rule"), F.col(str(i)).alias("n")) for i in broken))
        return one.select(F.inline(pairs))

    parts = []
    added = {i: F.sum(f"missing_{i}") for i in missing}
    for i, rule, columns in unique or [(None, None, ())]:
        groups = table.groupBy(*columns).agg(F.count("*").alias("n"), *([] if parts else sums))
        broken = {} if parts else dict(added)
        if i is not None:
            known = F.col(columns[0]).isNotNull() if rule == "unique" else F.lit(True)
            broken[i] = F.count_if((F.col("n") > 1) & known)
        parts.append(counted(groups, broken))
    return reduce(DataFrame.unionByName, parts)


def broken_rules(warehouse: Warehouse) -> list[tuple[str, str, tuple[str, ...], int]]:
    """Rules that a build breaks, with the number of rows that break each. One job per table."""
    found = []
    for table in dict.fromkeys(name for name, _, _ in RULES):
        df = warehouse.read(table)
        rules = rules_of(table, df)
        counts = _broken_counts(df, rules).filter("n > 0").collect()
        found += [(table, *rules[number], n) for number, n in sorted(counts)]
    return found
