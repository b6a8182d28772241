"""Command line of a build, for spark-submit.

    spark-submit auditlens/plans/run.py --log <path> [--log <path> ..] --warehouse <path> \\
        --as-of 2024-01-31 [--settings settings.json] [--incremental]

The settings file is a JSON object with names of `auditlens.Settings`; custom clients are objects
with client_name, user_agent and principal_email.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from auditlens import CustomClient, Settings  # noqa: E402
from auditlens.plans.pipeline import Build  # noqa: E402
from auditlens.plans.rules import broken_rules  # noqa: E402
from auditlens.plans.warehouse import Warehouse  # noqa: E402
from auditlens.session import drop_settled, use_utc  # noqa: E402
from auditlens.sources.audit_log import read_logs  # noqa: E402


def settings_from(values: dict, as_of: dt.date) -> Settings:
    """Settings from plain JSON values; names that do not exist are errors."""
    known = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items()}
    if "custom_clients" in known:
        known["custom_clients"] = tuple(CustomClient(**client) for client in known["custom_clients"])
    return Settings(as_of=as_of, **known)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build all tables from audit logs.")
    parser.add_argument("--log", action="append", required=True, help="Parquet path of a log table")
    parser.add_argument("--warehouse", required=True, help="folder of the output tables")
    parser.add_argument("--as-of", required=True, type=dt.date.fromisoformat, help="today's date")
    parser.add_argument("--settings", type=Path, help="JSON file with settings")
    parser.add_argument("--incremental", action="store_true", help="the last days only")
    parser.add_argument("--check", action="store_true", help="check the tables after the build")
    options = parser.parse_args(arguments)

    values = json.loads(options.settings.read_text()) if options.settings else {}
    spark = use_utc(SparkSession.builder.appName("auditlens").getOrCreate())
    warehouse = Warehouse(spark, options.warehouse, settings_from(values, options.as_of))
    try:
        Build([read_logs(spark, options.log)], warehouse, options.incremental).run()
        broken = broken_rules(warehouse) if options.check else []
    finally:
        drop_settled(spark)
    for table, rule, columns, rows in broken:
        print(f"{table}: {rows} rows break {rule} of {', '.join(columns)}")
    if broken:
        raise SystemExit(1)


if __name__ == "__main__":
    main()
