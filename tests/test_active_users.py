import datetime as dt
from dataclasses import replace

from auditlens.operators.active_users import table_active_users
from auditlens.sources.event_log import FIXTURE_SETTINGS

START = dt.date(2024, 1, 1)


def daily_counts(visits, as_of):
    """The direct form: for each table, user and day, count active days in the window."""
    days = [START + dt.timedelta(n) for n in range((as_of - START).days + 1)]
    tables, users = {t for t, _, _ in visits}, {u for _, u, _ in visits}
    result = {}
    for table in tables:
        status = {"weekly": [], "monthly": []}
        for day in days:
            active = [
                sum((table, user, day - dt.timedelta(n)) in visits for n in range(30)) for user in users
            ]
            status["weekly"].append(sum(a >= 5 for a in active))
            status["monthly"].append(sum(1 <= a <= 4 for a in active))
        for n, day in enumerate(days):
            window = slice(max(0, n - 29), n + 1)
            result[day, table] = (sum(status["weekly"][window]), sum(status["monthly"][window]))
    return result


def test_class_limits_gaps_and_window(spark):
    def on(table, user, *days):
        return {(table, user, START + dt.timedelta(d)) for d in days}

    visits = (
        on("t", "four", 0, 1, 2, 3)
        | on("t", "five", 0, 1, 2, 3, 4)
        | on("t", "gap", 0, 40)
        | on("t", "edge", 0, 29, 30)
        | on("u", "late", 70)
    )
    as_of = START + dt.timedelta(75)
    rows = [
        (f"j{n}", dt.datetime.combine(day, dt.time(12)), user, [table])
        for n, (table, user, day) in enumerate(sorted(visits))
    ]
    rows += [
        ("s", dt.datetime(2024, 1, 1), "x@p.iam.gserviceaccount.com", ["t"]),
        (None, dt.datetime(2024, 1, 1), "no-job", ["t"]),
    ]
    staged = spark.createDataFrame(
        rows, "job_id string, event_timestamp timestamp, principal_email string, referenced_tables array<string>"
    )
    found = {
        (r.event_date, r.table_name): (
            r.human_weekly_active_users_30_day_cnt,
            r.human_monthly_active_users_30_day_cnt,
        )
        for r in table_active_users(staged, replace(FIXTURE_SETTINGS, as_of=as_of)).collect()
    }
    assert found == daily_counts(visits, as_of)
