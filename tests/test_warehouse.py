import datetime as dt
from dataclasses import replace

import pytest

from rows import values
from auditlens.plans.warehouse import Warehouse, upsert_by_key
from auditlens.session import FOLDER_SETTING, settle, shared_folder
from auditlens.sources.event_log import FIXTURE_SETTINGS as SETTINGS

DAYS = [dt.date(2024, 1, n) for n in (1, 2, 3)]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path), SETTINGS)


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, value int, day date")


def test_other_days_are_kept(spark, warehouse):
    old = [("a", 1, DAYS[0]), ("b", 2, DAYS[1]), (None, 3, None), ("e", 6, DAYS[2])]
    warehouse.write_days("t", frame(spark, old), "day", ["key"])
    new = frame(spark, [("c", 4, DAYS[1]), ("d", 5, DAYS[0]), ("f", 7, None)])
    for _ in range(2):
        table = warehouse.write_days("t", new, "day", ["key"], days=DAYS[1:])
        # The first day and the missing day stay, and the last day has no new rows.
        assert values(table, "key", "value") == [("a", 1), ("c", 4), (None, 3)]
    assert dict(table.dtypes)["day"] == "date"


def test_whole_table_by_day(spark, warehouse):
    warehouse.write_days("t", frame(spark, [("a", 1, DAYS[0])]), "day")
    assert values(warehouse.write_days("t", frame(spark, [("b", 2, DAYS[1])]), "day"), "key") == [("b",)]


def test_several_days_change_at_once(spark, warehouse, tmp_path, monkeypatch):
    old = [("a", 1, DAYS[0]), ("b", 2, DAYS[1]), ("c", 3, DAYS[2])]
    warehouse.write_days("t", frame(spark, old), "day", ["key"])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    opened = warehouse.read("t")
    new = frame(spark, [("d", 4, DAYS[1]), ("e", 5, DAYS[2])])

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "_keep_state", killed)
        with pytest.raises(KeyboardInterrupt):
            warehouse.write_days("t", new, "day", ["key"], days=DAYS[1:])
    # All rows of the run are there by now, and nobody reads them.
    assert values(warehouse.read("t"), "key") == [("a",), ("b",), ("c",)]
    table = warehouse.write_days("t", new, "day", ["key"], days=DAYS[1:])
    assert values(table, "key", "value") == [("a", 1), ("d", 4), ("e", 5)]
    assert values(opened, "key", "value") == [("a", 1), ("b", 2), ("c", 3)]
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert table.columns == ["key", "value", "day"]


def test_days_that_no_state_needs_expire(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), replace(SETTINGS, kept_snapshots=2))
    warehouse.write_days("t", frame(spark, [("a", 1, DAYS[0]), ("b", 1, DAYS[1])]), "day")
    for n in (2, 3, 4):
        table = warehouse.write_days("t", frame(spark, [("b", n, DAYS[1])]), "day", days=DAYS[1:])
    found = sorted(str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t").glob("written*/day=*"))
    assert [p.split("=", 1)[1] for p in found] == [
        "00000000/day=2024-01-01",
        "00000002/day=2024-01-02",
        "00000003/day=2024-01-02",
    ]
    assert values(table, "key", "value") == [("a", 1), ("b", 4)]
    assert values(warehouse.write_days("t", frame(spark, []), "day"), "key") == []


def test_of_two_runs_at_once_one_fails(spark, warehouse):
    warehouse.write_days("t", frame(spark, [("a", 1, DAYS[0])]), "day")
    with pytest.raises(RuntimeError):
        warehouse._keep_state("t", 0, {"schema": "{}", "days": {}})
    assert values(warehouse.read("t"), "key") == [("a",)]


def test_full_write_replaces(spark, warehouse):
    warehouse.write_full("t", frame(spark, [("a", 1, DAYS[0])]))
    table = warehouse.write_full("t", frame(spark, [("b", 2, DAYS[0])]), ["key"])
    assert values(table, "key") == [("b",)]


def test_upsert(spark, warehouse):
    warehouse.upsert("t", frame(spark, [("a", 1, DAYS[0]), ("b", 1, DAYS[0]), (None, 1, None)]), ["key"])
    new = frame(spark, [("b", 2, DAYS[0]), (None, 2, None), ("c", 2, None)])
    for _ in range(2):
        table = warehouse.upsert("t", new, ["key"], ["key"])
        assert values(table, "key", "value") == [("a", 1), ("b", 2), ("c", 2), (None, 2)]


def folders(path):
    return sorted(p.name for p in path.iterdir())


def test_an_upsert_writes_its_own_rows_only(spark, warehouse, tmp_path):
    warehouse.upsert("t", frame(spark, [(f"k{n}", 0, DAYS[0]) for n in range(500)]), ["key"], ["key"])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    table = warehouse.upsert("t", frame(spark, [("k7", 1, None), ("k7", 2, None), (None, 3, None)]), ["key"], ["key"])
    written = [str(p) for p in (tmp_path / "t").rglob("*.parquet") if p not in before]
    assert spark.read.parquet(*written).count() == 3
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert table.count() == 502 and table.columns == ["key", "value", "day"]
    assert values(table.filter("value > 0"), "key", "value") == [("k7", 1), ("k7", 2), (None, 3)]
    # The newest version of a key counts, also one that an earlier version had brought.
    table = warehouse.upsert("t", frame(spark, [("k7", 4, None), ("k8", 5, None)]), ["key"], ["key"])
    assert values(table.filter("value > 0"), "key", "value") == [("k7", 4), ("k8", 5), (None, 3)]
    assert warehouse.upsert("t", frame(spark, []), ["key"]).count() == 501


def test_versions_are_compacted_and_old_ones_expire(spark, tmp_path):
    settings = replace(SETTINGS, versions_per_snapshot=2, kept_snapshots=2)
    warehouse = Warehouse(spark, str(tmp_path), settings)
    for n in range(5):
        before = warehouse.upsert("t", frame(spark, [("a", n, None), (f"k{n}", n, None)]), ["key"])
    assert folders(tmp_path / "t") == ["snapshot=00000003", "snapshot=00000006", "version=00000004", "version=00000005"]
    assert values(before, "key", "value") == [("a", 4), *((f"k{n}", n) for n in range(5))]
    # A reader is not disturbed by the next version, nor by the next snapshot.
    for n in (8, 9):
        opened = warehouse.read("t")
        warehouse.upsert("t", frame(spark, [("a", n, None)]), ["key"])
    assert folders(tmp_path / "t") == ["snapshot=00000006", "snapshot=00000009", "version=00000007", "version=00000008"]
    assert values(before, "key", "value") == [("a", 4), *((f"k{n}", n) for n in range(5))]
    assert values(opened.filter("key = 'a'"), "value") == [(8,)]
    assert values(warehouse.read("t").filter("key = 'a'"), "value") == [(9,)]


def test_a_version_without_end_is_not_read(spark, warehouse, tmp_path):
    warehouse.upsert("t", frame(spark, [("a", 1, None)]), ["key"])
    frame(spark, [("a", 2, None)]).write.parquet(str(tmp_path / "t" / "version=00000001"))
    (tmp_path / "t" / "version=00000001" / "_SUCCESS").unlink()
    assert values(warehouse.read("t"), "value") == [(1,)]
    assert values(warehouse.upsert("t", frame(spark, [("b", 3, None)]), ["key"]), "key", "value") == [("a", 1), ("b", 3)]


def test_a_snapshot_without_end_is_not_read(spark, warehouse, tmp_path):
    warehouse.upsert("t", frame(spark, [("a", 1, DAYS[0])]), ["key"])
    (tmp_path / "t" / "snapshot=00000007").mkdir()
    assert values(warehouse.read("t"), "key") == [("a",)]


def test_composite_keys(spark):
    old = frame(spark, [("a", 1, DAYS[0]), ("a", None, DAYS[0]), ("b", None, DAYS[0])])
    new = frame(spark, [("a", None, DAYS[1])])
    assert values(upsert_by_key(old, new, ["key", "value"])) == [
        ("a", 1, DAYS[0]),
        ("a", None, DAYS[1]),
        ("b", None, DAYS[0]),
    ]


def test_reports_are_read_by_day(spark, warehouse):
    warehouse.write_days("r", frame(spark, [("a", 1, d) for d in DAYS]), "day")
    with pytest.raises(ValueError):
        warehouse.read_report("r", day="day")
    found = warehouse.read_report("r", DAYS[1], DAYS[2], "day")
    assert found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    free = Warehouse(spark, warehouse.root, replace(SETTINGS, require_partition_filter=False))
    assert free.read_report("r", day="day").count() == 3


def test_settled_frames_live_in_the_shared_folder(spark):
    df = settle(spark.range(5), "five")
    assert all(shared_folder(spark) in name for name in df.inputFiles())
    assert shared_folder(spark) == spark.conf.get(FOLDER_SETTING)
    assert df.count() == 5
