import datetime as dt
import json

import pytest

from auditlens.plans import run
from auditlens.session import shared_folder
from auditlens.sources.event_log import event_log


def test_settings_from_json():
    values = {
        "prod_datasets": ["marts"],
        "custom_clients": [{"client_name": "c", "user_agent": "a"}],
        "slot_prices": {"standard": 1.0},
        "pricing_schedule": "standard",
    }
    settings = run.settings_from(values, dt.date(2024, 1, 31))
    assert settings.prod_datasets == ("marts",)
    assert settings.custom_clients[0].user_agent == "a"
    with pytest.raises(TypeError):
        run.settings_from({"unknown": 1}, dt.date(2024, 1, 31))


def test_command_line(spark, tmp_path):
    event_log(spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "log"))
    (tmp_path / "settings.json").write_text(json.dumps({"prod_datasets": ["marts"]}))
    root = tmp_path / "warehouse"
    run.main(
        ["--log", str(tmp_path / "log"), "--warehouse", str(root), "--as-of", "2024-01-31"]
        + ["--settings", str(tmp_path / "settings.json")]
    )
    assert spark.read.parquet(str(root / "rpt_table_usage")).count() > 0
    folder = shared_folder(spark)
    settled = spark.sparkContext.applicationId
    assert not list((type(tmp_path)(folder) / "auditlens").glob(f"{settled}/*"))
