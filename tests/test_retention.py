"""What nothing points to goes; what anything points to, or is young, stays."""

import os
import time
from datetime import date, timedelta
from pathlib import Path

import pytest

from grovemart.plans import jobs, retention
from grovemart.session import runs_folder
from grovemart.sources.landing import land
from tests.helpers import raw_frame
from tests.test_jobs import ROWS1, ROWS2, _state

DAY1, DAY2 = date(2020, 1, 5), date(2020, 2, 5)
NOW = timedelta(0)


@pytest.fixture
def lake(tmp_path):
    (tmp_path / "landing").mkdir()
    return jobs.Lake(str(tmp_path / "landing"), str(tmp_path / "tables"), log_every=2)


def _folders(lake):
    """Folders of files, below the lake."""
    return {str(p.parent.relative_to(lake.root)) for p in Path(lake.root).rglob("*") if p.is_file() and not p.name.startswith(".")}


def test_only_what_is_reachable_stays(spark, lake):
    for rows, day in ((ROWS1, DAY1), (ROWS1, DAY2)):
        land(raw_frame(spark, rows), lake.landing, day, "areas [1]+é")
    jobs.run_all(spark, lake, "r1")
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas [1]+é")
    jobs.run_all(spark, lake, "r2")
    before = _state(spark, lake, "areas [1]+é")
    # A broken run, rows nobody committed, a typed table nobody published, a copy nobody finished.
    (Path(lake.history) / "run=broken-0/dataset=x/snapshot_date=2020-01-01").mkdir(parents=True)
    (Path(lake.history) / "run=broken-0/dataset=x/snapshot_date=2020-01-01/part-0.parquet").write_bytes(b"?")
    lost = jobs.log(spark, lake).stage({jobs.REJECTED: jobs.rejections(spark, lake)})
    for name in (lake.typed("areas [1]+é", "broken"), lake.star("areas [1]+é", "broken", "fat_area")):
        Path(name).mkdir(parents=True)
    (Path(lake.landing) / "year=2020/month=01/day=05/downloaded/_incoming-x").mkdir()
    found = retention.sweep(spark, lake, NOW)
    assert found == {"history": 2, "pending": 2, "log": 1, "runs": 2, "unfinished": 1, "sessions": 0}
    left = _folders(lake)
    assert {f for f in left if f.startswith("history")} == {
        f"history/run={run}-0/dataset=areas %5B1%5D+é/snapshot_date={day}" for run, day in (("r1", DAY1), ("r2", DAY2))
    } | {f for f in left if f.startswith("history") and f.count("/") == 1}
    assert not [f for f in left if lost.token in f or f.startswith("pending") or "broken" in f]
    assert _state(spark, lake, "areas [1]+é") == before
    assert jobs.run_all(spark, lake, "r3") == {}
    assert set(retention.sweep(spark, lake, NOW).values()) == {0, 1}


def test_what_is_young_stays(spark, lake, monkeypatch):
    """A job at work has folders that nothing points to yet."""
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    stage = jobs.Log.stage
    swept = []

    def in_between(self, rows):
        swept.append(retention.sweep(spark, lake))
        return stage(self, rows)

    monkeypatch.setattr(jobs.Log, "stage", in_between)
    jobs.run_all(spark, lake)
    assert swept and not any(sum(found.values()) for found in swept)
    assert jobs.read_star(spark, lake, "areas")["fat_area"].count() == 2


def test_tables_of_other_sessions(spark, lake):
    own, other = spark.conf.get("spark.app.id"), Path(runs_folder(spark)) / "an-old-session"
    (Path(runs_folder(spark)) / own).mkdir(parents=True, exist_ok=True)
    (other / "t").mkdir(parents=True)
    assert retention.unreachable(spark, lake)["sessions"] == []
    at = time.time() - 3 * 86_400
    os.utime(other, (at, at))
    assert retention.sweep(spark, lake)["sessions"] == 1
    assert not other.exists() and (Path(runs_folder(spark)) / own).exists()
