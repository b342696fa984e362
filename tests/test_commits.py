"""The log of commits, and jobs that run at the same time."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path
from threading import Barrier

import pytest

from grovemart.plans import jobs
from grovemart.schema import FACT_AREA
from grovemart.sources.commits import Log
from grovemart.sources.files import create_new
from grovemart.sources.landing import land
from grovemart.streaming.ingest import ingest_available
from tests.helpers import raw_frame, rows_of

DAY1, DAY2 = date(2020, 1, 5), date(2020, 2, 5)
ROWS1 = [("01/02/2013", "3", "Pinus", "10"), ("03/02/2013", "1", None, None)]
ROWS2 = [("01/02/2014", "3", "Pinus", "12"), ("03/02/2014", "2", "Açaí", "-"), ("04/02/2014", "2", "Açaí", "5")]
SCHEMA = "k long, v string"


@pytest.fixture
def lake(tmp_path):
    (tmp_path / "landing").mkdir()
    return jobs.Lake(str(tmp_path / "landing"), str(tmp_path / "tables"))


def _log(spark, path, every=16, merged=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    return Log(spark, str(path), {"a": schema, "b": schema}, merged or {}, every)


def _put(log, version=None, **rows):
    frames = {name: log.spark.createDataFrame(r, SCHEMA) for name, r in rows.items()}
    return log.commit(log.stage(frames), log.version() if version is None else version)


def test_one_of_many_creates_a_file(spark, tmp_path):
    path, start = str(tmp_path / "x/1.commit"), Barrier(8)

    def create(i):
        start.wait()
        return create_new(spark, path, f"writer {i}")

    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(create, range(8)))
    assert done.count(True) == 1
    assert Path(path).read_text() == f"writer {done.index(True)}"
    assert [p.name for p in Path(path).parent.iterdir() if not p.name.startswith(".")] == ["1.commit"]


def test_rows_count_with_their_commit(spark, tmp_path):
    log = _log(spark, tmp_path / "log")
    assert log.version() == 0 and log.rows("a").count() == 0
    waiting = log.stage({"a": spark.createDataFrame([(1, "x")], SCHEMA), "b": spark.createDataFrame([(2, "y")], SCHEMA)})
    assert log.rows("a").count() == 0
    assert log.commit(waiting, 0) and not _put(log, 0, a=[(9, "late")])
    assert _put(log, a=[(3, "z")])
    assert rows_of(log.rows("a")) == [(1, "x", 1), (3, "z", 2)] and rows_of(log.rows("b")) == [(2, "y", 1)]
    assert rows_of(log.rows("a", after=1)) == [(3, "z", 2)] and rows_of(log.rows("a", upto=1)) == [(1, "x", 1)]


@pytest.mark.parametrize("every", [1, 3, 100])
def test_checkpoints_change_no_row(spark, tmp_path, every):
    log = _log(spark, tmp_path / "log", every)
    for k in range(8):
        assert _put(log, a=[(k, "x")], **({"b": [(k, "y")]} if k % 3 == 0 else {}))
    assert rows_of(log.rows("a")) == [(k, "x", k + 1) for k in range(8)]
    assert rows_of(log.rows("b")) == [(k, "y", k + 1) for k in (0, 3, 6)]
    assert rows_of(log.rows("a", after=4)) == [(k, "x", k + 1) for k in range(4, 8)]


def test_files_read_do_not_grow_with_the_runs(spark, tmp_path):
    """Two hundred runs: as many files to read as after twenty, and rows of old commits are gone from disk."""
    log, read = _log(spark, tmp_path / "log", every=8), {}
    for k in range(1, 201):
        assert _put(log, a=[(k, "x")])
        if k in (20, 28, 196):
            read[k] = len(log.rows("a").inputFiles())
    assert log.rows("a").count() == 200
    assert read[20] == read[28] == read[196] <= 8 + 1
    assert len(list((tmp_path / "log/rows").iterdir())) <= 3 * 8


def test_a_checkpoint_keeps_the_last_row_of_each_path(spark, tmp_path):
    import pyspark.sql.functions as F

    def last(df):
        return df.groupBy("k").agg(F.max_by(F.struct("v", "commit"), "commit").alias("x")).select("k", "x.*")

    log = _log(spark, tmp_path / "log", 4, {"a": last})
    for k in range(9):
        _put(log, a=[(k % 2, str(k))])
    assert rows_of(log.rows("a")) == [(0, "6", 7), (0, "8", 9), (1, "7", 8)]


def _interleaved(monkeypatch, other):
    """Let `other` run in the midst of the next conversion, once."""
    keep, done = jobs._keep, []

    def late(*args):
        if not done:
            done.append(None)
            done[0] = other()
        return keep(*args)

    monkeypatch.setattr(jobs, "_keep", late)
    return done


def test_two_conversions_of_the_same_files(spark, lake, monkeypatch):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
    other = _interleaved(monkeypatch, lambda: jobs.convert(spark, lake, "other"))
    assert jobs.convert(spark, lake, "mine") == {} and other == [{"areas": 3}]
    assert [r["run"] for r in jobs.snapshots(spark, lake).collect()] == ["other-0"] * 2
    assert jobs.history(spark, lake, "areas").count() == 5
    assert sorted(p.name for p in Path(lake.history).iterdir()) == ["run=other-0"]


def test_what_the_other_left_is_taken_in(spark, lake, monkeypatch):
    """The faster job saw the first day only; the slower one keeps the second, and nothing twice."""
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
    part = jobs.Lake(f"{lake.landing}/year=2020/month=01", lake.root)
    _interleaved(monkeypatch, lambda: jobs.convert(spark, part, "other"))
    assert jobs.convert(spark, lake, "mine") == {"areas": 3}
    log = jobs.snapshots(spark, lake).orderBy("commit").select("snapshot_date", "run", "commit")
    assert [tuple(r) for r in log.collect()] == [(DAY1, "other-0", 1), (DAY2, "mine-1-0", 2)]
    assert jobs.history(spark, lake, "areas").count() == 5


def test_jobs_on_different_files_both_commit(spark, lake, monkeypatch):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
    one, two = (jobs.Lake(f"{lake.landing}/year=2020/month=0{m}", lake.root) for m in (1, 2))
    other = _interleaved(monkeypatch, lambda: jobs.convert(spark, two, "other"))
    assert jobs.convert(spark, one, "mine") == {"areas": 3} and other == [{"areas": 3}]
    assert sorted(r["run"] for r in jobs.snapshots(spark, lake).collect()) == ["mine-0", "other-0"]
    assert jobs.convert(spark, lake, "again") == {}


def test_a_stream_beside_the_batch(spark, lake, monkeypatch, tmp_path):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "more")
    _interleaved(monkeypatch, lambda: ingest_available(spark, lake, str(tmp_path / "checkpoint"), "stream"))
    jobs.run_all(spark, lake)
    assert jobs.snapshots(spark, lake).count() == 2
    assert jobs.read_star(spark, lake, "areas")[FACT_AREA].count() == 2
    assert jobs.read_star(spark, lake, "more")[FACT_AREA].count() == 3


def test_many_jobs_at_once(spark, lake):
    for k in range(4):
        land(raw_frame(spark, ROWS2), lake.landing, date(2020, 1, k + 1), "areas")
    with ThreadPoolExecutor(3) as pool:
        reports = list(pool.map(lambda k: jobs.run_all(spark, lake, f"r{k}"), range(3)))
    assert {"areas"} >= set().union(*reports)
    days = jobs.snapshots(spark, lake).groupBy("snapshot_date").count().collect()
    assert [r["count"] for r in days] == [1] * 4
    assert jobs.history(spark, lake, "areas").count() == 12
    assert jobs.read_star(spark, lake, "areas")[FACT_AREA].count() == 3


def test_an_older_typed_table_is_not_published_over_a_newer(spark, lake, monkeypatch):
    """A load that began before a delivery ends after the load of that delivery: the newer one stays."""
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    jobs.convert(spark, lake, "r1")
    whole, done = jobs.write_observed, []

    def slow(df, path, metrics):
        rows = whole(df, path, metrics)
        if "run=slow" in path and not done:
            done.append(True)
            land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
            jobs.convert(spark, lake, "r2")
            jobs.load_typed(spark, lake, "areas", "fast")
        return rows

    monkeypatch.setattr(jobs, "write_observed", slow)
    assert jobs.load_typed(spark, lake, "areas", "slow") == 3
    assert jobs.read_typed(spark, lake, "areas").count() == 3
    published = jobs._published(spark, lake, "areas", jobs.TYPED).orderBy("commit").select("run", "source")
    assert [tuple(r) for r in published.collect()] == [("fast", "r2-0"), ("slow", "r2-0")]


def test_the_driver_opens_a_file_per_header(spark, lake, monkeypatch):
    """However many files there are; the others are looked at by the scan that reads their beginnings."""
    from grovemart.sources import delimited

    opened, one = [], jobs.first_line
    monkeypatch.setattr(jobs, "first_line", lambda spark, path, encoding: opened.append(path) or one(spark, path, encoding))
    for k in range(40):
        land(raw_frame(spark, ROWS1), lake.landing, DAY1, f"d{k}")
    files = jobs.list_files(spark, lake.landing)
    groups, rejected = jobs._by_header(spark, jobs._arrived(files, files))
    assert len(opened) == 1 and rejected == [] and [len(g) for g in groups.values()] == [40]
    lines = delimited.first_lines(spark, [r["path"] for r in files.select("path").collect()])
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "file_block_start" in plan and "SortAggregate" not in plan and "Sort [" not in plan


def test_first_lines_of_files_of_several_blocks(spark, tmp_path, monkeypatch):
    """The first line is found whatever the splits, line ends and names."""
    from pyspark.sql import functions as F

    from grovemart.sources.delimited import first_lines

    texts = {"a +%[1] é.csv": "h;1\nx\n" * 5000, "b.csv": "h;2\r\n" + "h;1\r\n" * 5000, "c.csv": "only", "d.csv": "\nh;1\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = {r["path"].rpartition("/")[2]: r["line"] for r in first_lines(spark, [f"file:{tmp_path}/{n}" for n in texts]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = {"a +%[1] é.csv": "h;1", "b.csv": "h;2", "c.csv": "only", "d.csv": ""}
    checksum = spark.createDataFrame(list(expected.items()), "n string, v string").select("n", F.xxhash64("v"))
    assert found == {r[0]: r[1] for r in checksum.collect()}
