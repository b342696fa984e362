from datetime import date
from pathlib import Path

import pytest

from grovemart.functions.paths import delivery_path
from grovemart.sources.delimited import write_stage
from grovemart.sources.commits import Log
from grovemart.sources.landing import (
    MANIFEST_SCHEMA,
    land,
    land_file,
    list_files,
    open_folders,
    pending_files,
    stray_files,
)
from grovemart.sources.tables import replace_table
from tests.helpers import raw_frame

DAY1, DAY2 = date(2020, 1, 5), date(2020, 11, 30)
ROWS1 = [("01/02/2013", "3", "Pinus", "10"), ("03/02/2013", "1", None, None)]
ROWS2 = [("01/02/2014", "3", "Pinus", "11"), ("03/02/2014", "2", "Açaí", "-"), ("04/02/2014", "2", "Açaí", "5")]


@pytest.fixture
def root(tmp_path):
    (tmp_path / "landing").mkdir()
    return str(tmp_path / "landing")


def read_manifest(spark, path):
    return Log(spark, path, {"manifest": MANIFEST_SCHEMA}, {}).rows("manifest")


def mark_done(files, path):
    log = Log(files.sparkSession, path, {"manifest": MANIFEST_SCHEMA}, {})
    assert log.commit(log.stage({"manifest": files}), log.version())


def _pending(spark, root, manifest):
    return pending_files(list_files(spark, root), read_manifest(spark, manifest))


def _days(df):
    return sorted({(row["dataset"], row["snapshot_date"]) for row in df.collect()})


def test_delivery_path():
    assert delivery_path("r", DAY1, "areas") == "r/year=2020/month=01/day=05/downloaded/areas.csv"


def test_empty_landing_area(spark, root, tmp_path):
    assert _pending(spark, root, str(tmp_path / "manifest")).count() == 0


def test_pending_until_marked_and_again_after_redelivery(spark, root, tmp_path):
    manifest = str(tmp_path / "manifest")
    land(raw_frame(spark, ROWS1), root, DAY1, "areas")
    land(raw_frame(spark, ROWS2), root, DAY2, "areas")
    pending = _pending(spark, root, manifest)
    assert _days(pending) == [("areas", DAY1), ("areas", DAY2)]
    mark_done(pending, manifest)
    assert _pending(spark, root, manifest).count() == 0
    land(raw_frame(spark, ROWS1), root, DAY1, "areas")
    assert _days(_pending(spark, root, manifest)) == [("areas", DAY1)]


def test_listing_only_a_part_of_the_landing_area(spark, root, tmp_path):
    manifest = str(tmp_path / "manifest")
    land(raw_frame(spark, ROWS1), root, date(2019, 12, 31), "areas")
    land(raw_frame(spark, ROWS2), root, DAY1, "areas")
    recent = _pending(spark, f"{root}/year=2020", manifest)
    assert _days(recent) == [("areas", DAY1)]
    mark_done(recent, manifest)
    assert _days(_pending(spark, root, manifest)) == [("areas", date(2019, 12, 31))]


def test_same_path_with_new_time_or_size_is_pending(spark, root, tmp_path):
    manifest = str(tmp_path / "manifest")
    file = tmp_path / "landing/year=2020/month=01/day=05/downloaded/areas.csv"
    file.parent.mkdir(parents=True)
    file.write_text("a;b\n")
    mark_done(_pending(spark, root, manifest), manifest)
    assert _pending(spark, root, manifest).count() == 0
    file.write_text("a;b\n1;2\n")
    assert _pending(spark, root, manifest).count() == 1


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("year=2020/month=01/day=05/downloaded/areas.csv", ("areas", DAY1)),
        ("year=2020/month=1/day=5/downloaded/areas.csv", ("areas", DAY1)),
        ("year=2020/month=01/day=05/downloaded/my_downloaded_areas.csv", ("my_downloaded_areas", DAY1)),
        ("year=2020/month=01/day=05/downloaded/a.b.csv", ("a.b", DAY1)),
        ("year=2020/month=01/day=05/processed/downloaded.csv", None),
        ("year=2020/month=01/day=05/areas.csv", None),
        ("year=2020/month=13/day=05/downloaded/areas.csv", None),
        ("downloaded/areas.csv", None),
        ("year=2020/month=01/day=05/downloaded/areas.txt", None),
    ],
)
def test_path_contract(spark, root, tmp_path, path, expected):
    file = tmp_path / "landing" / path
    file.parent.mkdir(parents=True)
    file.write_text("x\n")
    found = _days(_pending(spark, root, str(tmp_path / "manifest")))
    assert found == ([expected] if expected else [])


def test_landed_bytes_are_the_delivered_ones(spark, root, tmp_path):
    """A file is landed as it is, whatever is in it; the same day again replaces it."""
    source = tmp_path / "new.csv"
    for data in (b"\xe1;\"x\r\n\x00;surplus;;;\n", b"other"):
        source.write_bytes(data)
        path = land_file(spark, str(source), root, DAY1, "areas[1] x")
        assert Path(path).read_bytes() == data
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_bytes(b"1")
    (folder / "b.csv").write_bytes(b"2")
    path = Path(land_file(spark, str(folder), root, DAY2, "areas"))
    assert sorted((f.name, f.read_bytes()) for f in path.iterdir() if not f.name.startswith(".")) == [("a.csv", b"1"), ("b.csv", b"2")]


def test_stray_files(spark, root, tmp_path):
    manifest = str(tmp_path / "manifest")
    names = {
        "year=2020/month=01/day=05/downloaded/areas.CSV": True,
        "year=2020/month=01/day=05/downloaded/areas.csv.gz": True,
        "year=2020/month=13/day=05/downloaded/areas.csv": True,
        "loose.csv": True,
        "year=2020/month=01/day=05/downloaded/areas.csv": False,
        "year=2020/month=01/day=05/processed/areas.csv": False,
    }
    for name in names:
        file = tmp_path / "landing" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x")
    found = {row["path"].split("/landing/")[1] for row in stray_files(list_files(spark, root), read_manifest(spark, manifest)).collect()}
    assert found == {name for name, stray in names.items() if stray}


def test_row_counts_of_empty_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "a int")
    grouped = spark.range(5).where("false").groupBy("id").count()
    for df in (empty, spark.range(5).limit(0), spark.range(5).where("id > 9"), grouped, grouped.join(spark.range(3), "id")):
        assert replace_table(df, path) == 0
        assert write_stage(df, path) == 0
    assert replace_table(spark.range(5), path) == write_stage(spark.range(5), path) == 5


def test_processed_files_are_never_listed(spark, root, tmp_path, monkeypatch):
    """The work is the same whatever was delivered before: only open folders are listed."""
    from grovemart.sources import landing as module

    looked, real = [], module.entries
    monkeypatch.setattr(module, "entries", lambda spark, path: looked.append(path) or real(spark, path))
    land(raw_frame(spark, ROWS1), root, DAY1, "areas")
    assert len(open_folders(spark, root)[0]) == 1
    before = len(looked)
    for k in range(30):
        file = tmp_path / f"landing/year=2020/month=01/day=05/processed/d{k}.csv/part.csv"
        file.parent.mkdir(parents=True)
        file.write_text("x")
    looked.clear()
    files = list_files(spark, root)
    assert len(looked) == before and not [path for path in looked if "/processed" in path]
    assert {r["dataset"] for r in files.collect()} == {"areas"}
    assert not [f for f in files.inputFiles() if "/processed/" in f]


def test_days_before_a_mark_are_not_looked_at(spark, root):
    days = [date(2019, 12, 31), date(2020, 1, 5), date(2020, 1, 20), date(2021, 3, 1)]
    for day in days:
        land(raw_frame(spark, ROWS1), root, day, "areas")
    for since in [*days, date(2020, 1, 6), date(1999, 1, 1), date(2030, 1, 1)]:
        for base in (root, f"{root}/year=2020", f"{root}/year=2020/month=01"):
            found = {r["snapshot_date"] for r in list_files(spark, base, since).collect()}
            inside = {d for d in days if base == root or (d.year == 2020 and (base.endswith("2020") or d.month == 1))}
            assert found == {d for d in inside if d >= since}


def test_listing_a_state_folder_itself(spark, root):
    land(raw_frame(spark, ROWS1), root, DAY1, "areas")
    base = f"{root}/year=2020/month=01/day=05"
    assert _days(list_files(spark, base)) == _days(list_files(spark, f"{base}/downloaded/")) == [("areas", DAY1)]
