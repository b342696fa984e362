"""Copies by tasks: the same bytes, whatever is in them."""

import json
from datetime import date
from pathlib import Path

import pytest

from grovemart.plans import jobs
from grovemart.schema import RAW_HEADERS
from grovemart.sources import copying, files
from grovemart.sources.landing import land_file
from tests.helpers import raw_row, rows_of

DAY = date(2020, 1, 5)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _lines(n, end="\r\n"):
    header = ";".join(RAW_HEADERS)
    rows = [";".join("" if v is None else v for v in raw_row("01/02/2013", str(1 + i % 3), "Açaí", str(i))) for i in range(n)]
    return end.join([header, *rows]).encode("iso-8859-1")


def _visible(folder):
    return sorted(p for p in Path(folder).iterdir() if not p.name.startswith((".", "_")))


def _joined(folder):
    """The file that was delivered, from its parts."""
    told = json.loads((Path(folder) / copying.PARTS).read_text())
    parts = [(Path(folder) / name).read_bytes() for name, _ in told["parts"]]
    assert [len(p) for p in parts] == [size for _, size in told["parts"]]
    title = parts[0].split(b"\n")[0] + b"\n"
    for part in parts:
        assert part.startswith(title)
    whole = parts[0] + b"".join(p[len(title) :] for p in parts[1:])
    assert told["titles_added"] == len(parts) - 1
    return whole[:-1] if told["line_break_added"] else whole


@pytest.mark.parametrize("data", [b"x", b"\n", b"a;b\r\n1;\x00\xe1\xff\n", b"no end", b"\xff\xfe\x00", bytes(range(256)) * 20, b"\n\n\nz"])
def test_small_files(spark, tmp_path, data):
    (tmp_path / "in.csv").write_bytes(data)
    copying.copy(spark, str(tmp_path / "in.csv"), str(tmp_path / "out/areas.csv"))
    assert (tmp_path / "out/areas.csv").read_bytes() == data
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")] == ["areas.csv"]


@pytest.mark.parametrize("ended", [True, False])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_large_files_become_parts(spark, tmp_path, small_splits, ended, end):
    data = _lines(400, end) + (end.encode() if ended else b"")
    (tmp_path / "in.csv").write_bytes(data)
    target = tmp_path / "out/areas.csv"
    copying.copy(spark, str(tmp_path / "in.csv"), str(target), part_bytes=1000)
    assert len(_visible(target)) == -(-len(data) // 4000) and _joined(target) == data


def test_parts_are_a_delivery_like_the_file(spark, tmp_path, small_splits):
    (tmp_path / "in.csv").write_bytes(_lines(300))
    lakes = []
    for name, size in (("whole", 1 << 20), ("parts", 1000)):
        landing = tmp_path / name / "landing"
        copying.copy(spark, str(tmp_path / "in.csv"), f"{landing}/year=2020/month=01/day=05/downloaded/areas.csv", size)
        lakes.append(jobs.Lake(str(landing), str(tmp_path / name / "tables")))
    assert [jobs.convert(spark, lake, "r") for lake in lakes] == [{"areas": 300}] * 2
    one, two = (rows_of(jobs.history(spark, lake, "areas")) for lake in lakes)
    assert one == two


def test_folders(spark, tmp_path, small_splits):
    source = tmp_path / "parts"
    source.mkdir()
    for name, rows in (("a.csv", 3), ("b.csv", 300), ("c [1].csv", 5)):
        (source / name).write_bytes(_lines(rows))
    (source / "empty.csv").write_bytes(b"")
    copying.copy(spark, str(source), str(tmp_path / "out"), part_bytes=5000)
    out = {p.name: p.read_bytes() for p in _visible(tmp_path / "out")}
    assert out["a.csv"] == _lines(3) and out["c [1].csv"] == _lines(5)
    large = sorted(name for name in out if name.startswith("b.csv-part-"))
    assert len(out) == 2 + len(large) and len(large) > 5
    title = out[large[0]].split(b"\n")[0] + b"\n"
    assert out[large[0]] + b"".join(out[n][len(title) :] for n in large[1:]) == _lines(300) + b"\n"
    (source / "inner").mkdir()
    with pytest.raises(copying.IncompleteCopy):
        copying.copy(spark, str(source), str(tmp_path / "out"))
    assert {p.name: p.read_bytes() for p in _visible(tmp_path / "out")} == out


def test_no_stream_goes_through_the_driver(spark, tmp_path, monkeypatch):
    """One byte is looked at there, the last."""
    read = []
    monkeypatch.setattr(copying, "last_byte", lambda *args: read.append(files.last_byte(*args)) or read[-1])
    monkeypatch.setattr(files, "first_line", None)
    (tmp_path / "in.csv").write_bytes(_lines(50))
    copying.copy(spark, str(tmp_path / "in.csv"), str(tmp_path / "out.csv"))
    assert read == [_lines(50)[-1]] and not hasattr(files, "copy")


def test_a_broken_copy_leaves_the_old_file(spark, tmp_path, monkeypatch):
    (tmp_path / "in.csv").write_bytes(b"new")
    (tmp_path / "out.csv").write_bytes(b"old")
    monkeypatch.setattr(copying, "length", lambda *args: 7 if str(args[1]).endswith("in.csv") else files.length(*args))
    with pytest.raises(copying.IncompleteCopy):
        copying.copy(spark, str(tmp_path / "in.csv"), str(tmp_path / "out.csv"))
    assert (tmp_path / "out.csv").read_bytes() == b"old"
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["in.csv", "out.csv"]


def test_moving_is_a_rename(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(copying, "copy", None)
    source = tmp_path / "new"
    source.mkdir()
    (source / "a.csv").write_bytes(b"1")
    for data in (b"1", b"2"):
        source.mkdir(exist_ok=True)
        (source / "a.csv").write_bytes(data)
        path = land_file(spark, str(source), str(tmp_path / "landing"), DAY, "areas", move=True)
        assert not source.exists() and [p.read_bytes() for p in _visible(path)] == [data]


def test_moving_to_another_system_is_a_copy_and_a_removal(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(copying, "same_system", lambda *args: False)
    (tmp_path / "in.csv").write_bytes(b"data")
    path = land_file(spark, str(tmp_path / "in.csv"), str(tmp_path / "landing"), DAY, "areas", move=True)
    assert Path(path).read_bytes() == b"data" and not (tmp_path / "in.csv").exists()
