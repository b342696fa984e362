import os
from datetime import date
from pathlib import Path

import pytest

from grovemart.__main__ import main
from grovemart.functions.paths import delivery_path
from grovemart.operators import cards
from grovemart.plans import jobs
from grovemart.schema import DIM_CALENDAR, FACT_AREA, RAW_HEADERS
from grovemart.sources.delimited import RAW_OPTIONS, read_stage, write_raw
from grovemart.sources.landing import land
from grovemart.streaming.ingest import ingest_available
from tests.helpers import raw_frame, raw_row, rows_of

DAY1, DAY2 = date(2020, 1, 5), date(2020, 2, 5)
ROWS1 = [("01/02/2013", "3", "Pinus", "10"), ("03/02/2013", "1", None, None)]
ROWS2 = [("01/02/2014", "3", "Pinus", "12.7"), ("03/02/2014", "2", "Açaí", "-"), ("04/02/2014", "2", "Açaí", "5")]


@pytest.fixture
def lake(tmp_path):
    (tmp_path / "landing").mkdir()
    return jobs.Lake(str(tmp_path / "landing"), str(tmp_path / "tables"))


def _state(spark, lake, dataset="areas"):
    return {
        "history": rows_of(jobs.history(spark, lake, dataset)),
        "stage": rows_of(read_stage(spark, lake.stage(dataset))),
        "current": rows_of(jobs.current(spark, lake, dataset)),
        "typed": rows_of(jobs.read_typed(spark, lake, dataset)),
        **{name: rows_of(df) for name, df in jobs.read_star(spark, lake, dataset).items()},
    }


def test_nothing_pending(spark, lake):
    assert jobs.run_all(spark, lake) == {}


def test_two_pending_deliveries_the_latest_wins(spark, lake):
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    report = jobs.run_all(spark, lake)
    assert report["areas"] == {
        "clean": 3,
        "typed": 3,
        "dim_localizacao": 2,
        "dim_tempo": 4,
        "dim_especie": 2,
        "fat_area": 3,
    }
    state = _state(spark, lake)
    assert len(state["history"]) == 5
    assert state["stage"] == state["current"]
    assert sorted(row[-1] or -1 for row in state["typed"]) == [-1, 5, 12]
    assert len(state["typed"]) == len(state["fat_area"]) == 3


def test_a_plain_downloaded_file(spark, lake, tmp_path):
    day = tmp_path / "landing/year=2020/month=01/day=05/downloaded"
    day.mkdir(parents=True)
    lines = [";".join(RAW_HEADERS)] + [";".join("" if v is None else v for v in raw_row(*row)) for row in ROWS2[1:]]
    (day / "areas.csv").write_bytes("\r\n".join(lines).encode("iso-8859-1"))
    assert jobs.run_all(spark, lake)["areas"]["fat_area"] == 2
    found = rows_of(jobs.read_star(spark, lake, "areas")[FACT_AREA])
    assert found == [(date(2014, 2, 3), "2", "Açaí", None), (date(2014, 2, 4), "2", "Açaí", 5)]


def test_running_again_changes_nothing(spark, lake):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    jobs.run_all(spark, lake)
    before = _state(spark, lake)
    assert jobs.run_all(spark, lake) == {}
    assert _state(spark, lake) == before


def test_a_day_delivered_again_is_replaced(spark, lake):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    land(raw_frame(spark, ROWS1), lake.landing, DAY2, "areas")
    jobs.run_all(spark, lake)
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
    assert jobs.run_all(spark, lake)["areas"]["clean"] == 3
    days = {row["snapshot_date"]: row["count"] for row in jobs.history(spark, lake, "areas").groupBy("snapshot_date").count().collect()}
    assert days == {DAY1: 2, DAY2: 3}


def test_deliveries_with_their_own_column_order(spark, lake):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    turned = raw_frame(spark, ROWS1).select(*[f"`{name}`" for name in reversed(RAW_HEADERS)])
    turned.write.options(**RAW_OPTIONS).csv(delivery_path(lake.landing, DAY2, "areas"))
    jobs.convert(spark, lake, "r1")
    history = jobs.history(spark, lake, "areas")
    one, two = (rows_of(history.where(history.snapshot_date == d).drop("snapshot_date")) for d in (DAY1, DAY2))
    assert one == two


def _put(lake, name, lines, day="year=2020/month=01/day=05", at=None):
    path = Path(lake.landing) / day / "downloaded" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("\n".join(lines).encode("iso-8859-1"))
    if at is not None:
        os.utime(path, (at, at))
    return path


def _lines(rows, header=RAW_HEADERS):
    return [";".join(header)] + [";".join("" if v is None else v for v in raw_row(*row)) for row in rows]


@pytest.mark.parametrize("in_one_run", [True, False])
def test_two_deliveries_of_one_day_the_newest_is_kept(spark, lake, in_one_run):
    _put(lake, "areas.csv", _lines(ROWS2), at=2_000_000_000)
    if not in_one_run:
        assert jobs.convert(spark, lake, "r0") == {"areas": 3}
    _put(lake, "areas.csv", _lines(ROWS1), day="year=2020/month=1/day=5", at=1_900_000_000)
    assert jobs.convert(spark, lake, "r1") == ({"areas": 3} if in_one_run else {})
    assert jobs.current(spark, lake, "areas").count() == 3
    (rejected,) = jobs.rejections(spark, lake).collect()
    assert rejected["reason"] == jobs.OLDER and "month=1/day=5" in rejected["delivery"]
    assert jobs.convert(spark, lake, "r2") == {}


def test_a_bad_redelivery_leaves_everything_as_it_was(spark, lake):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    jobs.run_all(spark, lake)
    before = _state(spark, lake)
    land(raw_frame(spark, ROWS2), lake.landing, DAY1, "areas")
    turned = raw_frame(spark, ROWS2).select(*[f"`{name}`" for name in reversed(RAW_HEADERS)])
    turned.write.mode("append").options(**RAW_OPTIONS).csv(delivery_path(lake.landing, DAY1, "areas"))
    with pytest.raises(jobs.DeliveryRejected, match="different headers"):
        jobs.run_all(spark, lake)
    assert jobs.load_typed(spark, lake, "areas") == 2
    assert _state(spark, lake) == before
    assert jobs.run_all(spark, lake) == {}
    land(raw_frame(spark, ROWS2), lake.landing, DAY1, "areas")
    assert jobs.run_all(spark, lake)["areas"]["clean"] == 3


def test_bad_files_do_not_block_the_good_ones(spark, lake):
    _put(lake, "bad.csv", ["a;b", "1;2"])
    _put(lake, "more.csv", _lines(ROWS1, [*RAW_HEADERS, "Extra"]))
    _put(lake, "areas.CSV", _lines(ROWS1))
    _put(lake, "areas[1] {x}, a+b.csv", _lines(ROWS1))
    land(raw_frame(spark, ROWS2), lake.landing, DAY1, "areas")
    with pytest.raises(jobs.DeliveryRejected) as told:
        jobs.run_all(spark, lake)
    for name in ("bad.csv", "more.csv", "areas.CSV", "Extra"):
        assert name in str(told.value)
    assert jobs.rejections(spark, lake).count() == 3
    assert jobs.current(spark, lake, "areas").count() == 3
    assert jobs.read_star(spark, lake, "areas[1] {x}, a+b")[FACT_AREA].count() == 2
    assert jobs.read_typed(spark, lake, "areas[1] {x}, a+b").count() == 2
    assert jobs.run_all(spark, lake) == {}
    assert jobs.rejections(spark, lake).count() == 3


def test_ragged_rows_are_counted_and_shown(spark, lake):
    lines = _lines(ROWS2)
    _put(lake, "areas.csv", [lines[0], lines[1].rsplit(";", 2)[0], lines[2] + ";surplus", lines[3]])
    jobs.run_all(spark, lake)
    found = jobs.checks(spark, lake, "areas")
    assert [(r["rows"], r["ragged"]) for r in found["deliveries"].collect()] == [(3, 2)]
    shown = [r[0] for r in found["ragged_rows"].collect()]
    assert len(shown) == 2 and any("surplus" in line for line in shown)


def test_many_small_deliveries_start_few_jobs(spark, lake):
    """Deliveries of one header are read by one job, however many they are."""

    def started(count, first):
        for i in range(count):
            _put(lake, f"d{first + i}.csv", _lines(ROWS1))
        group = f"jobs-{count}-{first}"
        spark.sparkContext.setJobGroup(group, "")
        kept, rejected = jobs._attempt(spark, lake, group)
        assert len({row[4] for row in kept}) == 1 and len(kept) == count and rejected == []
        assert sum(row[2] for row in kept) == 2 * count
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = started(2, 0), started(40, 100)
    # Reading a short list back takes a job per partition of it, few as they are.
    assert many < few + 8


def test_done_deliveries_move(spark, lake):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    _put(lake, "bad.csv", ["a;b"])
    with pytest.raises(jobs.DeliveryRejected):
        jobs.convert(spark, lake, "r1")
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
    assert jobs.move_done(spark, lake) == 1
    there = {str(p.relative_to(lake.landing)) for p in Path(lake.landing).rglob("*.csv") if not p.name.startswith("part")}
    day = "year=2020/month=01/day=05"
    assert there == {f"{day}/processed/areas.csv", f"{day}/downloaded/bad.csv", "year=2020/month=02/day=05/downloaded/areas.csv"}
    assert jobs.convert(spark, lake, "r2") == {"areas": 3}
    assert jobs.move_done(spark, lake) == 1 and jobs.convert(spark, lake, "r3") == {}


def test_old_runs_go_and_the_published_one_stays(spark, lake):
    for i in range(4):
        land(raw_frame(spark, ROWS2[: i % 3 + 1]), lake.landing, DAY1, "areas")
        jobs.run_all(spark, lake, f"r{i}", keep_runs=2)
    for what in (jobs.TYPED, jobs.STAR):
        assert sorted(p.name for p in Path(lake.runs(what, "areas")).iterdir()) == ["run=r2", "run=r3"]
    assert jobs.read_star(spark, lake, "areas")[FACT_AREA].count() == jobs.read_typed(spark, lake, "areas").count() == 1


def test_the_stream_keeps_what_the_batch_keeps(spark, lake, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    _put(lake, "plain.csv", _lines(ROWS1))
    assert ingest_available(spark, lake, checkpoint, "s1") == []
    assert ingest_available(spark, lake, checkpoint, "s2") == []
    assert jobs.history(spark, lake, "areas").count() == jobs.history(spark, lake, "plain").count() == 2
    land(raw_frame(spark, ROWS2), lake.landing, DAY1, "areas")
    _put(lake, "plain.csv", _lines(ROWS2))
    _put(lake, "bad.csv", ["a;b"])
    assert [r[0] for r in ingest_available(spark, lake, checkpoint, "s3")] == ["bad"]
    batch = jobs.Lake(lake.landing, str(tmp_path / "batch"))
    with pytest.raises(jobs.DeliveryRejected):
        jobs.convert(spark, batch, "b")
    for name in ("areas", "plain"):
        assert rows_of(jobs.history(spark, lake, name)) == rows_of(jobs.history(spark, batch, name))
    assert jobs.run_all(spark, lake)["areas"]["fat_area"] == 3


def test_nothing_there_is_told(spark, lake):
    for job in (jobs.load_typed, jobs.current, jobs.checks, jobs.read_typed):
        with pytest.raises(LookupError):
            job(spark, lake, "areas")


def test_datasets_are_kept_apart(spark, lake):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    land(raw_frame(spark, ROWS2), lake.landing, DAY1, "more_downloaded")
    report = jobs.run_all(spark, lake)
    assert {name: counts["fat_area"] for name, counts in report.items()} == {"areas": 2, "more_downloaded": 3}


def test_a_broken_run_is_started_again(spark, lake, monkeypatch):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    jobs.run_all(spark, lake)
    before = _state(spark, lake)
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
    whole = jobs.write_observed

    def fails_at_fact(df, path, metrics):
        if path.endswith(FACT_AREA):
            raise RuntimeError("lost")
        return whole(df, path, metrics)

    monkeypatch.setattr(jobs, "write_observed", fails_at_fact)
    with pytest.raises(RuntimeError):
        jobs.run_all(spark, lake)
    published = {name: rows_of(df) for name, df in jobs.read_star(spark, lake, "areas").items()}
    assert published == {name: before[name] for name in published}
    monkeypatch.undo()
    assert jobs.run_all(spark, lake)["areas"]["fat_area"] == 3
    assert jobs.run_all(spark, lake) == {}


def test_files_landing_during_a_run_are_pending_in_the_next(spark, lake, monkeypatch):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    keep = jobs._keep

    def late(*args):
        land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
        return keep(*args)

    monkeypatch.setattr(jobs, "_keep", late)
    jobs.run_all(spark, lake)
    monkeypatch.undo()
    assert jobs.run_all(spark, lake)["areas"]["clean"] == 3


def test_an_unknown_dataset_has_no_star(spark, lake):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    jobs.run_all(spark, lake)
    with pytest.raises(LookupError):
        jobs.read_star(spark, lake, "other")
    with pytest.raises(LookupError):
        jobs.load_typed(spark, lake, "other")


def test_the_log_of_deliveries(spark, lake):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas")
    jobs.convert(spark, lake, "r1")
    land(raw_frame(spark, []), lake.landing, DAY1, "areas")
    jobs.convert(spark, lake, "r2")
    log = jobs.snapshots(spark, lake, "areas").select("dataset", "snapshot_date", "rows", "run")
    assert rows_of(log) == [("areas", DAY1, 0, "r2-0"), ("areas", DAY1, 2, "r1-0"), ("areas", DAY2, 3, "r1-0")]
    history = jobs.history(spark, lake, "areas")
    assert history.where(history.snapshot_date == DAY1).count() == 0
    assert history.where(history.snapshot_date == DAY2).count() == jobs.current(spark, lake, "areas").count() == 3


def test_every_card_adds_up_to_the_total(spark, lake):
    land(raw_frame(spark, ROWS2), lake.landing, DAY1, "areas")
    jobs.run_all(spark, lake)
    tables = jobs.read_star(spark, lake, "areas")
    fact, cities = tables[FACT_AREA], jobs.read_one_location(spark, lake, "areas")
    total = cards.area_total(fact).first()[0]
    for card in (
        cards.area_by_year(fact, tables[DIM_CALENDAR]),
        cards.area_by_state(fact, cities),
        cards.area_by_region(fact, cities),
        cards.top_cities(fact, cities),
    ):
        assert sum(row["area_ha"] for row in card.collect()) == total


def test_command_line(spark, lake, tmp_path, capsys):
    write_raw(raw_frame(spark, ROWS2), str(tmp_path / "source"))
    places = ["--landing", lake.landing, "--root", lake.root]
    source = ["--source", str(tmp_path / "source"), "--date", "2020-01-05"]
    main(["land", *places, *source, "--dataset", "areas.csv"])
    main(["convert", *places])
    main(["typed", *places, "--dataset", "areas.csv"])
    main(["star", *places, "--dataset", "areas.csv"])
    for job in ("preview", "checks", "cards"):
        main([job, *places, "--dataset", "areas.csv"])
    output = capsys.readouterr().out
    assert '{"areas": 3}' in output and '"fat_area": 3' in output
    assert "Marituba" in output and "null_profile" in output and "top cities" in output


def test_exports_go_to_tables_named_as_here(spark, lake, monkeypatch):
    land(raw_frame(spark, ROWS2), lake.landing, DAY1, "areas")
    jobs.run_all(spark, lake)
    sent = {}
    monkeypatch.setattr(jobs, "export_table", lambda df, database, name, partitions: sent.update({name: partitions}))
    jobs.export_registry(spark, lake, "areas", None, 12)
    jobs.export_star(spark, lake, "areas", None, 12)
    assert set(sent.values()) == {12}
    assert set(sent) == {"areas", "dim_localizacao", "dim_tempo", "dim_especie", "fat_area"}


def test_checks(spark, lake):
    land(raw_frame(spark, ROWS2), lake.landing, DAY1, "areas")
    jobs.run_all(spark, lake)
    found = jobs.checks(spark, lake, "areas")
    assert found["counts"].count() == 6
    assert rows_of(found["null_profile"]) == [(3, 3, 2, 3)]
    assert found["duplicate_keys"].count() == found["orphan_keys"].count() == 0


def test_checks_read_no_table_twice(spark, lake):
    """Counts and null profile come from the log; what the counts rule out is not looked for."""
    from grovemart.operators import quality

    lines = _lines([*ROWS2, ("01/02/2014", "3", None, "1"), ("x", "3", "A", "y")])
    _put(lake, "areas.csv", [*lines, lines[1] + ";surplus"])
    jobs.run_all(spark, lake)
    found = jobs.checks(spark, lake, "areas")
    tables, registry = jobs.read_star(spark, lake, "areas"), jobs.read_typed(spark, lake, "areas")
    stages = {"clean": jobs.current(spark, lake, "areas"), "typed": registry, **tables}
    assert rows_of(found["counts"]) == rows_of(quality.count_report(stages))
    assert rows_of(found["null_profile"]) == rows_of(quality.null_profile(registry))
    assert rows_of(found["orphan_keys"]) == rows_of(quality.orphan_keys(tables[FACT_AREA], tables["dim_localizacao"]))
    assert rows_of(found["duplicate_keys"]) == [] and found["ragged_rows"].count() == 4
    read = [f.split("/tables/")[1].split("/part-")[0] for df in found.values() for f in df.inputFiles() if "/log/" not in f]
    assert len(read) == len(set(read)) and not [f for f in read if f.startswith("typed")]


def test_duplicates_are_looked_for_where_there_are_some(spark, lake):
    lines = _lines(ROWS2[:1])
    other = lines[1].split(";")
    other[9] = "Renamed"
    _put(lake, "areas.csv", [*lines, ";".join(other)])
    jobs.run_all(spark, lake)
    assert rows_of(jobs.checks(spark, lake, "areas")["duplicate_keys"]) == [("3", 2)]


def test_columns_beyond_the_contract_are_kept_where_asked_for(spark, lake):
    """Deliveries with and without such columns lie in one history; the star is that of the contract's columns."""
    wide = jobs.Lake(lake.landing, lake.root, extra_columns=True)
    lines = _lines([r for r in ROWS2 if r[1] != "3"], ["Nota", *RAW_HEADERS, "Extra `x`"])
    _put(lake, "areas.csv", [lines[0], *(f"n{k};{line};{'' if k else 'e'}" for k, line in enumerate(lines[1:]))])
    land(raw_frame(spark, ROWS1), lake.landing, DAY2, "areas")
    with pytest.raises(jobs.DeliveryRejected, match="beyond the contract"):
        jobs.run_all(spark, lake)
    _put(lake, "areas.csv", [lines[0], *(f"n{k};{line};{'' if k else 'e'}" for k, line in enumerate(lines[1:]))], at=2_000_000_000)
    assert jobs.convert(spark, wide, "wide") == {"areas": 2}
    extra = {r["data_base"]: r["extra"] for r in jobs.history(spark, wide, "areas", extra=True).where("snapshot_date = '2020-01-05'").collect()}
    assert extra == {"03/02/2014": {"Nota": "n0", "Extra `x`": "e"}, "04/02/2014": {"Nota": "n1", "Extra `x`": None}}
    assert [r["extra"] for r in jobs.current(spark, wide, "areas", extra=True).collect()] == [None, None]
    assert "extra" not in jobs.history(spark, wide, "areas").columns
    _put(lake, "more.csv", _lines(ROWS1, [*RAW_HEADERS, "Twice", "twice"]))
    with pytest.raises(jobs.DeliveryRejected, match="come twice"):
        jobs.run_all(spark, wide)


def test_compressed_deliveries_and_stage(spark, lake):
    """Compressed parts are taken in as others are, the stage copy is compressed, and wrong headers are still found."""
    packed = jobs.Lake(lake.landing, lake.root, compression="gzip")
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas", "gzip")
    land(raw_frame(spark, ROWS2), lake.landing, DAY2, "areas", "gzip")
    jobs.run_all(spark, packed, "r1")
    state = _state(spark, packed)
    assert len(state["history"]) == 5 and state["stage"] == state["current"]
    written = [p for root in (lake.landing, f"{lake.root}/stage") for p in Path(root).rglob("part*")]
    assert written and all(p.name.endswith(".csv.gz") for p in written)
    wrong = raw_frame(spark, ROWS1).withColumnRenamed("Ano", "Other")
    wrong.write.options(**RAW_OPTIONS, compression="gzip").csv(delivery_path(lake.landing, date(2020, 3, 5), "areas"))
    with pytest.raises(jobs.DeliveryRejected, match="missing columns .'Ano'."):
        jobs.convert(spark, packed, "r2")
    assert _state(spark, packed) == state


@pytest.mark.parametrize("alone", [0, 32])
def test_rows_of_deliveries_are_told_apart(spark, lake, monkeypatch, alone):
    monkeypatch.setattr(jobs, "READ_ALONE", alone)
    for name, day, rows in (("a +%[1] é", DAY1, ROWS1), ("areas", DAY1, ROWS2), ("areas", DAY2, ROWS1[:1])):
        land(raw_frame(spark, rows), lake.landing, day, name)
    jobs.convert(spark, lake, "r1")
    kept = jobs.snapshots(spark, lake).select("dataset", "snapshot_date", "rows")
    assert rows_of(kept) == [("a +%[1] é", DAY1, 2), ("areas", DAY1, 3), ("areas", DAY2, 1)]
    assert len(rows_of(jobs.history(spark, lake, "a +%[1] é"))) == 2


def test_one_delivery_is_read_without_its_paths(spark, lake):
    land(raw_frame(spark, ROWS1), lake.landing, DAY1, "areas")
    path = delivery_path(lake.landing, DAY1, "areas")
    files = tuple(str(p) for p in Path(path).glob("part*"))
    rows = jobs._delivered_rows(spark, tuple(RAW_HEADERS), [jobs.Delivery("areas", DAY1, path, files, jobs.now())])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract" not in plan and "file_path" not in plan
