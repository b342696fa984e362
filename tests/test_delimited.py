import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from grovemart.operators.cleaning import clean, fill_missing_area, rename_columns, typed
from grovemart.operators.quality import ragged_rows
from grovemart.schema import CLEAN_COLUMNS, CORRUPT_RECORD, RAW_HEADERS, RAW_SCHEMA
from grovemart.sources.delimited import (
    HeaderMismatch,
    read_raw,
    read_stage,
    write_raw,
    write_stage,
)
from tests.helpers import raw_frame, rows_of

LINE = "01/02/2013;2013;Norte;Pará;PA;m;n;g;15;Belém;Belém - PA;Açaí;12.7"


def _file(tmp_path, lines, headers=RAW_HEADERS, encoding="iso-8859-1", name="x.csv"):
    path = tmp_path / name
    path.write_bytes("\n".join([";".join(headers), *lines, ""]).encode(encoding))
    return str(path)


def test_latin1_file(spark, tmp_path):
    raw = read_raw(spark, _file(tmp_path, [LINE]))
    assert raw.columns == RAW_HEADERS
    assert raw.first()["Município"] == "Belém" and raw.first()["Espécie florestal"] == "Açaí"


def test_a_file_in_another_charset_fails(spark, tmp_path):
    with pytest.raises(HeaderMismatch, match="Região"):
        read_raw(spark, _file(tmp_path, [LINE], encoding="utf-8"))


def test_a_missing_column_fails(spark, tmp_path):
    with pytest.raises(HeaderMismatch, match="Ano_PEVS"):
        read_raw(spark, _file(tmp_path, [LINE], headers=[h.replace("Ano_PEVS", "Ano2") for h in RAW_HEADERS]))


def test_columns_are_found_by_name(spark, tmp_path):
    order = list(reversed(range(13)))
    fields = LINE.split(";")
    turned = _file(tmp_path, [";".join(fields[i] for i in order)], [RAW_HEADERS[i] for i in order], name="t.csv")
    assert rows_of(read_raw(spark, turned)) == rows_of(read_raw(spark, _file(tmp_path, [LINE])))


def test_extra_columns_are_refused_by_name(spark, tmp_path):
    path = _file(tmp_path, [LINE + ";more"], [*RAW_HEADERS, "Extra"])
    with pytest.raises(HeaderMismatch, match="Extra"):
        read_raw(spark, path)


def test_a_name_is_no_pattern(spark, tmp_path):
    path = _file(tmp_path, [LINE], name="a[1]{b},c*.csv")
    assert read_raw(spark, path).count() == 1


def test_files_with_different_headers_are_not_mixed(spark, tmp_path):
    folder = tmp_path / "d.csv"
    folder.mkdir()
    _file(folder, [LINE], name="a.csv")
    _file(folder, [LINE], [RAW_HEADERS[1], RAW_HEADERS[0], *RAW_HEADERS[2:]], name="b.csv")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_raw(spark, str(folder)).collect()


def test_ragged_rows_are_padded_cut_and_reported(spark, tmp_path):
    path = _file(tmp_path, [LINE, "03/02/2013;2013;Sul", LINE + ";more"])
    raw = read_raw(spark, path)
    assert raw.count() == 3
    short = raw.where("Ano = '03/02/2013'").first()
    assert short["Região"] == "Sul" and short["Município"] is None
    reported = ragged_rows(read_raw(spark, path, keep_corrupt=True)).collect()
    assert sorted(row[CORRUPT_RECORD] for row in reported) == sorted(["03/02/2013;2013;Sul", LINE + ";more"])


def test_quoting_rules_are_those_of_the_plain_reader(spark, tmp_path):
    rows = [
        LINE.replace("Belém - PA", '"Bel;ém"').replace("Açaí", '""'),
        LINE.replace("Belém - PA", '"a ""b"" c"'),
        LINE.replace("Belém - PA", '"a \\"b\\" c"'),
        LINE.replace("Belém - PA", 'a "b" c'),
        LINE.replace("Belém - PA", "  spaced  "),
    ]
    path = _file(tmp_path, rows)
    plain = spark.read.csv(path, sep=";", header=True, encoding="iso-8859-1")
    raw = read_raw(spark, path)
    assert rows_of(raw) == rows_of(plain)
    quoted = raw.where("`Espécie florestal` is null").first()
    assert quoted["Município Geográfico"] == "Bel;ém"


def test_raw_files_are_split(spark, tmp_path):
    path = _file(tmp_path, [LINE] * 20_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        raw = read_raw(spark, path)
        assert raw.rdd.getNumPartitions() > 1
        assert raw.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


ROWS = [("01/02/2013", "3", "Pinus", "10"), ("03/02/2013", "1", None, None), (None, "2", "Açaí", "-")]


def test_raw_roundtrip(spark, tmp_path):
    df = raw_frame(spark, ROWS)
    write_raw(df, str(tmp_path / "raw"))
    assert rows_of(read_raw(spark, str(tmp_path / "raw"))) == rows_of(df)


def test_stage_roundtrip(spark, tmp_path):
    df = clean(raw_frame(spark, ROWS))
    write_stage(df, str(tmp_path / "stage"))
    assert rows_of(read_stage(spark, str(tmp_path / "stage"))) == rows_of(df)
    text = "".join(p.read_text() for p in (tmp_path / "stage").glob("*.csv"))
    assert text.startswith(",".join(CLEAN_COLUMNS)) and '""Sul""' in text


# Any Latin-1 text on one line. Empty text reads back as missing, as in any CSV.
VALUES = st.none() | st.text(
    st.characters(min_codepoint=1, max_codepoint=255, exclude_characters="\n\r"), min_size=1, max_size=8
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(*[VALUES] * 13), min_size=30, max_size=60))
def test_any_text_survives_both_formats(spark, rows):
    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    folder = tempfile.mkdtemp(prefix="run-")
    write_raw(raw, f"{folder}/raw")
    assert rows_of(read_raw(spark, f"{folder}/raw")) == rows_of(raw)
    write_stage(rename_columns(raw), f"{folder}/stage")
    assert rows_of(read_stage(spark, f"{folder}/stage")) == rows_of(raw)


def test_rename_ignores_absent_columns(spark):
    assert rename_columns(spark.createDataFrame([("x",)], "Ano string")).columns == ["data_base"]


def test_missing_area_is_zero_and_junk_is_null(spark):
    areas = [row["area_ha"] for row in typed(clean(raw_frame(spark, ROWS))).orderBy("municipio").collect()]
    assert areas == [0, None, 10]


def test_numeric_fill_skips_text(spark):
    renamed = rename_columns(raw_frame(spark, ROWS))
    assert rows_of(renamed.na.fill(0, ["area_ha"])) == rows_of(renamed)
    assert fill_missing_area(renamed).where("area_ha is null").count() == 0


def test_types(spark):
    types = dict(typed(clean(raw_frame(spark, ROWS))).dtypes)
    assert types.pop("data_base") == "date" and types.pop("area_ha") == "int"
    assert set(types.values()) == {"string"}
