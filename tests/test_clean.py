import datetime as dt

from miasma.operators import clean
from miasma.sources import payload
from miasma.sources.files import read_cases_csv, read_observation_tree
from tests.records import HEADER, line, raw, record
from tests.records import payload as records_of


def test_trim_cast_types_and_bad_values(spark):
    rows = clean.trim_cast(raw(spark, record(TEMP="  32.3", DEWP=" ", SLP="abc"),
                               record(DATE="n/a"))).collect()
    assert rows[0].TEMP == 32.3 and rows[0].DEWP is None and rows[0].SLP is None
    assert rows[0].DATE == dt.datetime(2024, 12, 3) and rows[1].DATE is None
    assert rows[0].STATION == "01001099999" and rows[0].FRSHTT == "011000"


def test_clean_records_drops_headers_and_missing_keys(spark):
    df = raw(spark, record(), HEADER, record(DATE="?"), record(STATION=None))
    assert [r.STATION for r in clean.clean_records(df).collect()] == ["01001099999"]


def test_payload_round_trip_keeps_commas_and_padding(spark):
    df = raw(spark, record(), record(NAME='A "B", C', TEMP=" -1.0"))
    back = payload.decode_payload(payload.encode_payload(df))
    assert back.filter("damaged_line IS NOT NULL").isEmpty()
    assert sorted(map(tuple, back.drop("damaged_line").collect())) == sorted(map(tuple, df.collect()))


def test_payload_of_a_short_line_is_null_after_its_fields(spark):
    row = payload.decode_payload(records_of(spark, "bad")).first()
    assert row.STATION == "bad" and row.DATE is None and row.FRSHTT is None


def test_encoded_line_is_the_file_line(spark):
    value = payload.encode_payload(raw(spark, record())).first().value
    assert bytes(value).decode() == line(record())


def test_sentinels_and_reading_counts(spark):
    df = clean.trim_cast(raw(
        spark, record(DEWP="9999.9", DEWP_ATTRIBUTES=" 0", SLP=" 999.9", SLP_ATTRIBUTES=" 4",
                      STP="999.9", WDSP=" 5.0", WDSP_ATTRIBUTES=" 0", PRCP="99.99",
                      MAX="9999.9", GUST="999.9")))
    row = clean.sentinel_to_null(df).first()
    assert row.DEWP is None and row.STP is None and row.WDSP is None
    assert row.PRCP is None and row.MAX is None and row.GUST is None and row.SNDP is None
    assert row.SLP == 999.9 and row.MIN == 30.9 and row.TEMP == 32.3


def test_flags(spark):
    row = clean.decode_flags(raw(spark, record(FRSHTT="010011"))).first()
    assert [row.flag_fog, row.flag_rain, row.flag_snow] == [0, 1, 0]
    assert [row.flag_hail, row.flag_thunder, row.flag_tornado] == [0, 1, 1]


def test_dedupe_is_independent_of_order(spark):
    rows = [record(TEMP="2.0"), record(TEMP="1.0"), record(TEMP="1.0"), record(DATE="2024-12-04")]
    for order in (rows, rows[::-1]):
        kept = clean.dedupe_observations(clean.trim_cast(raw(spark, *order)))
        assert sorted((str(r.DATE.date()), r.TEMP) for r in kept.collect()) == [
            ("2024-12-03", 1.0), ("2024-12-04", 32.3)]


def test_reject_report(spark):
    df = payload.decode_payload(records_of(
        spark, line(record()), line(HEADER), "bad", line(record(DATE="12/03/2024")),
        line(record(STATION=" "))))
    assert {r.reason: r.records for r in clean.reject_report(df).collect()} == {
        "header": 1, "short line": 1, "bad date": 1, "no station": 1}


def test_case_file_with_repeated_header_padding_and_blank_line(spark, tmp_path):
    (tmp_path / "cases.csv").write_text(
        "city,year,weekofyear,total_cases\r\ncity,year,weekofyear,total_cases\r\n"
        "sj,2004,1,136\r\nsj,2004,53,0 \r\n\r\nsj,2004,x,1\r\n")
    df = read_cases_csv(spark, str(tmp_path / "cases.csv"))
    assert dict(df.dtypes)["total_cases"] == "int"
    assert sorted(map(tuple, df.collect())) == [("sj", 2004, 1, 136), ("sj", 2004, 53, 0)]
    assert df.count() == 2


def test_tree_scan_reads_station_and_year_from_the_path(spark, tmp_path):
    for folder in ("01001099999-2023", "01001099999-2024"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "01001099999.csv").write_text(line(HEADER) + "\n" + line(record()) + "\n")
    rows = read_observation_tree(spark, str(tmp_path)).collect()
    assert sorted((r.file_station, r.file_year, r.STATION) for r in rows) == [
        ("01001099999", 2023, "01001099999"), ("01001099999", 2024, "01001099999")]


def test_fill_and_drop(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, 2.0)], "k INT, a DOUBLE, b DOUBLE")
    assert clean.drop_null_rows(df).count() == 1
    assert clean.drop_null_rows(df, ["k"]).count() == 2
    assert tuple(clean.fill_defaults(df, ["a"]).first()) == (1, 0.0, None)
    assert tuple(clean.fill_defaults(df).first()) == (1, 0.0, 0.0)
