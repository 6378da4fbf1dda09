import io
import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from railctx.operators.readings import temperature_hourly
from railctx.operators.stops import train_stops
from railctx.period import Period
from railctx.plans import queries
from railctx.plans.feeds import Feeds
from railctx.sources import api_archive, delimited, fixed_width, railway, station_json, zip_members
from railctx.sources.landing import LandingPaths

JUNE = Period.month("2026-06")
HEADER = "STATIONS_ID;MESS_DATUM;  QN_9;TT_TU;RF_TU;eor"


@pytest.mark.parametrize("counter", [pa.int32(), pa.int64()], ids=str)
def test_nanosecond_parquet(spark, tmp_path, counter):
    text = ["station_name", "xml_station_name", "eva", "train_number", "line_number", "final_destination_station", "train_type", "train_line_ride_id", "id"]
    times = ["time", "arrival_planned_time", "arrival_change_time", "departure_planned_time", "departure_change_time"]
    columns = {name: pa.array(["1"]) for name in text}
    columns |= {name: pa.array([1780324200 * 10**9], pa.timestamp("ns")) for name in times}
    columns |= {name: pa.array([1], counter) for name in ("delay_in_min", "train_line_station_num")}
    columns |= {name: pa.array([None], pa.bool_()) for name in ("arrival_is_canceled", "departure_is_canceled")}
    path = str(tmp_path / "data.parquet")
    pq.write_table(pa.table(columns), path)
    raw = railway.read_stops(spark, path)
    assert raw.first()["time"] == 1780324200 * 10**9
    row = train_stops(raw).select(F.col("event_time_utc").cast("string"), "eva", "delay_in_min", "arrival_is_canceled").first()
    assert tuple(row) == ("2026-06-01 12:30:00", "00000001", 1, False)
    assert delimited.missing_columns(raw.drop("eva"), ["id", "eva"]) == ["eva"]


def test_station_array_and_lines(spark, tmp_path):
    objects = [{"number": 1, "name": "A", "evaNumbers": [{"number": 11}]}, {"number": 2, "name": "B"}]
    path = tmp_path / "stations.json"
    path.write_text(json.dumps(objects, indent=2))
    parsed = station_json.read_station_objects(spark, str(path))
    assert sorted(r["number"] for r in parsed.collect()) == [1, 2]
    station_json.write_station_objects(parsed, str(tmp_path / "lines"))
    again = station_json.read_station_lines(spark, str(tmp_path / "lines"))
    assert sorted(map(str, again.collect())) == sorted(map(str, parsed.collect()))


def test_broken_station_file_is_an_error(spark, tmp_path):
    path = tmp_path / "stations.json"
    path.write_text('[{"number": 1, "name": ')
    with pytest.raises(Exception, match="MALFORMED|Malformed|parse"):
        station_json.read_station_objects(spark, str(path)).collect()


def test_umlauts_do_not_move_columns(spark, tmp_path):
    line = "00044 20070401 20260710             44     52.9336   8.2370  Großenkneten Süd, \"Alt\"".ljust(102) + "Thüringen".ljust(28)
    path = tmp_path / "TU.txt"
    path.write_bytes(f"Stations_id von\n{line}\n".encode("latin-1"))
    out = fixed_width.sensor_listing(fixed_width.read_lines(spark, str(path))).first()
    assert (out["station_name"], out["federal_state"]) == ('Großenkneten Süd, "Alt"', "Thüringen")
    assert (out["latitude"], out["longitude"]) == (52.9336, 8.237)


def observation_files(tmp_path):
    files = {
        "produkt_tu_stunde_1.txt": [HEADER, "         44;2026060100;    3;  15.4;  81.0;eor", "         44;2026053100;    3;1;2;eor"],
        "produkt_tu_stunde_2.txt": ["STATIONS_ID;MESS_DATUM;  QN_9;RF_TU;TT_TU;eor", "         73;2026060101;    3;  70.0;  10.5;eor"],
        "produkt_tu_stunde_3.txt": ["STATIONS_ID;MESS_DATUM;QN_9;TT_TU;eor", "         91;2025060101;202606;  70.0;eor"],
        "produkt_tu_stunde_4.txt": ["         92;2026060101;    3;  70.0;  10.5;eor"],
    }
    for name, lines in files.items():
        (tmp_path / name).write_bytes("\n".join(lines).encode("latin-1"))
    return str(tmp_path / "*.txt")


def test_observation_file_audit(spark, tmp_path):
    lines = delimited.read_observation_lines(spark, observation_files(tmp_path))
    audit = delimited.observation_file_audit(lines, delimited.TEMPERATURE_FIELDS, JUNE)
    out = {r["file"][-5]: tuple(r)[1:] for r in audit.collect()}
    assert out["1"] == (True, "", False, 2, 1, True)
    assert out["2"] == (True, "", True, 1, 1, True)
    # The digits of the month in another field are no coverage.
    assert out["3"] == (True, "RF_TU", False, 1, 0, False)
    assert out["4"][:2] == (False, "STATIONS_ID,MESS_DATUM,QN_9,TT_TU,RF_TU")


def test_fields_follow_the_header_of_their_file(spark, tmp_path):
    lines = delimited.read_observation_lines(spark, observation_files(tmp_path))
    named = delimited.named_fields(lines, delimited.TEMPERATURE_FIELDS)
    out = temperature_hourly(named.drop("file"), JUNE)
    got = {r["dwd_station_id"]: (r["temp_celsius"], r["humidity_pct"]) for r in out.collect()}
    assert got == {"00044": (15.4, 81.0), "00073": (10.5, 70.0)}


def test_delimited_files_with_padded_header(spark, tmp_path):
    (tmp_path / "produkt_tu_stunde_1.txt").write_text(HEADER + "\n         44;2026060100;    3;  15.4;-999;eor\n")
    raw = delimited.read_observations(spark, str(tmp_path / "*.txt"))
    row = temperature_hourly(raw, JUNE).first()
    assert (row["dwd_station_id"], row["temp_celsius"], row["humidity_pct"], row["qn_9"]) == ("00044", 15.4, None, 3)


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as bundle:
        for name, text in members.items():
            bundle.writestr(name, text.encode("latin-1"))
    return buffer.getvalue()


def test_archives(spark, tmp_path):
    body = HEADER + "\r\n         44;2026060100;    3;  15.4;  81.0;eor\r\n"
    contents = {
        "good.zip": zipped({"produkt_tu_stunde_a.txt": body, "Metadaten_x.txt": "ö"}),
        "nested.zip": zipped({"in/produkt_tu_stunde_b.txt": body.replace("44", "45")}),
        "none.zip": zipped({"other.txt": "x"}),
        "two.zip": zipped({"produkt_tu_stunde_c.txt": body, "produkt_tu_stunde_d.txt": body}),
        "same1.zip": zipped({"produkt_tu_stunde_e.txt": body}),
        "same2.zip": zipped({"x/produkt_tu_stunde_e.txt": body}),
        "junk.zip": b"not a zip",
    }
    damaged = bytearray(zipped({"produkt_tu_stunde_f.txt": body}))
    damaged[damaged.index(b"STATIONS_ID")] ^= 1
    contents["damaged.zip"] = bytes(damaged)
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "note.txt").write_text("not an archive")
    members = zip_members.archive_members(
        zip_members.read_archives(spark, str(tmp_path)), zip_members.TEMPERATURE_MEMBER
    )
    audit = {r["archive"]: (r["matches"], r["problem"]) for r in zip_members.archive_audit(members).collect()}
    assert audit == {
        "good.zip": (1, None),
        "nested.zip": (1, None),
        "none.zip": (0, "expected one observation file"),
        "two.zip": (2, "expected one observation file"),
        "same1.zip": (1, "file name collision"),
        "same2.zip": (1, "file name collision"),
        "junk.zip": (0, "not a readable archive"),
        "damaged.zip": (0, "bad checksum"),
    }
    good = members.where("archive IN ('good.zip', 'nested.zip')")
    named = delimited.named_fields(zip_members.member_lines(good), delimited.TEMPERATURE_FIELDS)
    out = temperature_hourly(named.drop("file"), JUNE).collect()
    assert sorted((r["dwd_station_id"], r["temp_celsius"]) for r in out) == [("00044", 15.4), ("00045", 15.4)]


def archive(spark, rows, schema="api_name string, status_code bigint, response_data string"):
    return spark.createDataFrame(rows, schema)


def body(*stations):
    return json.dumps({"result": [{"number": n, "name": name, "evaNumbers": [{"number": 7}]} for n, name in stations]})


def test_last_station_of_the_archive_wins(spark, tmp_path):
    name = api_archive.STATION_INTERFACE
    rows = [
        (name, 200, body((1, "old"), (2, "two"), (None, "nobody"))),
        (name, 200, body((1, "middle"), (1, "new"))),
        (name, 500, body((1, "failed"))),
        ("timetables/v1/plan", 200, body((3, "foreign"))),
        (name, 200, ""),
        (name, 200, None),
    ]
    path = str(tmp_path / "archive")
    archive(spark, rows).coalesce(1).write.parquet(path)
    stored = api_archive.read_archive(spark, path)
    latest = {r["number"]: r["name"] for r in api_archive.latest_station_objects(stored).collect()}
    assert latest == {1: "new", 2: "two"}
    audit = api_archive.archive_audit(stored).first().asDict()
    assert audit == {"responses": 6, "accepted": 2, "malformed": 0, "stations_listed": 5, "unreadable_numbers": 0, "usable": True}


@pytest.mark.parametrize("bad", ["{broken", '{"result": []}', '{"other": 1}'])
def test_malformed_responses_are_counted(spark, bad):
    name = api_archive.STATION_INTERFACE
    stored = archive(spark, [(name, 200, bad), (name, 200, body((1, "a")))])
    audit = api_archive.archive_audit(stored).first()
    assert (audit["accepted"], audit["malformed"], audit["usable"]) == (2, 1, False)


def test_archive_without_status_column(spark):
    stored = archive(spark, [(api_archive.STATION_INTERFACE, body((1, "a")))], "api_name string, response_data string")
    assert api_archive.archive_audit(stored).first()["usable"] is True
    empty = stored.limit(0)
    assert api_archive.archive_audit(empty).first()["usable"] is False


def test_landing_paths(spark, monkeypatch):
    monkeypatch.delenv("RAILCTX_LANDING", raising=False)
    assert LandingPaths.resolve(spark, JUNE).stops == "landing/railway/data-2026-06.parquet"
    monkeypatch.setenv("RAILCTX_LANDING", "/env/")
    assert LandingPaths.resolve(spark, JUNE).wind_files == "/env/dwd/wind/*.txt"
    spark.conf.set("railctx.landing", "s3a://bucket/base")
    try:
        assert LandingPaths.resolve(spark, JUNE).station_json == "s3a://bucket/base/stada/stada_stations.json"
        assert LandingPaths.resolve(spark, JUNE, "/given").station_json == "/given/stada/stada_stations.json"
    finally:
        spark.conf.unset("railctx.landing")


def test_audit_follows_the_header_and_skips_blank_lines(spark):
    lines = spark.createDataFrame(
        [("a", "STATIONS_ID;QN_9;MESS_DATUM;TT_TU;RF_TU"), ("a", "3379;3;2026060112;1.0;2.0"), ("a", ""), ("a", "  ")], "file string, value string"
    )
    row = delimited.observation_file_audit(lines, delimited.TEMPERATURE_FIELDS, JUNE).first()
    assert (row["readings"], row["in_period"], row["covers_period"], row["order_differs"]) == (1, 1, True, True)


def test_archive_faults_end_the_read(spark):
    sound = [(api_archive.STATION_INTERFACE, 200, '{"result": [{"number": 1, "name": "a"}, {"name": "no number"}]}')]
    other = [("plan", 200, "{broken"), (api_archive.STATION_INTERFACE, 503, "{broken"), (api_archive.STATION_INTERFACE, 200, "")]
    ordered = lambda rows: archive(spark, rows).withColumn("at", F.monotonically_increasing_id())
    good = ordered(sound + other)
    assert [r["number"] for r in api_archive.checked_station_objects(good, ["at"]).collect()] == [1]
    audit = api_archive.archive_audit(good).first()
    assert (audit["stations_listed"], audit["unreadable_numbers"], audit["usable"]) == (2, 0, True)
    for body, told in (
        ('{"result": [{"number": "12a"}, {"number": 7}]}', "cannot be read: 12a"),
        ('{"result": [', "without stations"),
        ('{"result": []}', "without stations"),
        ("[]", "without stations"),
    ):
        bad = ordered(sound + [(api_archive.STATION_INTERFACE, 200, body)])
        with pytest.raises(Exception, match=told):
            api_archive.checked_station_objects(bad, ["at"]).select("name").collect()
        assert not api_archive.archive_audit(bad).first()["usable"]
    bad = ordered([(api_archive.STATION_INTERFACE, 200, '{"result": [{"number": "12a"}, {"number": 7}]}')])
    audit = api_archive.archive_audit(bad).first()
    assert (audit["malformed"], audit["stations_listed"], audit["unreadable_numbers"]) == (0, 2, 1)


def test_lines_are_read_once_where_headers_are_known_to_be_apart(spark):
    feeds = Feeds(spark, "/root/testdata/sf0.001")
    for query in (queries.readings_by_header, queries.source_header_audit):
        plan = query(feeds)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_shipdate") <= 1 and plan.count("Relation [l_orderkey") == 1


def test_a_second_header_line_in_a_later_block_is_no_header(spark):
    rows = [("f", True, HEADER), ("f", False, "STATIONS_ID;RF_TU;TT_TU;QN_9;MESS_DATUM;eor"), ("f", False, "1;2026060100;3;15.4;81.0;eor")]
    lines = spark.createDataFrame(rows, "file string, at_start boolean, value string")
    (row,) = delimited.named_fields(lines, delimited.TEMPERATURE_FIELDS).collect()
    assert (row["TT_TU"], row["RF_TU"]) == ("15.4", "81.0")
