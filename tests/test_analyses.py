import pytest
from pyspark.sql import functions as F

from railctx.analytics import delays, distances
from railctx.operators import months
from railctx.period import Period
from railctx.quality import coverage

STOP = (
    "federal_state string, eva string, train_type string, clock string, delay_in_min int, "
    "arrival_is_canceled boolean, departure_is_canceled boolean"
)


@pytest.fixture
def stops(spark):
    rows = [
        ("A", "1", "ICE", "2026-06-01 08:10:00", 0, False, False),
        ("A", "1", "ICE", "2026-06-01 08:40:00", 20, False, False),
        ("A", "1", "RE", "2026-06-02 08:05:00", 7, True, True),
        ("A", "2", "RE", "2026-06-02 09:05:00", 5, False, False),
        ("B", "3", "RE", "2026-06-02 10:05:00", None, False, True),
        (None, "4", "RE", None, 6, False, False),
    ]
    df = spark.createDataFrame(rows, STOP)
    return df.withColumn("event_time_local", F.col("clock").cast("timestamp")).drop("clock")


def test_summary(stops):
    row = delays.delay_summary(stops).first().asDict()
    assert row == {
        "stops": 6,
        "late_stops": 3,
        "cancelled_stops": 2,
        "mean_delay": 7.6,
        "late_share": 0.6,
        "cancelled_share": 0.333333,
        "median_delay": 6.0,
        "p90_delay": 14.8,
        "max_delay": 20,
    }


def test_groups(stops):
    by_type = {r["train_type"]: r["stops"] for r in delays.delay_by_train_type(stops).collect()}
    assert by_type == {"ICE": 2, "RE": 4}
    by_hour = {r["local_hour"]: r["late_stops"] for r in delays.delay_by_hour(stops).collect()}
    assert by_hour == {8: 2, 9: 0, 10: 0, None: 1}
    assert {r["stops"] for r in delays.delay_by_day(stops).collect()} == {2, 3, 1}


def test_group_without_a_known_delay_has_no_rate(stops):
    only = delays.delay_summary(stops.where("eva = '3'")).first()
    assert (only["mean_delay"], only["late_share"], only["cancelled_share"]) == (None, None, 1.0)


def test_subtotals(stops):
    out = {(r["level"], r["federal_state"], r["eva"]): r for r in delays.delay_by_place(stops).collect()}
    assert len(out) == 4 + 3 + 1
    assert out[3, None, None]["stops"] == 6 and out[3, None, None]["mean_delay"] == 7.6
    assert out[1, "A", None]["stops"] == 4 and out[1, "A", None]["mean_delay"] == 8.0
    assert out[0, None, "4"]["late_share"] == 1.0


def test_hotspots_rank_by_late_days(stops):
    out = [r.asDict() for r in delays.delay_hotspots(stops, top=1).collect()]
    first = next(r for r in out if r["federal_state"] == "A")
    assert (first["eva"], first["local_hour"], first["days"], first["late_days"], first["late_stops"]) == ("1", 8, 2, 2, 2)
    assert {r["federal_state"] for r in out} == {"A", "B"}


def test_weather_bands_need_near_and_graded_readings(spark):
    df = spark.createDataFrame(
        [
            (10, False, False, -0.1, 3, 10.0, 4.9, 10, 10.0),
            (10, False, False, 0.0, 3, 25.0, 5.0, 10, 25.0),
            (10, False, False, 20.0, None, 10.0, 10.0, 10, 25.1),
            (10, False, False, None, 3, 10.0, None, 10, 1.0),
            (10, False, False, 25.0, 3, None, 12.0, 10, 1.0),
        ],
        "delay_in_min int, arrival_is_canceled boolean, departure_is_canceled boolean, temp_celsius double, qn_tu int, "
        "nearest_tu_dist_km double, wind_speed_ms double, qn_ff int, nearest_ff_dist_km double",
    )
    strict = {(r["temperature_band"], r["wind_band"]): r["stops"] for r in delays.delay_by_weather(df, least_quality=(4, 10)).collect()}
    assert {t for t, _ in strict} == {"unknown"} and strict["unknown", "below 5 m/s"] == 1
    assert {w for _, w in ((r["temperature_band"], r["wind_band"]) for r in delays.delay_by_weather(df, least_quality=(3, 11)).collect())} == {"unknown"}
    bands = {(r["temperature_band"], r["wind_band"]): r["stops"] for r in delays.delay_by_weather(df).collect()}
    assert bands == {
        ("below 0 C", "below 5 m/s"): 1,
        ("0 to 10 C", "5 to 10 m/s"): 1,
        ("unknown", "unknown"): 2,
        ("unknown", "10 m/s and above"): 1,
    }


def test_join_coverage(spark):
    df = spark.createDataFrame(
        [
            ("2026-06-01 01:00:00", True, "00001", "00002", True, 3.0, True, 1.0),
            ("2026-06-01 02:00:00", True, "00001", "00002", True, None, True, 1.0),
            ("2026-06-02 02:00:00", False, None, None, False, None, False, None),
        ],
        "hour string, found_station boolean, nearest_tu_station_id string, nearest_ff_station_id string, "
        "found_temperature boolean, temp_celsius double, found_wind boolean, wind_speed_ms double",
    ).withColumn("event_hour_utc", F.col("hour").cast("timestamp"))
    row = coverage.join_coverage(df).first()
    # The second stop met a temperature reading, but one without a value.
    assert tuple(row) == (3, 0.666667, 0.666667, 0.666667, 0.666667, 0.666667, 0.333333, 0.666667)
    by_day = {str(r["day"]): r["temperature_value_share"] for r in coverage.match_by_day(df).collect()}
    assert by_day == {"2026-06-01": 0.5, "2026-06-02": 0.0}


def test_distances_and_joint_penalty(spark):
    stations = spark.createDataFrame(
        [("1", 50.0, 8.0), ("2", 51.0, 8.0), ("3", None, None)], "eva string, latitude double, longitude double"
    )
    sensors = spark.createDataFrame(
        [("t", 50.0, 8.0, True, False), ("f", 50.1, 8.0, False, True), ("b", 51.0, 8.0, True, True)],
        "dwd_station_id string, latitude double, longitude double, has_temperature boolean, has_wind boolean",
    )
    degree = 111.194927
    out = {r["network"]: r for r in distances.distance_distribution(stations, sensors).collect()}
    assert (out["tu"]["stations"], out["tu"]["max_km"], out["tu"]["near_share"]) == (2, 0.0, 1.0)
    assert out["ff"]["max_km"] == pytest.approx(degree / 10, abs=1e-4)
    assert out["ff"]["median_km"] == pytest.approx(degree / 20, abs=0.01)
    row = distances.joint_sensor_penalty(stations, sensors).first()
    assert (row["stations"], row["same_site_share"]) == (2, 0.5)
    assert row["max_extra_tu_km"] == pytest.approx(degree, abs=1e-4)
    assert row["mean_extra_tu_km"] == pytest.approx(degree / 2, abs=1e-4)
    assert row["max_extra_ff_km"] == pytest.approx(degree * 0.9, abs=1e-4)


def test_extent(spark):
    df = spark.createDataFrame([(50.0, 8.0), (None, 9.0), (47.5, 12.0)], "latitude double, longitude double")
    assert tuple(coverage.coordinate_extent(df).first()) == (3, 2, 47.5, 50.0, 8.0, 12.0)


# Months


def facts(spark, rows):
    return spark.createDataFrame(rows, "id int, period string")


def test_replacement_touches_its_own_month_only(spark, tmp_path):
    path = str(tmp_path / "facts")
    months.write_periods(facts(spark, [(1, "2026-05"), (2, "2026-06"), (3, "2026-06")]), path, ["2026-05", "2026-06"])
    delivery = facts(spark, [(4, "2026-06"), (5, "2026-07")])
    for _ in range(2):
        months.write_periods(delivery, path, ["2026-06", "2026-07"])
        stored = {(r["id"], r["period"]) for r in spark.read.parquet(path).collect()}
        assert stored == {(1, "2026-05"), (4, "2026-06"), (5, "2026-07")}


def test_an_empty_delivery_empties_its_month(spark, tmp_path):
    path = str(tmp_path / "facts")
    months.write_periods(facts(spark, [(1, "2026-05"), (2, "2026-06")]), path, ["2026-05", "2026-06"])
    nothing = facts(spark, [])
    months.write_periods(nothing, path, ["2026-06"])
    stored = spark.read.schema("id int, period string").parquet(path)
    assert [tuple(r) for r in stored.collect()] == [(1, "2026-05")]
    fresh = str(tmp_path / "fresh")
    months.write_periods(nothing, fresh, ["2026-06"])
    assert spark.read.schema("id int, period string").parquet(fresh).count() == 0
    target = facts(spark, [(1, "2026-05"), (2, "2026-06"), (3, None)])
    left = months.replace_periods(target, nothing, ["2026-06"])
    assert sorted(r["id"] for r in left.collect()) == [1, 3]
    assert "Join" not in left._jdf.queryExecution().executedPlan().toString()


def test_replacement_as_a_table(spark):
    target = facts(spark, [(1, "2026-05"), (2, "2026-06"), (3, "2026-06")])
    delivery = facts(spark, [(4, "2026-06")])
    once = months.replace_periods(target, delivery, ["2026-06"])
    twice = months.replace_periods(once, delivery, ["2026-06"])
    expected = [(1, "2026-05"), (4, "2026-06")]
    assert sorted(map(tuple, once.select("id", "period").collect())) == expected
    assert sorted(map(tuple, twice.select("id", "period").collect())) == expected


def test_retention_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "facts")
    labels = ["2025-05", "2025-06", "2025-07", "2026-06", "2026-07"]
    months.write_periods(facts(spark, list(enumerate(labels))), path, labels)
    kept = months.retained(spark.read.parquet(path), "2026-06")
    assert sorted(r["period"] for r in kept.collect()) == ["2025-07", "2026-06"]
    assert "PartitionFilters: [isnotnull(period" in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["period"] for r in months.retained(facts(spark, [(1, "2025-12"), (2, "2026-01")]), "2026-01", 1).collect()) == ["2026-01"]


def test_retention_of_an_archive_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "archive")
    stamps = ["2025-06-30 23:59:59", "2025-07-01 00:00:00", "2026-06-30 23:59:59", "2026-07-01 00:00:00"]
    spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp").alias("at")).write.parquet(path)
    kept = months.retained_rows(spark.read.parquet(path), "at", "2026-06")
    assert sorted(str(r["at"]) for r in kept.collect()) == stamps[1:3]
    assert "GreaterThanOrEqual(at" in kept._jdf.queryExecution().executedPlan().toString()


def test_canonical_month(spark):
    df = spark.sql(
        "SELECT explode(array(TIMESTAMP '2026-05-31 23:59:59', TIMESTAMP '2026-06-01 00:00:00', TIMESTAMP '2026-07-01 00:00:00')) AS ts"
    )
    out = months.canonical_month(df, "ts", Period.month("2026-06")).select(F.col("ts").cast("string"), "period")
    assert [tuple(r) for r in out.collect()] == [("2026-06-01 00:00:00", "2026-06")]


def test_month_over_month(spark):
    df = facts(spark, [(1, "2026-04"), (2, "2026-05"), (3, "2026-05"), (4, "2026-07"), (5, "2026-12"), (6, "2027-01")]).withColumn("source", F.lit("s"))
    out = months.month_over_month(df, {"n": F.count(F.lit(1))}, ["source"])
    got = {r["period"]: (r["n"], r["previous_n"], r["n_change"]) for r in out.collect()}
    assert got == {"2026-04": (1, None, None), "2026-05": (2, 1, 1), "2026-07": (1, None, None), "2026-12": (1, None, None), "2027-01": (1, 1, 0)}
