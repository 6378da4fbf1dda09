"""Counters at several nodes of one plan, and uniqueness by hashes."""

import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from railctx.operators import readings
from railctx.operators.enrich import train_stop_weather, with_context
from railctx.period import Period
from railctx.plans import queries
from railctx.plans.feeds import Feeds
from railctx.quality import fact_audit, grain, one_pass, uniqueness
from railctx.session import HASHED_PART

JANUARY = Period.month("2024-01")
SF_DIR = "/root/testdata/sf0.001"


class Reads(Feeds):
    """Feeds that mark every read row of the events with an accumulator."""

    def table(self, name):
        df = super().table(name)
        if name != "events":
            return df
        counter, read = self.spark.sparkContext.accumulator(0), []
        self.__dict__.setdefault("counters", []).append(counter)

        def count(batches):
            for batch in batches:
                counter.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)


@pytest.mark.parametrize("query", [queries.expectation_report, queries.published_columns, queries.row_preservation, queries.audit_facts, queries.grain_audit, queries.join_coverage])
def test_events_are_read_once(spark, query):
    feeds = Reads(spark, SF_DIR)
    query(feeds).collect()
    rows = Feeds(spark, SF_DIR).table("events").count()
    assert sum(counter.value for counter in feeds.counters) == rows


def test_line_items_are_grouped_once_for_both_readings(spark):
    read = []

    class Lines(Feeds):
        def table(self, name):
            read.append(name)
            return super().table(name)

    tables = Lines(spark, SF_DIR).lookups
    assert read.count("lineitem") == 1
    whole = Feeds(spark, SF_DIR)
    for name, alone in (("temperature", whole.temperature), ("wind", whole.wind)):
        assert tables[name].exceptAll(alone).isEmpty() and alone.exceptAll(tables[name]).isEmpty()
        assert tables[name].columns == alone.columns and tables[name].count() > 0


def test_hour_stamps_are_parsed_once_for_both_readings(spark):
    feeds = Feeds(spark, SF_DIR)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" in plan(feeds.temperature)
    for name in ("temperature", "wind"):
        assert "gettimestamp" not in plan(feeds.lookups[name])


def test_shared_hour_keys_keep_the_readings_of_each_feed(spark):
    stamps = ["2024010100", " 2024013123 ", "2023123123", "2024020100", "2024010599", "20240101", "", None]
    sensors = ["        7", "123456", None, ""]
    raw = spark.createDataFrame(
        [(s, t, str(i), "3", "4", "5") for i, (s, t) in enumerate((s, t) for s in sensors for t in stamps)],
        "STATIONS_ID string, MESS_DATUM string, TT_TU string, ` RF_TU` string, `  QN_9` string, other string",
    )
    shared = readings.temperature_hourly(readings.hourly_keys(raw, JANUARY), None)
    found = {tuple(r)[:3] for r in shared.collect()}
    first, last = datetime(2024, 1, 1), datetime(2024, 1, 31, 23)
    keys = [("00007", 0), ("123456", 8), ("00000", 24)]
    assert found == {(k, hour, float(i + at)) for k, i in keys for at, hour in enumerate((first, last))}
    assert sorted(map(tuple, readings.temperature_hourly(raw, JANUARY).collect())) == sorted(map(tuple, shared.collect()))


def test_short_parts_of_the_enrichment_are_joined_by_hash(spark):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", HASHED_PART: "0b"}
    before = {key: spark.conf.get(key) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        hashed = queries.stops_enriched(Feeds(spark, SF_DIR))
        rows = sorted(map(str, hashed.collect()))
        joins = hashed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ShuffledHashJoin" in joins and "SortMergeJoin" not in joins
        # A limit of the session's own is kept.
        spark.conf.set(HASHED_PART, "1b")
        again = queries.stops_enriched(Feeds(spark, SF_DIR))
        assert rows == sorted(map(str, again.collect())) and spark.conf.get(HASHED_PART) == "1b"
        assert "ShuffledHashJoin" not in again._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_counters_at_two_nodes(spark):
    left = spark.range(100).repartition(3)
    right = spark.createDataFrame([(7,), (7,), (8,)], "id long").withColumn("met", F.lit(True))

    def build(nodes):
        entered = nodes.at("in", left, {"rows": F.count(F.lit(1)), "large": F.count_if(F.col("id") > 50)})
        joined = entered.hint("merge").join(right, "id", "left")
        return nodes.at("out", joined, {"rows": F.count(F.lit(1)), "met": F.count("met")}).select()

    assert one_pass.one_pass(build) == {"in": {"rows": 100, "large": 49}, "out": {"rows": 101, "met": 3}}


def test_a_pass_that_counted_a_task_twice_is_repeated(spark, monkeypatch):
    left = spark.range(10)
    real, passes = one_pass.Nodes.read, []

    def read(nodes):
        passes.append(nodes)
        if len(passes) < 3:
            raise one_pass.CountedTwice("in")
        return real(nodes)

    monkeypatch.setattr(one_pass.Nodes, "read", read)
    build = lambda nodes: nodes.at("in", left, {"rows": F.count(F.lit(1))})
    assert one_pass.one_pass(build) == {"in": {"rows": 10}} and len(passes) == 3
    passes.clear()
    with pytest.raises(one_pass.CountedTwice):
        one_pass.one_pass(build, attempts=2)


def test_twice_run_tasks_are_noticed(spark):
    nodes = one_pass.Nodes()
    # The same partition twice: what an accumulator sees when a lost map task runs again.
    once = spark.range(5).coalesce(1)
    nodes.at("in", once, {"rows": F.count(F.lit(1))}).collect()
    observation, counters = nodes._placed["in"]

    class Doubled:
        _jo = observation._jo
        get = {**observation.get, one_pass._BEGUN: 2, "rows": 10}

    nodes._placed["in"] = (Doubled, counters)
    with pytest.raises(one_pass.CountedTwice):
        nodes.read()


def enrichment(spark):
    stations = spark.sql("SELECT '1' eva, 'One' station_name, 1 category, 1 price_category, 'A' federal_state")
    mapping = spark.sql("SELECT '1' eva, 't' nearest_tu_station_id, 1D nearest_tu_dist_km, 'w' nearest_ff_station_id, 2D nearest_ff_dist_km")
    hour = "TIMESTAMP '2024-01-05 10:00:00' observation_hour_utc"
    temperature = spark.sql(f"SELECT 't' dwd_station_id, {hour}, CAST(NULL AS DOUBLE) temp_celsius, 50D humidity_pct, 3 qn_9")
    wind = spark.sql(f"SELECT 'w' dwd_station_id, {hour}, 4D wind_speed_ms, 90 wind_direction_deg, 10 qn_3")
    return lambda stops: train_stop_weather(stops, stations, mapping, temperature, wind.unionAll(wind), flags=True)


def stops(spark, rows):
    names = "train_type train_number line_number final_destination_station train_line_ride_id".split()
    df = spark.createDataFrame(rows, "id string, eva string, hour string")
    times = ["event_time_local", "event_time_utc", "event_hour_utc", "arrival_planned_time_utc", "arrival_change_time_utc", "departure_planned_time_utc", "departure_change_time_utc"]
    return df.select(
        "id", "eva", F.lit("x").alias("station_name"), F.lit("X").alias("xml_station_name"),
        *[F.lit("n").alias(c) for c in names], F.lit(1).alias("train_line_station_num"), F.lit(2).alias("delay_in_min"),
        F.lit(False).alias("arrival_is_canceled"), F.lit(False).alias("departure_is_canceled"),
        F.lit(1).cast("long").alias("event_time_local_nanos"), *[F.col("hour").cast("timestamp").alias(c) for c in times],
    )


def test_all_audits_at_once(spark):
    rows = [("a", "1", "2024-01-05 10:00:00"), ("b", "2", "2024-01-05 10:00:00"), (" ", "1", None)]
    found = {(r["audit"], r["table_name"], r["item"]): (r["row_count"], r["value"]) for r in fact_audit.audit_facts(stops(spark, rows), enrichment(spark), JANUARY).collect()}
    # Two wind readings for one hour: the enrichment adds a row, and the audit tells.
    assert found["preservation", "train_stop_weather", "rows"] == (4, 3)
    assert found["expectation", "train_stops", "valid_stop_id"] == (3, 1)
    assert found["expectation", "train_stops", "valid_event_hour"] == (3, 1)
    assert found["expectation", "train_stop_weather", "has_sensor_mapping"] == (4, 1)
    assert found["match", "train_stop_weather", "temperature"] == (4, 2)
    assert found["match", "train_stop_weather", "temperature_value"] == (4, 0)
    assert found["match", "train_stop_weather", "station"] == (4, 3)
    assert found["column", "train_stop_weather", "wind_speed_ms"] == (4, 2)
    assert found["column", "train_stops", "event_time_utc"] == (3, 2)
    assert len(found) == 21 + 28 + 3 + 4 + 7 + 1


def test_no_stops(spark):
    counts = fact_audit.rules_of(stops(spark, []), enrichment(spark), JANUARY)
    assert all(value == 0 for table in counts.values() for value in table.values())
    assert tuple(fact_audit.preservation_of(stops(spark, []), enrichment(spark)).first()) == (0, 0, True)


def test_narrow_stops_meet_the_same_rows(spark):
    rows = [("a", "1", "2024-01-05 10:00:00"), ("b", "2", None)]
    assert enrichment(spark)(stops(spark, rows)).count() == 3
    stations = spark.sql("SELECT '1' eva, 'One' station_name, 1 category, 1 price_category, 'A' federal_state")
    mapping = spark.sql("SELECT '1' eva, 't' nearest_tu_station_id, 1D nearest_tu_dist_km, 'w' nearest_ff_station_id, 2D nearest_ff_dist_km")
    none = spark.createDataFrame([], "dwd_station_id string, observation_hour_utc timestamp, temp_celsius double, humidity_pct double, qn_9 int, wind_speed_ms double, wind_direction_deg int, qn_3 int")
    narrow = stops(spark, rows).select("id", "eva", "event_hour_utc")
    assert with_context(narrow, stations, mapping, none, none).select("id", "found_station").orderBy("id").collect() == [("a", True), ("b", False)]


# Uniqueness


def exact(df, key):
    groups = df.groupBy(*key).count()
    rows, keys, many = df.count(), groups.count(), groups.where("count > 1").count()
    return {"row_count": rows, "distinct_keys": keys, "duplicate_keys": many, "surplus_rows": rows - keys}


@pytest.mark.parametrize("spread", [10, 1000, 10**9])
def test_uniqueness_against_counting(spark, spread):
    rng = random.Random(spread)
    rows = [(rng.choice([None, str(rng.randrange(spread))]), rng.choice([None, 1, 2])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a string, b int").repartition(5)
    for key in (["a"], ["a", "b"]):
        assert uniqueness.uniqueness(df, key) == exact(df, key)


def test_uniqueness_without_rows_and_with_one_hot_key(spark):
    empty = spark.createDataFrame([], "a string")
    assert uniqueness.uniqueness(empty, ["a"]) == {"row_count": 0, "distinct_keys": 0, "duplicate_keys": 0, "surplus_rows": 0}
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"))
    assert uniqueness.uniqueness(hot, ["a"]) == {"row_count": 3000, "distinct_keys": 2001, "duplicate_keys": 1, "surplus_rows": 999}


def test_keys_that_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(uniqueness, "_hashed", lambda df, key: df.withColumn("_hash", F.xxhash64(F.length("a"))))
    df = spark.createDataFrame([(a,) for a in ["x", "y", "y", "zz", "long", "else"]], "a string").repartition(3)
    assert uniqueness.uniqueness(df, ["a"]) == exact(df, ["a"])


def test_little_is_shuffled_for_unique_keys(spark, monkeypatch):
    df = spark.range(0, 400_000, 1, 4).select(F.concat(F.lit("stop-of-a-long-name-"), "id").alias("id"))
    sketched = uniqueness.sketch(df, ["id"], 32)
    size = sketched.agg(F.sum(F.length("keys") + F.length("again")).alias("bytes"), F.sum("rows").alias("rows")).first()
    assert size["rows"] == 400_000 and size["bytes"] <= 7.1 * 400_000
    # No second read where all keys are proven unique.
    monkeypatch.setattr(uniqueness, "_hashed", lambda d, key, real=uniqueness._hashed, seen=[]: seen.append(1) or real(d, key) if not seen else pytest.fail("read twice"))
    assert uniqueness.uniqueness(df, ["id"])["surplus_rows"] == 0


def test_packed_hashes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5, 1000):
        hashes = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (uniqueness.unpack(uniqueness.pack(hashes), len(hashes)) == hashes).all()
    ends = np.array([0, 2**64 - 1], np.uint64)
    assert (uniqueness.unpack(uniqueness.pack(ends), 2) == ends).all()


def test_grain_audit_of_several_tables(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "eva string, id int")
    rows = {r["table_name"]: tuple(r)[1:] for r in grain.grain_audit({"one": df, "two": df}, {"one": ["eva"], "two": ["id"]}).collect()}
    assert rows == {"one": (3, 2, 1, 1), "two": (3, 3, 0, 0)}
