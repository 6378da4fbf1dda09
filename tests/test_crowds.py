"""Crowded join keys are cut into parts, with the adaptive skew join switched off."""

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from railctx.operators.enrich import find_crowds, with_context

TASKS = 24
HOUR = "TIMESTAMP '2026-06-01 10:00:00'"


@pytest.fixture
def plain_joins(spark):
    """No broadcast, no adaptive help: what the plan says is what runs."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": str(TASKS),
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def feeds(spark, stops=24_000, evas=400):
    """A third of the stops at one station in one hour; every station has a sensor of its own, every fifth shares one."""
    k = F.col("id")
    hot = k % 3 == 0
    rows = spark.range(stops).select(
        F.concat(F.lit("s"), k).alias("id"),
        F.when(hot, "e0").otherwise(F.concat(F.lit("e"), k % evas)).alias("eva"),
        F.when(k % 50 == 1, None).otherwise(F.timestamp_add("HOUR", F.when(hot, 0).otherwise((k % 97).cast("int")), F.expr(HOUR))).alias("event_hour_utc"),
    )
    # Some stations are unknown.
    known = spark.range(evas).where(k % 7 != 6)
    eva = F.concat(F.lit("e"), k).alias("eva")
    stations = known.select(eva, F.concat(F.lit("Station "), k).alias("station_name"), k.cast("int").alias("category"), F.lit(1).alias("price_category"), F.lit("A").alias("federal_state"))
    mapping = known.select(eva, F.concat(F.lit("t"), k).alias("nearest_tu_station_id"), F.lit(1.0).alias("nearest_tu_dist_km"), F.concat(F.lit("f"), F.floor(k / 5)).alias("nearest_ff_station_id"), F.lit(2.0).alias("nearest_ff_dist_km"))
    hours = spark.range(90).select(F.timestamp_add("HOUR", k.cast("int"), F.expr(HOUR)).alias("observation_hour_utc"))
    temperature = spark.range(evas).select(F.concat(F.lit("t"), k).alias("dwd_station_id")).crossJoin(hours).select("*", F.hour("observation_hour_utc").cast("double").alias("temp_celsius"), F.lit(50.0).alias("humidity_pct"), F.lit(3).alias("qn_9"))
    wind = spark.range(evas).select(F.concat(F.lit("f"), k).alias("dwd_station_id")).crossJoin(hours).select("*", F.lit(4.0).alias("wind_speed_ms"), F.lit(90).alias("wind_direction_deg"), F.lit(10).alias("qn_3"))
    return rows, stations, mapping, temperature, wind


def tasks_of(df):
    counts = Counter({r["task"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()})
    return [counts.get(task, 0) for task in range(TASKS)]


def test_no_task_gets_the_crowd(spark, plain_joins):
    stops, *lookups = feeds(spark)
    crowds = find_crowds(stops, lookups[1], TASKS)
    uncut, cut = tasks_of(with_context(stops, *lookups)), tasks_of(with_context(stops, *lookups, crowds=crowds))
    assert sum(uncut) == sum(cut) == stops.count()
    assert max(uncut) > 5 * median(uncut)
    assert max(cut) <= 3 * median(cut)


def test_cut_keys_meet_the_same_rows(spark, plain_joins):
    stops, *lookups = feeds(spark, 3000, 60)
    crowds = find_crowds(stops, lookups[1], TASKS)
    assert crowds.evas.where("eva = 'e0'").first()["parts"] >= 8
    assert crowds.temperature.where("tu_key = 't0'").count() >= 1 and crowds.wind.count() >= 1
    columns = ["id", "eva", "event_hour_utc", "official_name", "category", "temp_celsius", "wind_speed_ms", "found_station", "found_temperature", "found_wind"]
    uncut = with_context(stops, *lookups).select(*columns)
    cut = with_context(stops, *lookups, crowds=crowds).select(*columns)
    assert uncut.exceptAll(cut).isEmpty() and cut.exceptAll(uncut).isEmpty()
    assert uncut.where("found_temperature").count() > 1000


def test_repeated_lookup_rows_still_multiply(spark, plain_joins):
    stops, stations, mapping, temperature, wind = feeds(spark, 600, 20)
    crowds = find_crowds(stops, mapping, TASKS)
    twice = stations.unionAll(stations.where("eva = 'e0'"))
    uncut = with_context(stops, twice, mapping, temperature, wind).groupBy("id").count()
    cut = with_context(stops, twice, mapping, temperature, wind, crowds=crowds).groupBy("id").count()
    assert uncut.exceptAll(cut).isEmpty() and cut.exceptAll(uncut).isEmpty()


def test_no_stops_have_no_crowds(spark):
    stops, *lookups = feeds(spark, 30, 10)
    none = stops.where("id = 'x'")
    crowds = find_crowds(none, lookups[1], TASKS)
    assert crowds.evas.isEmpty() and crowds.temperature.isEmpty() and crowds.wind.isEmpty()
    assert with_context(none, *lookups, crowds=crowds).isEmpty()
