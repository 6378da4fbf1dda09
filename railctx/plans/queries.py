"""Every operator and analysis as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railctx import contracts
from railctx.analytics import delays, distances
from railctx.functions.geo import haversine_km
from railctx.functions.time import (
    TEXT,
    clock_to_nanos,
    is_ambiguous_local,
    is_skipped_local,
    local_instants,
    local_to_utc,
    raw_nanos,
    wall_clock,
)
from railctx.operators import months
from railctx.operators.enrich import with_context
from railctx.operators.stations import station_objects, stations
from railctx.plans import feeds
from railctx.plans.feeds import PERIOD, Feeds, raw_station_objects
from railctx.period import Period
from railctx.plans.publication import compare_with_previous
from railctx.quality import coverage, expectations, fact_audit, grain, snapshot
from railctx.session import materialize, shared_path
from railctx.sources import api_archive, delimited, fixed_width, station_json

Query = Callable[[SparkSession, str], DataFrame]


def at_edge(df: DataFrame) -> DataFrame:
    """Results leave with zone-less timestamps, the one kind of time both engines share."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.DateType))
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _small_tables(f: Feeds) -> dict[str, DataFrame]:
    """The published tables that are lookups of the enrichment."""
    tables = f.lookups
    return {
        "stations": tables["stations"],
        "weather_stations": tables["weather_stations"],
        "station_weather_mapping": tables["mapping"],
        "temperature_hourly": tables["temperature"],
        "wind_hourly": tables["wind"],
    }


def _located_stops(f: Feeds) -> DataFrame:
    """Stops with the one station attribute the place analyses need."""
    state = f.stations.select("eva", "federal_state")
    return f.stops.join(state, "eva", "left")


# Scans and source checks


def stops_normalized(f: Feeds) -> DataFrame:
    return f.stops


def stations_flattened(f: Feeds) -> DataFrame:
    """The station feed written as a file of JSON objects, read back and flattened."""
    objects = station_objects(raw_station_objects(f.table("customer"), f.table("nation"), f.table("region")))
    path = shared_path(f.spark)
    if path is None:  # a cluster without a shared folder
        return stations(objects)
    station_json.write_station_objects(objects, path)
    return stations(station_json.read_station_lines(f.spark, path))


def response_archive(f: Feeds) -> DataFrame:
    """Orders as archived responses: two stations per body, some broken, failed or foreign."""
    key, number = F.col("o_orderkey"), F.col("o_custkey")

    def station(n, name):
        return F.concat(
            F.lit('{"number": '), n, F.lit(', "name": "'), name, F.lit('", "category": '), key % 7, F.lit("}")
        )

    body = F.concat(
        F.lit('{"result": ['),
        station(number, F.col("o_orderpriority")),
        F.lit(", "),
        station(number + 1, F.col("o_orderstatus")),
        F.lit("]}"),
    )
    price = F.col("o_totalprice")
    return f.table("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "timetables/v1/plan")
        .otherwise(api_archive.STATION_INTERFACE)
        .alias("api_name"),
        F.when(F.col("o_orderstatus") == "P", 503).otherwise(200).cast("long").alias("status_code"),
        F.when(price < 10000, "")
        .when(price < 20000, '{"result": [')
        .when(price < 30000, '{"result": []}')
        .when(price < 40000, F.concat(F.lit('{"result": [{"number": "'), number, F.lit('a"}, {"name": "nameless"}]}')))
        .otherwise(body)
        .alias("response_data"),
    )


def api_archive_latest(f: Feeds) -> DataFrame:
    latest = api_archive.latest_station_objects(response_archive(f), ["o_orderkey"])
    return latest.select("number", "name", "category")


def api_archive_audit(f: Feeds) -> DataFrame:
    return api_archive.archive_audit(response_archive(f))


def fixed_width_listing(f: Feeds) -> DataFrame:
    member = feeds.in_temperature_network()
    return fixed_width.sensor_listing(
        feeds.raw_sensor_lines(f.table("supplier"), f.table("nation"), member), feeds.LISTING
    )


def sensor_networks_merged(f: Feeds) -> DataFrame:
    return f.weather_stations


def temperature_readings(f: Feeds) -> DataFrame:
    return f.temperature


def wind_readings(f: Feeds) -> DataFrame:
    return f.wind


def observation_lines(f: Feeds) -> DataFrame:
    """One observation file per supplier. Headers lack a field, are swapped, or are absent."""
    readings = feeds.raw_temperature(feeds.sensor_hours(f.table("lineitem"))).select(
        F.trim("STATIONS_ID").alias("sensor"),
        F.concat_ws(";", "STATIONS_ID", "MESS_DATUM", "  QN_9", "TT_TU", " RF_TU", F.lit("eor")).alias("value"),
    )
    nation = F.col("s_nationkey")
    headers = f.table("supplier").where(nation != 9).select(
        F.col("s_suppkey").cast("string").alias("sensor"),
        F.when(nation == 5, "STATIONS_ID;MESS_DATUM;  QN_9;TT_TU;eor")
        .when(nation == 7, "STATIONS_ID;MESS_DATUM;  QN_9;RF_TU;TT_TU;eor")
        .otherwise("STATIONS_ID;MESS_DATUM;  QN_9;TT_TU; RF_TU;eor")
        .alias("value"),
    )
    lines = readings.withColumn("at_start", F.lit(False)).unionByName(headers.withColumn("at_start", F.lit(True)))
    return lines.select(
        F.concat(F.lit("produkt_tu_stunde_"), "sensor", F.lit(".txt")).alias("file"), "at_start", "value"
    )


def source_header_audit(f: Feeds) -> DataFrame:
    return delimited.observation_file_audit(
        observation_lines(f), delimited.TEMPERATURE_FIELDS, PERIOD
    )


def readings_by_header(f: Feeds) -> DataFrame:
    return delimited.named_fields(observation_lines(f), delimited.TEMPERATURE_FIELDS)


def source_coverage(f: Feeds) -> DataFrame:
    return coverage.period_coverage(f.raw_stops, PERIOD)


def key_overflow(f: Feeds) -> DataFrame:
    return grain.key_overflow(f.raw_stops, "eva", 3)


# Files against their manifest. Documents and conversations are the files that landed;
# the manifest lists the documents, some of them wrongly, and pages that never arrived.


def _documents(f: Feeds) -> DataFrame:
    """Paths, sizes and digests of the texts; narrow, so that it can be kept and each text is hashed once."""
    return f.table("documents").select(
        "doc_id",
        "lang",
        snapshot.digest(F.concat("text", F.lit("x"))).alias("altered_sha256"),
        F.concat(F.lit("texts/"), "doc_id", F.lit(".txt")).alias("relative_path"),
        F.octet_length("text").cast("long").alias("byte_size"),
        snapshot.digest(F.col("text")).alias("sha256"),
    )


def landed_files(f: Feeds, documents: DataFrame | None = None) -> DataFrame:
    talk = f.table("conversations").select(
        F.concat(F.lit("talks/"), "conv_id", F.lit("/"), "turn").alias("relative_path"),
        F.octet_length("text").cast("long").alias("byte_size"),
        snapshot.digest(F.col("text")).alias("sha256"),
    )
    return (_documents(f) if documents is None else documents).select(*talk.columns).unionByName(talk)


def manifest_list(f: Feeds, documents: DataFrame | None = None) -> DataFrame:
    labels = f.table("labels").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    doc = (_documents(f) if documents is None else documents).join(labels, "doc_id", "left")
    documents = doc.select(
        F.when(F.col("lang") == "fr", F.concat(F.lit("/"), "relative_path"))
        .when(F.col("lang") == "es", F.concat(F.lit("texts/../"), "relative_path"))
        .otherwise(F.col("relative_path"))
        .alias("relative_path"),
        F.when(F.col("quality") == 0, F.col("byte_size") + 1)
        .otherwise(F.col("byte_size"))
        .alias("byte_size"),
        F.when(F.col("toxic") == 1, F.col("altered_sha256"))
        .otherwise(F.upper("sha256"))
        .alias("sha256"),
        F.when(F.col("toxic") == 1, "notes").otherwise("dwd_observation_txt").alias("role"),
        F.when(F.col("quality") == 1, F.col("sha256"))
        .when(F.col("quality") == 0, snapshot.digest(F.lit("nothing")))
        .alias("parent_artifact_sha256"),
    )
    pages = f.table("pages").select(
        F.concat(F.lit("pages/"), "page_id").alias("relative_path"),
        (F.octet_length("html").cast("long") - 5000).alias("byte_size"),
        F.substring(snapshot.digest(F.col("html")), 1, 60).alias("sha256"),
        F.lit("dwd_metadata").alias("role"),
        F.lit(None).cast("string").alias("parent_artifact_sha256"),
    )
    return documents.unionByName(pages)


def manifest_inventory(f: Feeds) -> DataFrame:
    return landed_files(f)


def manifest_rule_audit(f: Feeds) -> DataFrame:
    return snapshot.manifest_rule_audit(materialize(manifest_list(f)))


def snapshot_audit(f: Feeds) -> DataFrame:
    documents = materialize(_documents(f))
    return snapshot.snapshot_audit(manifest_list(f, documents), landed_files(f, documents))


def snapshot_state(f: Feeds) -> DataFrame:
    documents = materialize(_documents(f))
    entries = materialize(manifest_list(f, documents))
    manifest = entries.agg(F.count(F.lit(1)).alias("entries")).select(
        F.lit(snapshot.MANIFEST_VERSION).alias("schema_version"),
        F.lit(PERIOD.label).alias("snapshot_id"),
        F.lit("2024-02-01T06:30:00+00:00").alias("created_at_utc"),
        F.array("entries").alias("artifacts"),
    )
    audit = snapshot.snapshot_audit(entries, landed_files(f, documents))
    broken = snapshot.manifest_rule_audit(entries).unionByName(snapshot.manifest_head_audit(manifest))
    return snapshot.snapshot_state(audit, manifest, PERIOD.label, broken)


# Time and distance

HALF_HOUR_ZONE = "Australia/Lord_Howe"


def local_clock_flags(f: Feeds) -> DataFrame:
    """Quarter hours on the ship dates, which pass every clock change of seven years: as clocks of the
    railway's zone, and of one that changes by half an hour."""
    quarter = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 96
    clock = F.timestamp_add("MINUTE", (quarter * 15).cast("int"), F.col("l_shipdate").cast("timestamp"))
    flagged = f.table("lineitem").select(clock.alias("clock"))
    clock = F.col("clock")
    ambiguous, skipped = is_ambiguous_local(clock), is_skipped_local(clock)
    return (
        flagged.groupBy("clock")
        .agg(F.count(F.lit(1)).alias("line_items"))
        .withColumns({"berlin": local_instants(clock), "half": local_instants(clock, HALF_HOUR_ZONE)})
        .select(
            "clock",
            "line_items",
            ambiguous.alias("is_ambiguous"),
            skipped.alias("is_skipped"),
            F.when(~ambiguous & ~skipped, local_to_utc(clock)).alias("instant"),
            F.col("berlin.first").alias("first_instant"),
            F.col("berlin.second").alias("second_instant"),
            F.col("half.first").alias("half_first_instant"),
            F.col("half.second").alias("half_second_instant"),
        )
    )


def text_clocks(f: Feeds) -> DataFrame:
    """Order times noted as text: a date and time, a nanosecond count, or nothing readable."""
    key = F.col("o_orderkey")
    clock = F.timestamp_add("MINUTE", (key * 37 % 1440).cast("int"), F.col("o_orderdate").cast("timestamp"))
    text = (
        F.when(key % 3 == 0, F.date_format(clock, "yyyy-MM-dd HH:mm:ss"))
        .when(key % 3 == 1, clock_to_nanos(clock).cast("string"))
        .otherwise(F.concat(F.lit("noted "), key % 7))
    )
    noted = f.table("orders").groupBy(text.alias("text")).agg(F.count(F.lit(1)).alias("orders"))
    return noted.withColumns({"clock": wall_clock(F.col("text"), TEXT), "nanos": raw_nanos(F.col("text"), TEXT)})


def haversine_pairs(f: Feeds) -> DataFrame:
    """Distance between customer and supplier for every pair that traded."""
    traded = (
        f.table("lineitem")
        .select("l_orderkey", "l_suppkey")
        .join(f.table("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "l_suppkey")
        .agg(F.count(F.lit(1)).alias("line_items"))
    )
    customer, supplier = F.col("o_custkey"), F.col("l_suppkey")
    km = haversine_km(
        feeds.station_lat(customer),
        feeds.station_lon(customer),
        feeds.sensor_lat(supplier),
        feeds.sensor_lon(supplier),
    )
    return traded.withColumn("distance_km", F.round(km, 6))


# Enrichment


def nearest_sensor_mapping(f: Feeds) -> DataFrame:
    return _rounded(f.mapping, "nearest_tu_dist_km", "nearest_ff_dist_km")


def stops_enriched(f: Feeds) -> DataFrame:
    return _rounded(f.gold, "nearest_tu_dist_km", "nearest_ff_dist_km")


# Quality


def expectation_report(f: Feeds) -> DataFrame:
    facts = fact_audit.rules_of(f.stops, f.enrich, PERIOD)
    return expectations.expectation_report(_small_tables(f), PERIOD).unionByName(fact_audit.rule_report(f.spark, facts))


def grain_audit(f: Feeds) -> DataFrame:
    """The stops' keys are kept narrow, so that the feed is parsed once for both facts."""
    stops = materialize(f.stops.select("id", "eva", "event_hour_utc"))
    tables = _small_tables(f)
    lookups = [tables[t] for t in ("stations", "station_weather_mapping", "temperature_hourly", "wind_hourly")]
    tables |= {"train_stops": stops, "train_stop_weather": with_context(stops, *lookups)}
    return grain.grain_audit({name: tables[name] for name in grain.GRAINS})


def audit_facts(f: Feeds) -> DataFrame:
    return fact_audit.audit_facts(f.stops, partial(f.enrich, flags=True), PERIOD)


def one_row_per_key(f: Feeds) -> DataFrame:
    return grain.one_row_per_key(f.table("lineitem"), ["l_orderkey", "l_linenumber"])


def row_preservation(f: Feeds) -> DataFrame:
    return fact_audit.preservation_of(f.stops, f.enrich)


def join_coverage(f: Feeds) -> DataFrame:
    return coverage.join_coverage(f.enrich(f.stops, flags=True))


def published_columns(f: Feeds) -> DataFrame:
    facts = fact_audit.values_of(f.stops, f.enrich)
    return contracts.published_columns(_small_tables(f)).unionByName(fact_audit.column_report(f.spark, facts))


# Analyses


def delay_baseline(f: Feeds) -> DataFrame:
    return delays.delay_summary(f.stops)


def delay_by_train_type(f: Feeds) -> DataFrame:
    return delays.delay_by_train_type(f.stops)


def delay_by_hour(f: Feeds) -> DataFrame:
    return delays.delay_by_hour(f.stops)


def delay_by_day(f: Feeds) -> DataFrame:
    return delays.delay_by_day(f.stops)


def delay_by_month(f: Feeds) -> DataFrame:
    return delays.delay_by_month(f.stops)


def delay_by_place(f: Feeds) -> DataFrame:
    return delays.delay_by_place(_located_stops(f))


def delay_hotspots(f: Feeds) -> DataFrame:
    return delays.delay_hotspots(_located_stops(f))


def delay_by_weather(f: Feeds) -> DataFrame:
    return delays.delay_by_weather(f.gold)


def match_by_day(f: Feeds) -> DataFrame:
    return coverage.match_by_day(f.enrich(f.stops, flags=True))


def missing_hours(f: Feeds) -> DataFrame:
    return coverage.missing_hours(f.stops, PERIOD)


def station_match_rate(f: Feeds) -> DataFrame:
    return coverage.station_match_rate(f.stops, f.stations)


def coordinate_extent(f: Feeds) -> DataFrame:
    return coverage.coordinate_extent(f.stations)


def distance_distribution(f: Feeds) -> DataFrame:
    return distances.distance_distribution(f.stations, f.weather_stations)


def joint_sensor_penalty(f: Feeds) -> DataFrame:
    return distances.joint_sensor_penalty(f.stations, f.weather_stations)


# Month-wise operation

MONTH = Period.month("1998-03")


def _monthly_orders(f: Feeds) -> DataFrame:
    return f.table("orders").withColumn("period", months.month_label(F.col("o_orderdate")))


def canonical_month(f: Feeds) -> DataFrame:
    orders = f.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return months.canonical_month(orders, "o_orderdate", MONTH)


def month_replace(f: Feeds) -> DataFrame:
    """The order archive after a corrected delivery of one month replaced it."""
    corrected = canonical_month(f).withColumns(
        {"o_totalprice": F.col("o_totalprice") * 2, "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")}
    )
    return months.replace_periods(_monthly_orders(f), corrected.where("o_orderstatus <> 'P'"), [MONTH.label])


def retention_window(f: Feeds) -> DataFrame:
    return months.retained_rows(_monthly_orders(f), "o_orderdate", "2001-07")


def month_over_month(f: Feeds) -> DataFrame:
    shipped = f.table("lineitem").withColumn("period", months.month_label(F.col("l_shipdate")))
    measures = {
        "line_items": F.count(F.lit(1)),
        "quantity": F.sum("l_quantity"),
        "parts": F.count_distinct("l_partkey"),
    }
    return months.month_over_month(shipped, measures, ["l_suppkey", "l_returnflag"])


def monthly_checks(f: Feeds) -> DataFrame:
    """Counts, grain, coverage and join rates of every month of orders beside those of the month before."""
    known = f.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("known"))
    orders = _monthly_orders(f).join(known, "o_custkey", "left")
    month = orders.groupBy("period", "o_orderkey").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("known") & (F.col("o_orderstatus") != "P")).alias("met"),
        F.min(F.dayofmonth("o_orderdate")).alias("day"),
    )
    counted = month.groupBy("period").agg(
        F.sum("rows").alias("rows"),
        (F.sum("rows") - F.count(F.lit(1))).alias("surplus"),
        F.sum("met").alias("met"),
        F.bit_count(F.bit_or(F.expr("shiftleft(1L, day)"))).alias("days"),
    )

    def check(kind: str, item: str, value: Column) -> Column:
        return F.struct(
            F.lit("orders").alias("table_name"),
            F.lit(kind).alias("kind"),
            F.lit(item).alias("item"),
            value.cast("double").alias("value"),
            F.lit(None).cast("string").alias("text"),
        )

    checks = counted.select(
        "period",
        F.inline(
            F.array(
                check("count", "rows", F.col("rows")),
                check("grain", "surplus_rows", F.col("surplus")),
                check("match", "customer", F.col("met") / F.col("rows")),
                check("coverage", "days", F.col("days")),
            )
        ),
    )
    return _rounded(compare_with_previous(materialize(checks)), "value", "previous_value", "change")


QUERIES: dict[str, Callable[[Feeds], DataFrame]] = {
    function.__name__: function
    for function in (
        stops_normalized,
        stations_flattened,
        api_archive_latest,
        api_archive_audit,
        fixed_width_listing,
        sensor_networks_merged,
        temperature_readings,
        wind_readings,
        source_header_audit,
        readings_by_header,
        source_coverage,
        key_overflow,
        manifest_inventory,
        manifest_rule_audit,
        snapshot_audit,
        snapshot_state,
        local_clock_flags,
        text_clocks,
        haversine_pairs,
        nearest_sensor_mapping,
        stops_enriched,
        expectation_report,
        grain_audit,
        audit_facts,
        one_row_per_key,
        row_preservation,
        join_coverage,
        published_columns,
        delay_baseline,
        delay_by_train_type,
        delay_by_hour,
        delay_by_day,
        delay_by_month,
        delay_by_place,
        delay_hotspots,
        delay_by_weather,
        match_by_day,
        missing_hours,
        station_match_rate,
        coordinate_extent,
        distance_distribution,
        joint_sensor_penalty,
        canonical_month,
        month_replace,
        retention_window,
        month_over_month,
        monthly_checks,
    )
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query; the session is set to UTC, which the time operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return at_edge(QUERIES[name](Feeds(spark, sf_dir)))
