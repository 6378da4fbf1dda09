"""The same results in SQL over the driver's tables, written without the operators."""

from __future__ import annotations

_RAW = """
feed AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(floor(value) - 5 AS INTEGER) AS delay,
           CAST(user_id * 4 + CASE WHEN event_type = 'error' THEN 2 ELSE 0 END AS VARCHAR) AS number
    FROM events
),
train_stops AS (
    SELECT
        'stop-' || event_id AS id,
        CASE WHEN length(number) < 8 THEN lpad(number, 8, '0') ELSE number END AS eva,
        'Stop ' || user_id AS station_name,
        'STOP ' || user_id AS xml_station_name,
        CAST(k AS VARCHAR) AS train_number,
        upper(event_type) AS train_type,
        CASE WHEN event_type <> 'view' THEN 'L' || k END AS line_number,
        'Stop ' || k AS final_destination_station,
        user_id || '-' || strftime(ts, '%Y%m%d') AS train_line_ride_id,
        k AS train_line_station_num,
        delay AS delay_in_min,
        CASE WHEN k <> 2 THEN event_type = 'signup' AND value > 60 ELSE FALSE END AS arrival_is_canceled,
        CASE WHEN k <> 3 THEN value > 180 ELSE FALSE END AS departure_is_canceled,
        CASE WHEN k <> 1 THEN date_trunc('second', ts) END AS event_time_local,
        CASE WHEN k <> 1 THEN epoch_us(ts) * 1000 END AS event_time_local_nanos,
        event_time_local AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' AS event_time_utc,
        date_trunc('hour', event_time_utc) AS event_hour_utc,
        (date_trunc('second', ts) - delay * INTERVAL 1 MINUTE)
            AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' AS arrival_planned_time_utc,
        date_trunc('second', ts) AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' AS arrival_change_time_utc,
        (date_trunc('second', ts) - (delay - 2) * INTERVAL 1 MINUTE)
            AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' AS departure_planned_time_utc,
        CASE WHEN event_type <> 'signup' THEN (date_trunc('second', ts) + INTERVAL 2 MINUTE)
            AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' END AS departure_change_time_utc
    FROM feed
    WHERE k <> 0
),
numbered AS (
    SELECT *, CAST(c_custkey * 4 AS VARCHAR) AS number, TRUE AS main, 0.0::DOUBLE AS shift FROM customer
    UNION ALL
    SELECT *, CAST(c_custkey * 4 + 1 AS VARCHAR), FALSE, 0.004::DOUBLE FROM customer WHERE c_mktsegment = 'BUILDING'
),
stations AS (
    SELECT
        CASE WHEN length(number) < 8 THEN lpad(number, 8, '0') ELSE number END AS eva,
        c_custkey AS station_number,
        c_name AS station_name,
        CASE WHEN c_acctbal >= 0 THEN 'R' || c_custkey END AS ds100,
        CAST(c_nationkey % 7 + 1 AS INTEGER) AS category,
        CAST(n_regionkey + 1 AS INTEGER) AS price_category,
        n_name AS federal_state,
        r_name AS regional_bereich,
        CASE WHEN c_acctbal > -950 THEN (47400 + (c_custkey * 7919) % 7500) / 1000.0::DOUBLE + shift END AS latitude,
        CASE WHEN c_acctbal > -950 THEN (6100 + (c_custkey * 104729) % 8900) / 1000.0::DOUBLE + shift END AS longitude,
        main AS is_main_eva
    FROM numbered
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
),
listing AS (
    SELECT
        CASE WHEN s_suppkey < 100000 THEN lpad(CAST(s_suppkey AS VARCHAR), 5, '0') ELSE CAST(s_suppkey AS VARCHAR) END AS dwd_station_id,
        CASE WHEN s_nationkey < 2 THEN 20240115 ELSE 19950101 END::BIGINT AS von_datum,
        CASE WHEN s_nationkey > 22 THEN 20231231 ELSE 20991231 END::BIGINT AS bis_datum,
        CASE WHEN s_acctbal > 0 THEN s_acctbal END AS altitude_m,
        (47400 + (s_suppkey * 3571) % 7500) / 1000.0::DOUBLE AS latitude,
        (6100 + (s_suppkey * 7907) % 8900) / 1000.0::DOUBLE AS longitude,
        s_name AS station_name,
        n_name AS federal_state,
        s_acctbal < 8000 AS has_temperature,
        s_acctbal >= 3000 AS has_wind
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
weather_stations AS (
    SELECT dwd_station_id, station_name, federal_state, altitude_m, latitude, longitude, has_temperature, has_wind
    FROM listing
    WHERE von_datum <= 20240101 AND bis_datum >= 20240131
),
stamped AS (
    SELECT *, (l_orderkey * 7 + l_partkey) % 756 AS slot FROM lineitem
),
per_hour AS (
    SELECT l_suppkey, slot, min(l_quantity) AS low, max(l_quantity) AS high,
           max(l_linenumber) AS lines, min(l_partkey) AS part
    FROM stamped GROUP BY ALL
),
in_month AS (
    SELECT *, CASE WHEN l_suppkey < 100000 THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0') ELSE CAST(l_suppkey AS VARCHAR) END AS dwd_station_id,
           TIMESTAMP '2023-12-31' + slot * INTERVAL 1 HOUR AS observation_hour_utc
    FROM per_hour
    WHERE slot >= 24 AND slot <> 100
),
temperature_hourly AS (
    SELECT dwd_station_id, observation_hour_utc,
           CASE WHEN lines <> 7 THEN low - 20 END AS temp_celsius,
           CASE WHEN low <> 1 THEN high * 2 END AS humidity_pct,
           CAST(CASE WHEN lines <> 1 THEN 3 END AS INTEGER) AS qn_9
    FROM in_month
),
wind_hourly AS (
    SELECT dwd_station_id, observation_hour_utc,
           CASE WHEN lines <> 7 THEN high / 4 END AS wind_speed_ms,
           CAST(CASE WHEN lines <> 6 THEN (part * 13) % 361 END AS INTEGER) AS wind_direction_deg,
           CAST(CASE WHEN lines <> 2 THEN 10 END AS INTEGER) AS qn_3
    FROM in_month
)
"""

_KM = """2 * 6371.0 * asin(sqrt(least(1.0, greatest(0.0,
    pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
    + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))"""

_PAIR_KM = _KM.format(lat1="st.latitude", lon1="st.longitude", lat2="ws.latitude", lon2="ws.longitude")

_MAPPING = f"""
candidates AS (
    SELECT eva, ws.dwd_station_id, has_temperature, has_wind, {_PAIR_KM} AS km
    FROM stations st CROSS JOIN weather_stations ws
    WHERE st.latitude IS NOT NULL
),
nearest AS (
    SELECT eva, network, dwd_station_id, km FROM (
        SELECT *, row_number() OVER (PARTITION BY eva, network ORDER BY km, dwd_station_id) AS rn
        FROM (
            SELECT eva, 'tu' AS network, dwd_station_id, km FROM candidates WHERE has_temperature
            UNION ALL
            SELECT eva, 'ff', dwd_station_id, km FROM candidates WHERE has_wind
            UNION ALL
            SELECT eva, 'joint', dwd_station_id, km FROM candidates WHERE has_temperature AND has_wind
        )
    ) WHERE rn = 1
),
station_weather_mapping AS (
    SELECT tu.eva, tu.dwd_station_id AS nearest_tu_station_id, tu.km AS nearest_tu_dist_km,
           ff.dwd_station_id AS nearest_ff_station_id, ff.km AS nearest_ff_dist_km
    FROM nearest tu JOIN nearest ff ON tu.eva = ff.eva AND tu.network = 'tu' AND ff.network = 'ff'
)
"""

_GOLD = """
train_stop_weather AS (
    SELECT
        ts.id, ts.eva, coalesce(st.station_name, ts.station_name) AS station_name,
        st.category, st.price_category, st.federal_state,
        ts.train_type, ts.train_number, ts.line_number, ts.final_destination_station,
        ts.train_line_ride_id, ts.train_line_station_num,
        ts.event_time_local, ts.event_time_utc, ts.event_hour_utc,
        ts.delay_in_min, ts.arrival_is_canceled, ts.departure_is_canceled,
        tu.temp_celsius, tu.humidity_pct, tu.qn_9 AS qn_tu,
        mp.nearest_tu_station_id, mp.nearest_tu_dist_km,
        ff.wind_speed_ms, ff.wind_direction_deg, ff.qn_3 AS qn_ff,
        mp.nearest_ff_station_id, mp.nearest_ff_dist_km
    FROM train_stops ts
    LEFT JOIN stations st ON ts.eva = st.eva
    LEFT JOIN station_weather_mapping mp ON ts.eva = mp.eva
    LEFT JOIN temperature_hourly tu
        ON mp.nearest_tu_station_id = tu.dwd_station_id AND ts.event_hour_utc = tu.observation_hour_utc
    LEFT JOIN wind_hourly ff
        ON mp.nearest_ff_station_id = ff.dwd_station_id AND ts.event_hour_utc = ff.observation_hour_utc
)
"""

_FLAGGED = """
flagged AS (
    SELECT ts.event_hour_utc, st.eva IS NOT NULL AS found_station, mp.nearest_tu_station_id IS NOT NULL AS temperature_sensor, mp.nearest_ff_station_id IS NOT NULL AS wind_sensor,
           tu.dwd_station_id IS NOT NULL AS found_temperature, ff.dwd_station_id IS NOT NULL AS found_wind,
           tu.temp_celsius IS NOT NULL AS temperature_value, ff.wind_speed_ms IS NOT NULL AS wind_value
    FROM train_stops ts
    LEFT JOIN stations st ON ts.eva = st.eva
    LEFT JOIN station_weather_mapping mp ON ts.eva = mp.eva
    LEFT JOIN temperature_hourly tu
        ON mp.nearest_tu_station_id = tu.dwd_station_id AND ts.event_hour_utc = tu.observation_hour_utc
    LEFT JOIN wind_hourly ff
        ON mp.nearest_ff_station_id = ff.dwd_station_id AND ts.event_hour_utc = ff.observation_hour_utc
)
"""

_FILES = """
landed AS (
    SELECT 'texts/' || doc_id || '.txt' AS relative_path, CAST(strlen(text) AS BIGINT) AS byte_size,
           sha256(text) AS sha256
    FROM documents
    UNION ALL
    SELECT 'talks/' || conv_id || '/' || turn, CAST(strlen(text) AS BIGINT), sha256(text) FROM conversations
),
label AS (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
manifest AS (
    SELECT
        CASE lang WHEN 'fr' THEN '/' WHEN 'es' THEN 'texts/../' ELSE '' END
            || 'texts/' || d.doc_id || '.txt' AS relative_path,
        CAST(strlen(text) + CASE WHEN quality = 0 THEN 1 ELSE 0 END AS BIGINT) AS byte_size,
        CASE WHEN toxic = 1 THEN sha256(text || 'x') ELSE sha256(text) END AS sha256,
        CASE WHEN toxic = 1 THEN 'notes' ELSE 'dwd_observation_txt' END AS role,
        CASE quality WHEN 1 THEN sha256(text) WHEN 0 THEN sha256('nothing') END AS parent
    FROM documents d LEFT JOIN label l ON d.doc_id = l.doc_id
    UNION ALL
    SELECT 'pages/' || page_id, CAST(strlen(html) - 5000 AS BIGINT), left(sha256(html), 60), 'dwd_metadata', NULL
    FROM pages
),
audit AS (
    SELECT coalesce(m.relative_path, f.relative_path) AS relative_path,
           m.byte_size AS expected_bytes, f.byte_size AS actual_bytes,
           CASE WHEN f.relative_path IS NULL THEN 'missing'
                WHEN m.relative_path IS NULL THEN 'unlisted'
                WHEN f.byte_size <> m.byte_size THEN 'size mismatch'
                WHEN f.sha256 <> m.sha256 THEN 'digest mismatch'
                ELSE 'ok' END AS status
    FROM manifest m FULL JOIN landed f ON m.relative_path = f.relative_path
)
"""

_BROKEN = """
broken_rule AS (
    SELECT relative_path, 'absolute_path' AS rule FROM manifest WHERE starts_with(relative_path, '/')
    UNION ALL
    SELECT relative_path, 'path_leaves_root' FROM manifest WHERE contains('/' || relative_path || '/', '/../')
    UNION ALL
    SELECT relative_path, 'negative_size' FROM manifest WHERE byte_size < 0
    UNION ALL
    SELECT relative_path, 'bad_digest' FROM manifest WHERE length(sha256) <> 64
    UNION ALL
    SELECT relative_path, 'unknown_role' FROM manifest WHERE role = 'notes'
    UNION ALL
    SELECT relative_path, 'duplicate_path' FROM manifest GROUP BY relative_path HAVING count(*) > 1
    UNION ALL
    SELECT relative_path, 'parent_not_listed' FROM manifest
    WHERE parent IS NOT NULL AND parent NOT IN (SELECT sha256 FROM manifest)
)
"""

_RESPONSES = """
responses AS (
    SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_totalprice,
           o_orderpriority <> '4-NOT SPECIFIED' AND o_orderstatus <> 'P' AND o_totalprice >= 10000 AS accepted,
           o_totalprice >= 30000 AS usable, o_totalprice >= 40000 AS readable
    FROM orders
)
"""

_LINES = """
lines AS (
    SELECT 'produkt_tu_stunde_' || l_suppkey || '.txt' AS file, slot, l_suppkey,
           lpad(CAST(l_suppkey AS VARCHAR), 11, ' ') AS sensor,
           CASE WHEN slot = 100 THEN '2024010599'
                ELSE strftime(TIMESTAMP '2023-12-31' + slot * INTERVAL 1 HOUR, '%Y%m%d%H') END AS stamp,
           CASE WHEN lines = 1 THEN '-999' ELSE '3' END AS qn,
           CASE WHEN lines = 7 THEN '-999.0' ELSE CAST(low - 20 AS VARCHAR) END AS tt,
           CASE WHEN low = 1 THEN '-999' ELSE CAST(high * 2 AS VARCHAR) END AS rf
    FROM per_hour
)
"""

_ADDITIVE = """
    count(*) AS stops, count(delay_in_min) AS timed_stops, CAST(sum(delay_in_min) AS BIGINT) AS delay_min,
    count(*) FILTER (WHERE delay_in_min > 5) AS late_stops,
    count(*) FILTER (WHERE arrival_is_canceled OR departure_is_canceled) AS cancelled_stops
"""

_RATES = """
    stops, late_stops, cancelled_stops,
    round(delay_min / timed_stops, 6) AS mean_delay,
    round(late_stops / timed_stops, 6) AS late_share,
    round(cancelled_stops / stops, 6) AS cancelled_share
"""

_SPREAD = """
    round(quantile_cont(CAST(delay_in_min AS DOUBLE), 0.5), 6) AS median_delay,
    round(quantile_cont(CAST(delay_in_min AS DOUBLE), 0.9), 6) AS p90_delay,
    max(delay_in_min) AS max_delay
"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts)


def _summary(source: str, group: str = "", name: str = "", parts: tuple[str, ...] = (_RAW,)) -> str:
    head = f"{group} AS {name}, " if group else ""
    lead = f"{name}, " if group else ""
    tail = "GROUP BY ALL" if group else ""
    return f"""{_with(*parts)},
    grouped AS (SELECT {head} {_ADDITIVE}, {_SPREAD} FROM {source} {tail})
    SELECT {lead} {_RATES}, median_delay, p90_delay, max_delay FROM grouped"""


_MET = {
    "station": "found_station",
    "temperature_sensor": "temperature_sensor",
    "wind_sensor": "wind_sensor",
    "temperature": "found_temperature",
    "wind": "found_wind",
    "temperature_value": "temperature_value",
    "wind_value": "wind_value",
}

_COVERAGE = ", ".join(
    ["count(*) AS stops"]
    + [f"round(avg(CASE WHEN {flag} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS {name}_share" for name, flag in _MET.items()]
)

# What each published table must hold, written out here and not taken from the rules.
_RULES = {
    "stations": {
        "valid_eva": "eva SIMILAR TO '[0-9]{8}'",
        "valid_coordinates": "abs(latitude) <= 90 AND abs(longitude) <= 180",
    },
    "weather_stations": {
        "valid_dwd_station_id": "dwd_station_id SIMILAR TO '[0-9]{5}'",
        "has_observation_capability": "has_temperature OR has_wind",
    },
    "station_weather_mapping": {
        "valid_mapping_eva": "eva SIMILAR TO '[0-9]{8}'",
        "valid_mapping_station_ids": "nearest_tu_station_id SIMILAR TO '[0-9]{5}' AND nearest_ff_station_id SIMILAR TO '[0-9]{5}'",
        "valid_mapping_distances": "least(nearest_tu_dist_km, nearest_ff_dist_km) >= 0",
    },
    "temperature_hourly": {
        "valid_tu_station_id": "dwd_station_id SIMILAR TO '[0-9]{5}'",
        "valid_tu_hour": "date_trunc('month', observation_hour_utc) = TIMESTAMP '2024-01-01'",
        "valid_humidity": "coalesce(humidity_pct, 0) BETWEEN 0 AND 100",
    },
    "wind_hourly": {
        "valid_ff_station_id": "dwd_station_id SIMILAR TO '[0-9]{5}'",
        "valid_ff_hour": "date_trunc('month', observation_hour_utc) = TIMESTAMP '2024-01-01'",
        "valid_wind_speed": "coalesce(wind_speed_ms, 0) >= 0",
        "valid_wind_direction": "coalesce(wind_direction_deg, 0) BETWEEN 0 AND 360",
    },
    "train_stops": {
        "valid_stop_id": "trim(id) <> ''",
        "valid_eva": "eva SIMILAR TO '[0-9]{8}'",
        "valid_event_hour": "event_hour_utc IS NOT NULL",
    },
    "train_stop_weather": {
        "valid_gold_id": "trim(id) <> ''",
        "valid_gold_eva": "eva SIMILAR TO '[0-9]{8}'",
        "valid_gold_hour": "event_hour_utc IS NOT NULL",
        "has_sensor_mapping": "nearest_tu_station_id IS NOT NULL AND nearest_ff_station_id IS NOT NULL",
    },
}


def _expectation_report() -> str:
    rows = [
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) AS row_count, "
        f"count(*) FILTER (WHERE ({holds}) IS NOT TRUE) AS violations FROM {table}"
        for table, rules in _RULES.items()
        for rule, holds in rules.items()
    ]
    return _with(_RAW, _MAPPING, _GOLD) + " " + " UNION ALL ".join(rows)


def _grain_audit() -> str:
    grains = {
        "stations": "eva",
        "station_weather_mapping": "eva",
        "temperature_hourly": "dwd_station_id, observation_hour_utc",
        "wind_hourly": "dwd_station_id, observation_hour_utc",
        "train_stops": "id",
        "train_stop_weather": "id",
    }
    rows = [
        f"SELECT '{t}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys, "
        f"count(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(sum(n) - count(*) AS BIGINT) AS surplus_rows "
        f"FROM (SELECT count(*) AS n FROM {t} GROUP BY {key})"
        for t, key in grains.items()
    ]
    return _with(_RAW, _MAPPING, _GOLD) + " " + " UNION ALL ".join(rows)


# The published columns in order, written out here and not taken from the contracts. Fixed values.
_COLUMNS = {
    "stations": "eva string, station_number bigint, station_name string, ds100 string, category int, "
    "price_category int, federal_state string, regional_bereich string, latitude double, longitude double, "
    "is_main_eva boolean",
    "weather_stations": "dwd_station_id string, station_name string, federal_state string, altitude_m double, "
    "latitude double, longitude double, has_temperature boolean, has_wind boolean",
    "station_weather_mapping": "eva string, nearest_tu_station_id string, nearest_tu_dist_km double, "
    "nearest_ff_station_id string, nearest_ff_dist_km double",
    "temperature_hourly": "dwd_station_id string, observation_hour_utc timestamp, temp_celsius double, "
    "humidity_pct double, qn_9 int",
    "wind_hourly": "dwd_station_id string, observation_hour_utc timestamp, wind_speed_ms double, "
    "wind_direction_deg int, qn_3 int",
    "train_stops": "id string, eva string, station_name string, xml_station_name string, train_number string, "
    "train_type string, line_number string, final_destination_station string, train_line_ride_id string, "
    "train_line_station_num int, delay_in_min int, arrival_is_canceled boolean, departure_is_canceled boolean, "
    "event_time_local timestamp, event_time_local_nanos bigint, event_time_utc timestamp, event_hour_utc timestamp, "
    "arrival_planned_time_utc timestamp, arrival_change_time_utc timestamp, departure_planned_time_utc timestamp, "
    "departure_change_time_utc timestamp",
    "train_stop_weather": "id string, eva string, station_name string, category int, price_category int, "
    "federal_state string, train_type string, train_number string, line_number string, "
    "final_destination_station string, train_line_ride_id string, train_line_station_num int, "
    "event_time_local timestamp, event_time_utc timestamp, event_hour_utc timestamp, delay_in_min int, "
    "arrival_is_canceled boolean, departure_is_canceled boolean, temp_celsius double, humidity_pct double, "
    "qn_tu int, nearest_tu_station_id string, nearest_tu_dist_km double, wind_speed_ms double, "
    "wind_direction_deg int, qn_ff int, nearest_ff_station_id string, nearest_ff_dist_km double",
}


def _published_columns() -> str:
    rows = [
        f"SELECT '{table}' AS table_name, {position} AS position, '{column.split()[0]}' AS column_name, "
        f"'{column.split()[1]}' AS data_type, count(*) AS row_count, count({column.split()[0]}) AS value_count FROM {table}"
        for table, columns in _COLUMNS.items()
        for position, column in enumerate(columns.split(", "), start=1)
    ]
    return _with(_RAW, _MAPPING, _GOLD) + " " + " UNION ALL ".join(rows)


def _audit_facts() -> str:
    facts = ("train_stops", "train_stop_weather")
    rows = [
        f"SELECT 'expectation' AS audit, '{t}' AS table_name, '{rule}' AS item, count(*) AS row_count, "
        f"count(*) FILTER (WHERE ({holds}) IS NOT TRUE) AS value FROM {t}"
        for t in facts
        for rule, holds in _RULES[t].items()
    ]
    rows += [
        f"SELECT 'column', '{t}', '{column.split()[0]}', count(*), count({column.split()[0]}) FROM {t}"
        for t in facts
        for column in _COLUMNS[t].split(", ")
    ]
    rows += [f"SELECT 'match', 'train_stop_weather', '{name}', count(*), count(*) FILTER (WHERE {flag}) FROM flagged" for name, flag in _MET.items()]
    rows.append(
        "SELECT 'preservation', 'train_stop_weather', 'rows', (SELECT count(*) FROM train_stop_weather), count(*) FROM train_stops"
    )
    return _with(_RAW, _MAPPING, _GOLD, _FLAGGED) + " " + " UNION ALL ".join(rows)


def _select(source: str, *parts: str, columns: str = "*") -> str:
    return f"{_with(*parts)} SELECT {columns} FROM {source}"


_KM_COLUMNS = (
    "* REPLACE (round(nearest_tu_dist_km, 6) AS nearest_tu_dist_km, "
    "round(nearest_ff_dist_km, 6) AS nearest_ff_dist_km)"
)

_CLOCK = "(ck AT TIME ZONE 'Europe/Berlin')"


def _shown(zone: str, change: int) -> str:
    """The instants that show the clock, in order: the one the engine takes, and those one change off."""
    instant = f"(ck AT TIME ZONE '{zone}')"
    tried = [instant, f"({instant} - INTERVAL {change} MINUTE)", f"({instant} + INTERVAL {change} MINUTE)"]
    kept = ", ".join(f"CASE WHEN {u} AT TIME ZONE '{zone}' = ck THEN {u} END" for u in tried)
    return f"list_sort(list_filter([{kept}], lambda u: u IS NOT NULL))"

ORACLE: dict[str, str] = {
    "stops_normalized": _select("train_stops", _RAW),
    "stations_flattened": _select("stations", _RAW),
    "api_archive_latest": f"""{_with(_RESPONSES)},
        listed AS (
            SELECT o_custkey AS number, o_orderpriority AS name, CAST(o_orderkey % 7 AS INTEGER) AS category,
                   o_orderkey, 0 AS position
            FROM responses WHERE accepted AND readable
            UNION ALL
            SELECT o_custkey + 1, o_orderstatus, CAST(o_orderkey % 7 AS INTEGER), o_orderkey, 1
            FROM responses WHERE accepted AND readable
        )
        SELECT number, name, category FROM (
            SELECT *, row_number() OVER (PARTITION BY number ORDER BY o_orderkey DESC, position DESC) AS rn
            FROM listed
        ) WHERE rn = 1""",
    "api_archive_audit": f"""{_with(_RESPONSES)}
        SELECT count(*) AS responses, count(*) FILTER (WHERE accepted) AS accepted,
               count(*) FILTER (WHERE accepted AND NOT usable) AS malformed,
               CAST(2 * count(*) FILTER (WHERE accepted AND usable) AS BIGINT) AS stations_listed,
               count(*) FILTER (WHERE accepted AND usable AND NOT readable) AS unreadable_numbers,
               count(*) FILTER (WHERE accepted AND NOT readable) = 0
                   AND count(*) FILTER (WHERE accepted AND readable) > 0 AS usable
        FROM responses""",
    "fixed_width_listing": _select(
        "listing WHERE has_temperature",
        _RAW,
        columns="dwd_station_id, von_datum, bis_datum, altitude_m, latitude, longitude, station_name, federal_state",
    ),
    "sensor_networks_merged": _select("weather_stations", _RAW),
    "temperature_readings": _select("temperature_hourly", _RAW),
    "wind_readings": _select("wind_hourly", _RAW),
    "source_header_audit": f"""{_with(_RAW, _LINES)},
        files AS (
            SELECT file, l_suppkey, count(*) AS readings,
                   count(*) FILTER (WHERE slot >= 24 AND slot <> 100) AS in_period
            FROM lines GROUP BY ALL
        ),
        headed AS (
            SELECT 'produkt_tu_stunde_' || s_suppkey || '.txt' AS file, s_nationkey FROM supplier
            WHERE s_nationkey <> 9
        )
        SELECT coalesce(f.file, h.file) AS file, s_nationkey IS NOT NULL AS has_header,
               CASE WHEN s_nationkey IS NULL THEN 'STATIONS_ID,MESS_DATUM,QN_9,TT_TU,RF_TU'
                    WHEN s_nationkey = 5 THEN 'RF_TU' ELSE '' END AS missing_fields,
               coalesce(s_nationkey = 7, FALSE) AS order_differs,
               coalesce(readings, 0) AS readings, coalesce(in_period, 0) AS in_period,
               coalesce(in_period, 0) > 0 AS covers_period
        FROM files f FULL JOIN headed h ON f.file = h.file""",
    "readings_by_header": f"""{_with(_RAW, _LINES)}
        SELECT file, trim(sensor) AS "STATIONS_ID", stamp AS "MESS_DATUM", qn AS "QN_9",
               CASE WHEN s_nationkey = 7 THEN rf ELSE tt END AS "TT_TU",
               CASE WHEN s_nationkey = 7 THEN tt WHEN s_nationkey = 5 THEN NULL ELSE rf END AS "RF_TU"
        FROM lines JOIN supplier ON l_suppkey = s_suppkey
        WHERE s_nationkey <> 9""",
    "source_coverage": f"""{_with(_RAW)}
        SELECT count(*) AS row_count,
               count(*) FILTER (WHERE k <> 1 AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01') AS in_period,
               count(*) FILTER (WHERE k <> 1 AND ts < TIMESTAMP '2024-01-01') AS before_period,
               count(*) FILTER (WHERE k <> 1 AND ts >= TIMESTAMP '2024-02-01') AS after_period,
               count(*) FILTER (WHERE k = 1) AS without_time
        FROM feed""",
    "key_overflow": f"""{_with(_RAW)}
        SELECT count(*) AS row_count,
               count(*) FILTER (WHERE k <> 0 AND user_id * 4 + CASE WHEN event_type = 'error' THEN 2 ELSE 0 END > 999) AS too_long
        FROM feed""",
    "manifest_inventory": _select("landed", _FILES),
    "manifest_rule_audit": _select("broken_rule", _FILES, _BROKEN),
    "snapshot_audit": _select("audit", _FILES),
    "snapshot_state": f"""{_with(_FILES, _BROKEN)}
        SELECT count(*) FILTER (WHERE status <> 'missing') AS files,
               count(*) FILTER (WHERE status IN ('missing', 'size mismatch', 'digest mismatch')) AS damaged,
               count(*) FILTER (WHERE status = 'unlisted') AS unlisted,
               (SELECT count(*) FROM broken_rule) AS broken_rules,
               CASE WHEN (SELECT count(*) FROM broken_rule) > 0 THEN 'INCOMPLETE'
                    WHEN damaged > 0 THEN 'CORRUPTED' ELSE 'VALID' END AS state
        FROM audit""",
    "local_clock_flags": f"""
        WITH clocks AS (
            SELECT l_shipdate + ((l_orderkey * 37 + l_linenumber * 11) % 96) * INTERVAL 15 MINUTE AS ck,
                   count(*) AS line_items
            FROM lineitem GROUP BY ALL
        ),
        flagged AS (
            SELECT ck, line_items,
                ({_CLOCK} + INTERVAL 1 HOUR) AT TIME ZONE 'Europe/Berlin' = ck
                    OR ({_CLOCK} - INTERVAL 1 HOUR) AT TIME ZONE 'Europe/Berlin' = ck AS is_ambiguous,
                {_CLOCK} AT TIME ZONE 'Europe/Berlin' <> ck AS is_skipped,
                {_CLOCK} AT TIME ZONE 'UTC' AS instant,
                {_shown("Europe/Berlin", 60)} AS berlin,
                {_shown("Australia/Lord_Howe", 30)} AS half
            FROM clocks
        )
        SELECT ck AS clock, line_items, is_ambiguous, is_skipped,
               CASE WHEN NOT is_ambiguous AND NOT is_skipped THEN instant END AS instant,
               berlin[1] AT TIME ZONE 'UTC' AS first_instant, berlin[2] AT TIME ZONE 'UTC' AS second_instant,
               half[1] AT TIME ZONE 'UTC' AS half_first_instant, half[2] AT TIME ZONE 'UTC' AS half_second_instant
        FROM flagged""",
    "haversine_pairs": f"""
        WITH traded AS (
            SELECT o_custkey, l_suppkey, count(*) AS line_items
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
        ),
        placed AS (
            SELECT *,
                (47400 + (o_custkey * 7919) % 7500) / 1000.0::DOUBLE AS lat1,
                (6100 + (o_custkey * 104729) % 8900) / 1000.0::DOUBLE AS lon1,
                (47400 + (l_suppkey * 3571) % 7500) / 1000.0::DOUBLE AS lat2,
                (6100 + (l_suppkey * 7907) % 8900) / 1000.0::DOUBLE AS lon2
            FROM traded
        )
        SELECT o_custkey, l_suppkey, line_items,
               round({_KM.format(lat1="lat1", lon1="lon1", lat2="lat2", lon2="lon2")}, 6) AS distance_km
        FROM placed""",
    "nearest_sensor_mapping": _select("station_weather_mapping", _RAW, _MAPPING, columns=_KM_COLUMNS),
    "stops_enriched": _select("train_stop_weather", _RAW, _MAPPING, _GOLD, columns=_KM_COLUMNS),
    "expectation_report": _expectation_report(),
    "grain_audit": _grain_audit(),
    "one_row_per_key": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, l_shipdate
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                         l_returnflag, l_linestatus, l_shipdate) AS rn
            FROM lineitem
        ) WHERE rn = 1""",
    "row_preservation": f"""{_with(_RAW, _MAPPING, _GOLD)}
        SELECT rows_before, rows_after, rows_before = rows_after AS preserved
        FROM (SELECT count(*) AS rows_before FROM train_stops),
             (SELECT count(*) AS rows_after FROM train_stop_weather)""",
    "join_coverage": _select("flagged", _RAW, _MAPPING, _FLAGGED, columns=_COVERAGE),
    "audit_facts": _audit_facts(),
    "published_columns": _published_columns(),
    "delay_baseline": _summary("train_stops"),
    "delay_by_train_type": _summary("train_stops", "train_type", "train_type"),
    "delay_by_hour": _summary("train_stops", "CAST(hour(event_time_local) AS INTEGER)", "local_hour"),
    "delay_by_day": _summary("train_stops", "date_trunc('day', event_time_local)", "local_day"),
    "delay_by_month": _summary("train_stops", "strftime(event_time_local, '%Y-%m')", "local_month"),
    "text_clocks": """
        WITH noted AS (
            SELECT o_orderkey AS k, o_orderdate + ((o_orderkey * 37) % 1440) * INTERVAL 1 MINUTE AS moment FROM orders
        ),
        texts AS (
            SELECT CASE k % 3 WHEN 0 THEN strftime(moment, '%Y-%m-%d %H:%M:%S')
                        WHEN 1 THEN CAST(epoch_us(moment) * 1000 AS VARCHAR) ELSE 'noted ' || (k % 7) END AS text,
                   CASE WHEN k % 3 < 2 THEN moment END AS moment
            FROM noted
        )
        SELECT text, count(*) AS orders, any_value(moment) AS clock, epoch_us(any_value(moment)) * 1000 AS nanos
        FROM texts GROUP BY text""",
    "delay_by_place": f"""{_with(_RAW)},
        grouped AS (
            SELECT CAST(grouping(federal_state, ts.eva) AS BIGINT) AS level, federal_state, ts.eva, {_ADDITIVE}
            FROM train_stops ts LEFT JOIN stations st ON ts.eva = st.eva
            GROUP BY ROLLUP (federal_state, ts.eva)
        )
        SELECT level, federal_state, eva, {_RATES} FROM grouped""",
    "delay_hotspots": f"""{_with(_RAW)},
        per_day AS (
            SELECT federal_state, ts.eva, CAST(hour(event_time_local) AS INTEGER) AS local_hour,
                   CAST(event_time_local AS DATE) AS local_day, {_ADDITIVE}
            FROM train_stops ts LEFT JOIN stations st ON ts.eva = st.eva
            WHERE event_time_local IS NOT NULL
            GROUP BY ALL
        ),
        per_hour_of_day AS (
            SELECT federal_state, eva, local_hour, count(*) AS days,
                   count(*) FILTER (WHERE delay_min > 5 * timed_stops) AS late_days,
                   CAST(sum(stops) AS BIGINT) AS stops, CAST(sum(late_stops) AS BIGINT) AS late_stops
            FROM per_day GROUP BY ALL
        )
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY federal_state
                ORDER BY late_days DESC, late_stops DESC, eva, local_hour) AS INTEGER) AS place
            FROM per_hour_of_day
        ) WHERE place <= 3""",
    "delay_by_weather": f"""{_with(_RAW, _MAPPING, _GOLD)},
        usable AS (
            SELECT delay_in_min, arrival_is_canceled, departure_is_canceled,
                   CASE WHEN nearest_tu_dist_km <= 25 AND qn_tu IS NOT NULL THEN temp_celsius END AS t,
                   CASE WHEN nearest_ff_dist_km <= 25 AND qn_ff IS NOT NULL THEN wind_speed_ms END AS w
            FROM train_stop_weather
        ),
        grouped AS (
            SELECT CASE WHEN t IS NULL THEN 'unknown' WHEN t < 0 THEN 'below 0 C' WHEN t < 10 THEN '0 to 10 C'
                        WHEN t < 20 THEN '10 to 20 C' ELSE '20 C and above' END AS temperature_band,
                   CASE WHEN w IS NULL THEN 'unknown' WHEN w < 5 THEN 'below 5 m/s' WHEN w < 10 THEN '5 to 10 m/s'
                        ELSE '10 m/s and above' END AS wind_band,
                   {_ADDITIVE}, {_SPREAD}
            FROM usable GROUP BY ALL
        )
        SELECT temperature_band, wind_band, {_RATES}, median_delay, p90_delay, max_delay FROM grouped""",
    "match_by_day": f"""{_with(_RAW, _MAPPING, _FLAGGED)}
        SELECT date_trunc('day', event_hour_utc) AS day, {_COVERAGE} FROM flagged GROUP BY ALL""",
    "missing_hours": f"""{_with(_RAW)}
        SELECT h AS event_hour_utc
        FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR) AS t(h)
        WHERE NOT EXISTS (SELECT 1 FROM train_stops WHERE event_hour_utc = h)""",
    "station_match_rate": f"""{_with(_RAW)},
        matched AS (
            SELECT ts.eva, st.eva IS NOT NULL AS hit
            FROM train_stops ts LEFT JOIN (SELECT DISTINCT eva FROM stations) st ON ts.eva = st.eva
        )
        SELECT count(*) AS stops, count(*) FILTER (WHERE hit) AS matched_stops,
               count(DISTINCT eva) AS evas, count(DISTINCT eva) FILTER (WHERE hit) AS matched_evas,
               round(matched_stops / stops, 6) AS stop_share, round(matched_evas / evas, 6) AS eva_share
        FROM matched""",
    "coordinate_extent": f"""{_with(_RAW)}
        SELECT count(*) AS stations, count(latitude) AS located, min(latitude) AS south, max(latitude) AS north,
               min(longitude) AS west, max(longitude) AS east
        FROM stations""",
    "distance_distribution": f"""{_with(_RAW, _MAPPING)}
        SELECT network, count(*) AS stations,
               round(quantile_cont(km, 0.5), 6) AS median_km,
               round(quantile_cont(km, 0.9), 6) AS p90_km,
               round(quantile_cont(km, 0.95), 6) AS p95_km,
               round(max(km), 6) AS max_km,
               round(count(*) FILTER (WHERE km <= 25) / count(*), 6) AS near_share
        FROM nearest WHERE network <> 'joint' GROUP BY network""",
    "joint_sensor_penalty": f"""{_with(_RAW, _MAPPING)}
        SELECT count(*) AS stations,
               round(count(*) FILTER (WHERE t.dwd_station_id = f.dwd_station_id) / count(*), 6) AS same_site_share,
               round(avg(j.km - t.km), 6) AS mean_extra_tu_km, round(max(j.km - t.km), 6) AS max_extra_tu_km,
               round(avg(j.km - f.km), 6) AS mean_extra_ff_km, round(max(j.km - f.km), 6) AS max_extra_ff_km
        FROM nearest t
        JOIN nearest f ON t.eva = f.eva AND f.network = 'ff'
        JOIN nearest j ON t.eva = j.eva AND j.network = 'joint'
        WHERE t.network = 'tu'""",
    "canonical_month": """
        SELECT *, '1998-03' AS period FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01'""",
    "month_replace": """
        SELECT * REPLACE (CASE WHEN period = '1998-03' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice)
        FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS period FROM orders)
        WHERE period <> '1998-03' OR o_orderstatus <> 'P'""",
    "retention_window": """
        SELECT * FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS period FROM orders)
        WHERE o_orderdate >= TIMESTAMP '2000-08-01' AND o_orderdate < TIMESTAMP '2001-08-01'""",
    "monthly_checks": """
        WITH known AS (
            SELECT strftime(o_orderdate, '%Y-%m') AS period, year(o_orderdate) * 12 + month(o_orderdate) AS m,
                   o_orderkey, day(o_orderdate) AS d, o_orderstatus <> 'P' AND c_custkey IS NOT NULL AS met
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        ),
        counted AS (
            SELECT period, m, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) - count(DISTINCT o_orderkey) AS DOUBLE) AS surplus,
                   count(*) FILTER (WHERE met) / count(*) AS met, CAST(count(DISTINCT d) AS DOUBLE) AS days
            FROM known GROUP BY ALL
        ),
        checked AS (
            SELECT period, m, 'count' AS kind, 'rows' AS item, n AS value FROM counted
            UNION ALL SELECT period, m, 'grain', 'surplus_rows', surplus FROM counted
            UNION ALL SELECT period, m, 'match', 'customer', met FROM counted
            UNION ALL SELECT period, m, 'coverage', 'days', days FROM counted
        )
        SELECT c.period, 'orders' AS table_name, c.kind, c.item, round(c.value, 6) AS value,
               round(p.value, 6) AS previous_value, round(c.value - p.value, 6) AS change,
               CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS previous_text, FALSE AS differs
        FROM checked c JOIN checked p ON p.m = c.m - 1 AND p.kind = c.kind""",
    "month_over_month": """
        WITH monthly AS (
            SELECT l_suppkey, l_returnflag, strftime(l_shipdate, '%Y-%m') AS period, count(*) AS line_items,
                   sum(l_quantity) AS quantity, count(DISTINCT l_partkey) AS parts
            FROM lineitem GROUP BY ALL
        )
        SELECT now.*, before.line_items AS previous_line_items, before.quantity AS previous_quantity,
               before.parts AS previous_parts, now.line_items - before.line_items AS line_items_change,
               now.quantity - before.quantity AS quantity_change, now.parts - before.parts AS parts_change
        FROM monthly now LEFT JOIN monthly before
          ON before.l_suppkey = now.l_suppkey AND before.l_returnflag = now.l_returnflag
         AND before.period = strftime(CAST(now.period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')""",
}
