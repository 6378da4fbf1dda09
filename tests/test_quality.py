import hashlib

import pytest
from pyspark.sql import functions as F

from railctx.contracts import CONTRACTS, Contract, conform, contract_diff, create_table, index_contracts, published_columns
from railctx.period import Period
from railctx.quality import coverage, expectations, grain, snapshot

JUNE = Period.month("2026-06")


# Contracts


def test_seven_tables_with_83_columns():
    assert list(CONTRACTS) == [
        "stations",
        "weather_stations",
        "station_weather_mapping",
        "temperature_hourly",
        "wind_hourly",
        "train_stops",
        "train_stop_weather",
    ]
    assert [len(c.columns) for c in CONTRACTS.values()] == [11, 8, 5, 5, 5, 21, 28]
    assert CONTRACTS["stations"].published_name == "stations"
    assert CONTRACTS["train_stop_weather"].published_name == "gold.train_stop_weather"


def test_comments_are_quoted_and_kept():
    contract = Contract("t", "silver", "A table", (("a", "int", "The station's number"),))
    assert contract.ddl == "a INT COMMENT 'The station''s number'"
    assert contract.struct["a"].metadata == {"comment": "The station's number"}


@pytest.mark.parametrize(
    "columns",
    [(), (("a", "date", "no such type"),), (("a", "int", " "),), (("a", "int", "x"), ("a", "int", "y"))],
)
def test_bad_contracts_are_refused(columns):
    with pytest.raises(ValueError):
        Contract("t", "silver", "A table", columns)


def test_empty_description_and_repeated_table_are_refused():
    with pytest.raises(ValueError):
        Contract("t", "silver", "", (("a", "int", "x"),))
    one = Contract("t", "silver", "A table", (("a", "int", "x"),))
    with pytest.raises(ValueError):
        index_contracts([one, Contract("t", "gold", "Again", (("a", "int", "x"),))])


def test_conform_and_diff(spark):
    contract = Contract("t", "silver", "A table", (("a", "int", "first"), ("b", "string", "second"), ("c", "double", "third")))
    df = spark.createDataFrame([("x", 1, True)], "b string, a bigint, extra boolean")
    assert contract_diff(df, contract) == [
        ("missing", "c", "double", None),
        ("extra", "extra", None, "boolean"),
        ("type", "a", "int", "bigint"),
        ("position", "b", "1", "0"),
        ("position", "a", "0", "1"),
    ]
    fixed = conform(df.withColumn("c", F.lit(1)), contract)
    assert contract_diff(fixed, contract) == []
    assert fixed.schema["b"].metadata["comment"] == "second"


def test_table_is_created_with_comments(spark):
    spark.sql("DROP TABLE IF EXISTS wind_hourly")
    create_table(spark, CONTRACTS["wind_hourly"])
    described = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE wind_hourly").collect()}
    assert described["qn_3"] == "Quality level of the record; null when missing."


def test_published_columns_count_values(spark):
    df = spark.createDataFrame([("00001", None, 1.0, None, None)], "dwd_station_id string, observation_hour_utc timestamp, wind_speed_ms double, wind_direction_deg int, qn_3 int")
    out = {r["column_name"]: (r["position"], r["row_count"], r["value_count"]) for r in published_columns({"wind_hourly": df}).collect()}
    assert out["dwd_station_id"] == (1, 1, 1) and out["qn_3"] == (5, 1, 0)


# Expectations


def test_21_rules():
    assert sum(len(rules) for rules in expectations.expectations(JUNE).values()) == 21


def test_unknown_counts_as_violation_and_rows_stay(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('00044', TIMESTAMP '2026-06-01 00:00:00', 10D, 100D, 3),"
        " ('0044', TIMESTAMP '2026-07-01 00:00:00', 10D, 101D, 3), (NULL, NULL, NULL, NULL, NULL)"
        " AS t(dwd_station_id, observation_hour_utc, temp_celsius, humidity_pct, qn_9)"
    )
    report = expectations.expectation_report({"temperature_hourly": df}, JUNE)
    assert {r["rule"]: (r["row_count"], r["violations"]) for r in report.collect()} == {
        "valid_tu_station_id": (3, 2),
        "valid_tu_hour": (3, 2),
        "valid_humidity": (3, 1),
    }
    watched, counters = expectations.observed(df, "temperature_hourly", JUNE)
    assert len(watched.collect()) == 3
    assert counters.get == {"row_count": 3, "valid_tu_station_id": 2, "valid_tu_hour": 2, "valid_humidity": 1}


def test_rules_of_the_other_tables(spark):
    cases = {
        "stations": ("SELECT '0800261' eva, 91D latitude, 8D longitude", {"valid_eva": 1, "valid_coordinates": 1}),
        "weather_stations": (
            "SELECT '00001' dwd_station_id, false has_temperature, false has_wind",
            {"valid_dwd_station_id": 0, "has_observation_capability": 1},
        ),
        "station_weather_mapping": (
            "SELECT '08000261' eva, '00001' nearest_tu_station_id, -1D nearest_tu_dist_km, '1' nearest_ff_station_id, 0D nearest_ff_dist_km",
            {"valid_mapping_eva": 0, "valid_mapping_station_ids": 1, "valid_mapping_distances": 1},
        ),
        "wind_hourly": (
            "SELECT '00001' dwd_station_id, TIMESTAMP '2026-06-30 23:00:00' observation_hour_utc, -0.1D wind_speed_ms, 361 wind_direction_deg",
            {"valid_ff_station_id": 0, "valid_ff_hour": 0, "valid_wind_speed": 1, "valid_wind_direction": 1},
        ),
        "train_stops": (
            "SELECT ' ' id, '08000261' eva, CAST(NULL AS TIMESTAMP) event_hour_utc",
            {"valid_stop_id": 1, "valid_eva": 0, "valid_event_hour": 1},
        ),
        "train_stop_weather": (
            "SELECT 's' id, 'x' eva, TIMESTAMP '2026-06-30 23:00:00' event_hour_utc, '00001' nearest_tu_station_id, CAST(NULL AS STRING) nearest_ff_station_id",
            {"valid_gold_id": 0, "valid_gold_eva": 1, "valid_gold_hour": 0, "has_sensor_mapping": 1},
        ),
    }
    report = expectations.expectation_report({name: spark.sql(sql) for name, (sql, _) in cases.items()}, JUNE)
    found = {(r["table_name"], r["rule"]): r["violations"] for r in report.collect()}
    assert found == {(t, rule): n for t, (_, rules) in cases.items() for rule, n in rules.items()}


# Grain and coverage


def test_grain_audit_and_dedupe(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), (None, 1)], "id string, n int")
    row = grain.grain_audit({"train_stops": df}, {"train_stops": ["id"]}).first()
    assert (row["row_count"], row["distinct_keys"], row["duplicate_keys"], row["surplus_rows"]) == (4, 3, 1, 1)
    assert [(r["id"], r["copies"]) for r in grain.duplicate_keys(df, ["id"]).collect()] == [("a", 2)]
    kept = {(r["id"], r["n"]) for r in grain.one_row_per_key(df, ["id"]).collect()}
    assert kept == {("a", 1), ("b", 1), (None, 1)}


def test_row_preservation(spark):
    assert tuple(grain.row_preservation(spark.range(5), spark.range(5)).first()) == (5, 5, True)
    assert tuple(grain.row_preservation(spark.range(5), spark.range(6)).first()) == (5, 6, False)


def test_missing_hours_and_match_rate(spark):
    day = Period(JUNE.start, JUNE.start.replace(day=2), "one day")
    stops = spark.sql(
        "SELECT explode(sequence(TIMESTAMP '2026-06-01 02:00:00', TIMESTAMP '2026-06-01 21:00:00', INTERVAL 1 HOUR))"
        " AS event_hour_utc, '00000001' AS eva"
    )
    gaps = coverage.missing_hours(stops, day).select(F.hour("event_hour_utc").alias("h")).collect()
    assert sorted(r["h"] for r in gaps) == [0, 1, 22, 23]
    more = stops.unionByName(stops.limit(1).withColumn("eva", F.lit("00000002")))
    known = spark.createDataFrame([("00000001",), ("00000001",), ("00000003",)], "eva string")
    row = coverage.station_match_rate(more, known).first()
    assert (row["stops"], row["matched_stops"], row["evas"], row["matched_evas"]) == (21, 20, 2, 1)


def test_period_coverage_counts_every_row(spark):
    inside, second = 1780272000, 1_000_000_000
    df = spark.createDataFrame(
        [(inside * second,), ((inside - 1) * second,), (1782864000 * second,), (None,), (1717200000 * second,)], "time bigint"
    )
    row = coverage.period_coverage(df, JUNE).first().asDict()
    assert row == {"row_count": 5, "in_period": 1, "before_period": 2, "after_period": 1, "without_time": 1}


# Snapshots


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)


def entries(spark, rows):
    return spark.createDataFrame(
        rows, "relative_path string, byte_size bigint, sha256 string, role string, parent_artifact_sha256 string"
    )


def test_inventory_and_audit(spark, tmp_path):
    write(tmp_path / "railway/a.parquet", b"alpha")
    write(tmp_path / "dwd/wind/b.txt", b"beta")
    write(tmp_path / "dwd/wind/c.txt", b"gamma")
    write(tmp_path / "stray.txt", b"?")
    write(tmp_path / "manifest.json", b"{}")
    files = snapshot.file_inventory(spark, str(tmp_path))
    found = {r["relative_path"]: (r["byte_size"], r["sha256"]) for r in files.collect()}
    assert set(found) == {"railway/a.parquet", "dwd/wind/b.txt", "dwd/wind/c.txt", "stray.txt"}
    assert found["railway/a.parquet"] == (5, "8ed3f6ad685b959ead7022518e1af76cd816f8e8ec7ccdda1ed4018e8f2223f8")
    claimed = entries(
        spark,
        [
            ("railway/a.parquet", 5, found["railway/a.parquet"][1].upper(), "railway_parquet", None),
            ("dwd/wind/b.txt", 5, "0" * 64, "dwd_observation_txt", None),
            ("dwd/wind/c.txt", 5, "0" * 64, "dwd_observation_txt", None),
            ("gone.txt", 1, "0" * 64, "dwd_metadata", None),
        ],
    )
    audit = snapshot.snapshot_audit(claimed, files)
    assert {r["relative_path"]: r["status"] for r in audit.collect()} == {
        "railway/a.parquet": "ok",
        "dwd/wind/b.txt": "size mismatch",
        "dwd/wind/c.txt": "digest mismatch",
        "gone.txt": "missing",
        "stray.txt": "unlisted",
    }


@pytest.mark.parametrize("whole_bytes", [0, 5, 6, 1000])
def test_large_files_are_hashed_as_streams(spark, tmp_path, monkeypatch, whole_bytes):
    monkeypatch.setattr(snapshot.streamed_digests, "__defaults__", (4,))
    contents = {"a.bin": b"", "b.bin": b"12345", "deep/c d.bin": b"123456", "e.bin": bytes(range(256)) * 3}
    for name, content in contents.items():
        write(tmp_path / name, content)
    found = {r["relative_path"]: (r["byte_size"], r["sha256"]) for r in snapshot.file_inventory(spark, str(tmp_path), whole_bytes).collect()}
    assert found == {name: (len(content), hashlib.sha256(content).hexdigest()) for name, content in contents.items()}


def test_manifest_rules(spark):
    good = "a" * 64
    claimed = entries(
        spark,
        [
            ("ok.txt", 1, good, "stada_json", None),
            ("child.txt", 1, good.upper(), "stada_json", good.upper()),
            ("/abs.txt", 1, good, "stada_json", None),
            ("a/../b.txt", -1, good, "stada_json", None),
            ("dots..txt", 1, "xyz", "unknown", "b" * 64),
            ("twice.txt", 1, good, "stada_json", "short"),
            ("twice.txt", 1, good, "stada_json", None),
            (" ", 1, good, "stada_json", None),
        ],
    )
    broken = {(r["relative_path"], r["rule"]) for r in snapshot.manifest_rule_audit(claimed).collect()}
    assert broken == {
        ("/abs.txt", "absolute_path"),
        ("a/../b.txt", "path_leaves_root"),
        ("a/../b.txt", "negative_size"),
        ("dots..txt", "bad_digest"),
        ("dots..txt", "unknown_role"),
        ("dots..txt", "parent_not_listed"),
        ("twice.txt", "bad_parent_digest"),
        ("twice.txt", "parent_not_listed"),
        ("twice.txt", "duplicate_path"),
        (" ", "empty_path"),
    }


@pytest.mark.parametrize(
    ("statuses", "manifests", "state"),
    [
        (["ok", "ok"], [("1.0", "2026-06")], "VALID"),
        (["ok", "unlisted"], [("1.0", "2026-06")], "VALID"),
        (["ok", "missing"], [("1.0", "2026-06")], "CORRUPTED"),
        (["digest mismatch"], [("1.0", "2026-06")], "CORRUPTED"),
        (["ok"], [("1.0", "2025-01")], "CORRUPTED"),
        (["unlisted"], [], "INCOMPLETE"),
        (["unlisted"], [(None, None)], "INCOMPLETE"),
        (["unlisted"], [("9.9", "2026-06")], "INCOMPLETE"),
        ([], [], "EMPTY"),
    ],
)
def test_snapshot_states(spark, statuses, manifests, state):
    audit = spark.createDataFrame([(s,) for s in statuses], "status string")
    heads = spark.createDataFrame(manifests, "schema_version string, snapshot_id string")
    assert snapshot.snapshot_state(audit, heads, "2026-06").first()["state"] == state


def test_a_manifest_that_breaks_its_rules_is_no_valid_snapshot(spark):
    listed = entries(spark, [("/abs.txt", -1, "a" * 64, "notes", None)])
    audit = spark.createDataFrame([("ok",)], "status string")
    heads = spark.createDataFrame([("1.0", "2026-06")], "schema_version string, snapshot_id string")
    row = snapshot.snapshot_state(audit, heads, "2026-06", snapshot.manifest_rule_audit(listed)).first()
    assert (row["broken_rules"], row["state"]) == (3, "INCOMPLETE")
    none = snapshot.manifest_rule_audit(listed.limit(0))
    assert snapshot.snapshot_state(audit, heads, "2026-06", none).first()["state"] == "VALID"


@pytest.mark.parametrize(
    ("head", "rules"),
    [
        (("1.0", "2026-06", "2026-07-01T00:00:00+00:00", []), set()),
        (("1.0", "2026-06", "2026-07-01", []), set()),
        (("1.0", "2026-06", "2026-07-01 10:15:30.250Z", []), set()),
        (("2.0", " ", "2026-02-30T00:00:00", []), {"unknown_version", "empty_snapshot_id", "bad_creation_time"}),
        (("1.0", "2026-06", "yesterday", None), {"bad_creation_time", "no_artifact_list"}),
        (("1.0", "2026-06", "2026-07-01T25:00:00", []), {"bad_creation_time"}),
        ((None, None, None, None), {"unknown_version", "empty_snapshot_id", "bad_creation_time", "no_artifact_list"}),
    ],
)
def test_manifest_head_rules(spark, head, rules):
    df = spark.createDataFrame([head], "schema_version string, snapshot_id string, created_at_utc string, artifacts array<string>")
    found = {(r["relative_path"], r["rule"]) for r in snapshot.manifest_head_audit(df).collect()}
    assert found == {("manifest.json", rule) for rule in rules}


def test_manifest_file(spark, tmp_path):
    text = (
        '{"schema_version": "1.0", "snapshot_id": "2026-06", "created_at_utc": "2026-07-01T00:00:00+00:00",\n'
        ' "artifacts": [{"relative_path": "a.txt", "byte_size": 5, "sha256": "ABC", "role": "stada_json"}]}'
    )
    (tmp_path / "manifest.json").write_text(text)
    head = snapshot.read_manifest(spark, str(tmp_path))
    assert head.first()["snapshot_id"] == "2026-06"
    entry = snapshot.manifest_entries(head).first()
    assert (entry["relative_path"], entry["sha256"], entry["source_url"]) == ("a.txt", "abc", None)
    (tmp_path / "manifest.json").write_text("{broken")
    assert snapshot.read_manifest(spark, str(tmp_path)).first()["snapshot_id"] is None
