import math
import random

import pytest
from pyspark.sql import functions as F

from railctx.functions.geo import box_gap, box_reach, chord, haversine_km, unit_vector, z_order
from railctx.operators import nearest
from railctx.operators.nearest import nearest_site
from railctx.operators.sensors import station_weather_mapping

POINTS = "k string, net string, latitude double, longitude double"
SITES = "sid string, net string, latitude double, longitude double"


def km(lat1, lon1, lat2, lon2):
    a, b = math.radians(lat1), math.radians(lat2)
    h = math.sin((b - a) / 2) ** 2
    h += math.cos(a) * math.cos(b) * math.sin((math.radians(lon2) - math.radians(lon1)) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, max(0.0, h))))


def check(spark, points, sites, **options):
    """Compare with brute force over all pairs."""
    left = spark.createDataFrame(
        [(f"p{i}", net, float(a), float(b)) for i, (a, b) in enumerate(points) for net in "xy"], POINTS
    )
    rows = [(f"s{i:04d}", "xy"[i % 2], float(a), float(b)) for i, (a, b) in enumerate(sites)]
    found = nearest_site(
        left, spark.createDataFrame(rows, SITES), key=["k"], on="net", site_id="sid", **options
    ).collect()
    got = {(row["k"], row["net"]): (row["sid"], row["distance_km"]) for row in found}
    assert len(found) == len(got)
    for i, (a, b) in enumerate(points):
        for net in "xy":
            candidates = [(km(a, b, c, d), sid) for sid, n, c, d in rows if n == net]
            if not candidates:
                assert (f"p{i}", net) not in got
                continue
            distance, sid = min(candidates)
            assert got[f"p{i}", net][1] == pytest.approx(distance, abs=1e-7)
            # Computed distances of equally near sites differ in the last digits only.
            near = {s for d, s in candidates if d <= distance + 1e-7}
            assert got[f"p{i}", net][0] in near
            if len(near) == 1:
                assert got[f"p{i}", net][0] == sid


def test_known_distance(spark):
    df = spark.createDataFrame([(52.5251, 13.3694, 52.4675, 13.4021)], "a double, b double, c double, d double")
    value = df.select(haversine_km(*[F.col(c) for c in "abcd"])).first()[0]
    assert value == pytest.approx(6.7776, rel=0.01)
    assert value == pytest.approx(km(52.5251, 13.3694, 52.4675, 13.4021), abs=1e-9)


def test_same_place_is_exactly_zero(spark):
    df = spark.createDataFrame([(48.1402, 11.5600)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    assert df.select(haversine_km(a, b, a, b)).first()[0] == 0.0


def test_opposite_places_stay_in_range(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)], "a double, b double, c double, d double")
    for row in df.select(haversine_km(*[F.col(c) for c in "abcd"])).collect():
        assert row[0] == pytest.approx(math.pi * 6371.0)


def test_unknown_coordinate_gives_no_distance(spark):
    df = spark.createDataFrame([(None, 8.0, 50.0, 8.0)], "a double, b double, c double, d double")
    assert df.select(haversine_km(*[F.col(c) for c in "abcd"])).first()[0] is None


def test_box_gap_never_exceeds_the_chord_to_a_member(spark):
    rng = random.Random(5)
    rows = [tuple(rng.uniform(-1, 1) for _ in range(9)) for _ in range(300)]
    names = [f"c{i}" for i in range(9)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    p, q, r = [[F.col(n) for n in names[i : i + 3]] for i in (0, 3, 6)]
    low = [F.least(a, b) for a, b in zip(q, r, strict=True)]
    high = [F.greatest(a, b) for a, b in zip(q, r, strict=True)]
    gap = box_gap(p, low, high)
    assert df.where((gap > chord(p, q) + 1e-12) | (gap > chord(p, r) + 1e-12)).count() == 0


def test_vector_order_is_distance_order(spark):
    rng = random.Random(6)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    v, w = (list(unit_vector(F.col(x), F.col(y)).values()) for x, y in ("ab", "cd"))
    pairs = df.select(chord(v, w).alias("chord"), haversine_km(*[F.col(c) for c in "abcd"]).alias("km")).collect()
    by_chord = sorted(pairs, key=lambda row: row["chord"])
    assert all(x["km"] <= y["km"] + 1e-6 for x, y in zip(by_chord, by_chord[1:], strict=False))


def test_regional_points(spark):
    rng = random.Random(1)
    draw = lambda n: [(rng.uniform(47, 55), rng.uniform(6, 15)) for _ in range(n)]
    check(spark, draw(120), draw(400))


def test_world_with_poles_and_date_line(spark):
    rng = random.Random(2)
    draw = lambda n: [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]
    edges = [(89.99, 0), (-89.99, 170), (90, 0), (0, 179.99), (0, -179.99), (0, 180), (0, -180)]
    check(spark, draw(80) + edges, draw(60) + edges[:4], leaf_sites=2)


def test_crowded_cell_far_away_without_broadcast(spark):
    rng = random.Random(3)
    cluster = [(rng.gauss(50, 0.0005), rng.gauss(8, 0.0005)) for _ in range(200)]
    points = [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(60)] + cluster[:20]
    check(spark, points, cluster + [(-30.0, 100.0), (60.0, -120.0)], leaf_sites=8, broadcast_bytes=0)


def test_crowding_beyond_the_finest_grid(spark, monkeypatch):
    monkeypatch.setattr(nearest, "DEPTHS", 3)
    rng = random.Random(4)
    cluster = [(rng.gauss(50, 0.01), rng.gauss(8, 0.01)) for _ in range(100)]
    check(spark, cluster[:30], cluster, leaf_sites=4)


def test_ties_go_to_the_smallest_id(spark):
    points = spark.createDataFrame([("a", "x", 50.0, 8.0), ("b", "x", 50.0, 8.5)], POINTS)
    sites = spark.createDataFrame(
        [("9", "x", 50.0, 9.0), ("3", "x", 50.0, 9.0), ("5", "x", 50.0, 9.0), ("1", "y", 50.0, 8.0)], SITES
    )
    found = nearest_site(points, sites, key=["k"], on="net", site_id="sid").collect()
    assert {row["k"]: row["sid"] for row in found} == {"a": "3", "b": "3"}


def test_no_sites_and_no_coordinates(spark):
    points = spark.createDataFrame([("a", "x", 50.0, 8.0), ("b", "x", None, 8.5)], POINTS)
    empty = spark.createDataFrame([("1", "x", None, 8.0)], SITES)
    assert nearest_site(points, empty, key=["k"], on="net", site_id="sid").count() == 0
    sites = spark.createDataFrame([("1", "x", None, 8.0), ("2", "x", 51.0, 8.0)], SITES)
    found = nearest_site(points, sites, key=["k"], on="net", site_id="sid").collect()
    assert [(row["k"], row["sid"]) for row in found] == [("a", "2")]


def stations(spark, rows):
    return spark.createDataFrame(rows, "eva string, latitude double, longitude double")


def sensors(spark, rows):
    return spark.createDataFrame(
        rows, "dwd_station_id string, latitude double, longitude double, has_temperature boolean, has_wind boolean"
    )


def test_networks_are_mapped_independently(spark):
    mapping = station_weather_mapping(
        stations(spark, [("08011160", 52.525, 13.369), ("08000261", 48.140, 11.558)]),
        sensors(
            spark,
            [("00433", 52.467, 13.402, True, False), ("00399", 52.520, 13.410, False, True), ("03379", 48.163, 11.543, True, True)],
        ),
    )
    rows = {row["eva"]: row for row in mapping.collect()}
    assert mapping.columns == [
        "eva",
        "nearest_tu_station_id",
        "nearest_tu_dist_km",
        "nearest_ff_station_id",
        "nearest_ff_dist_km",
    ]
    berlin, munich = rows["08011160"], rows["08000261"]
    assert (berlin["nearest_tu_station_id"], berlin["nearest_ff_station_id"]) == ("00433", "00399")
    assert berlin["nearest_ff_dist_km"] == pytest.approx(km(52.525, 13.369, 52.520, 13.410), abs=1e-9)
    assert munich["nearest_tu_station_id"] == munich["nearest_ff_station_id"] == "03379"


def test_mapping_needs_both_networks(spark):
    one = stations(spark, [("00000001", 50.0, 8.0), ("00000002", None, 8.0)])
    only_temperature = sensors(spark, [("00001", 50.0, 8.1, True, False)])
    assert station_weather_mapping(one, only_temperature).count() == 0
    both = sensors(spark, [("00001", 50.0, 8.1, True, False), ("00002", None, None, True, True), ("00003", 50.0, 8.2, None, True)])
    assert [r["eva"] for r in station_weather_mapping(one, both).collect()] == ["00000001"]


def test_repeated_eva_maps_to_the_best_of_its_places(spark):
    twice = stations(spark, [("00000001", 50.0, 8.0), ("00000001", 50.0, 9.0)])
    both = sensors(spark, [("00001", 50.0, 8.01, True, True), ("00002", 50.0, 9.5, True, True)])
    rows = station_weather_mapping(twice, both).collect()
    assert [(r["eva"], r["nearest_tu_station_id"]) for r in rows] == [("00000001", "00001")]


def test_plan_has_no_cross_join_and_one_point_shuffle(spark):
    rng = random.Random(8)
    points = stations(spark, [(f"{i:08d}", rng.uniform(47, 55), rng.uniform(6, 15)) for i in range(50)])
    sites = sensors(spark, [(f"{i:05d}", rng.uniform(47, 55), rng.uniform(6, 15), True, True) for i in range(50)])
    plan = station_weather_mapping(points, sites)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("REPARTITION_BY_NUM") == 1


def test_z_order_prefixes_are_the_coarser_cells(spark):
    rng = random.Random(8)
    rows = [tuple(rng.uniform(-1, 1) for _ in range(3)) for _ in range(200)] + [(1.0, 1.0, 1.0), (-1.0, -1.0, -1.0), (0.0, -0.0, 1.0)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    columns = [F.col(c) for c in "xyz"]
    out = df.select(*columns, *[z_order(*columns, bits).alias(f"b{bits}") for bits in (1, 7, 21)]).collect()

    def number(row, bits):
        cells = [min(int((row[c] + 1) * 2 ** (bits - 1)), 2**bits - 1) for c in "xyz"]
        return sum((cell >> b & 1) << (3 * b + 2 - axis) for axis, cell in enumerate(cells) for b in range(bits))

    for row in out:
        assert [row["b1"], row["b7"], row["b21"]] == [number(row, 1), number(row, 7), number(row, 21)]
        assert row["b21"] >> 3 * 14 == row["b7"] and row["b7"] >> 3 * 6 == row["b1"]


def test_far_corner_is_beyond_every_point_of_the_box(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(100):
        low = [rng.uniform(-1, 1) for _ in range(3)]
        high = [a + rng.uniform(0, 0.5) for a in low]
        inside = [rng.uniform(a, b) for a, b in zip(low, high)]
        rows.append((*[rng.uniform(-1, 1) for _ in range(3)], *low, *high, *inside))
    df = spark.createDataFrame(rows, [f"{n}{c}" for n in "plhi" for c in "xyz"])
    p, low, high, inside = ([F.col(f"{n}{c}") for c in "xyz"] for n in "plhi")
    assert df.where(chord(p, inside) > box_reach(p, low, high) + 1e-12).isEmpty()
    assert df.where(chord(p, inside) < box_gap(p, low, high) - 1e-12).isEmpty()


def test_no_sort_aggregate(spark):
    points = spark.createDataFrame([("p", "x", 50.0, 8.0)], POINTS)
    sites = spark.createDataFrame([("s", "x", 51.0, 8.0)], SITES)
    plan = nearest_site(points, sites, key=["k"], on="net", site_id="sid")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    stations = spark.createDataFrame([("1", 50.0, 8.0)], "eva string, latitude double, longitude double")
    sensors = spark.createDataFrame([("t", 50.0, 8.0, True, True)], "dwd_station_id string, latitude double, longitude double, has_temperature boolean, has_wind boolean")
    plan = station_weather_mapping(stations, sensors)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_points_of_one_place_walk_as_one_region(spark, monkeypatch):
    walked = []
    real = nearest._descend

    def descend(frontier, *args):
        walked.append(frontier.count())
        return real(frontier, *args)

    monkeypatch.setattr(nearest, "_descend", descend)
    rng = random.Random(10)
    crowd = [(50 + rng.uniform(0, 1e-9), 8 + rng.uniform(0, 1e-9)) for _ in range(40)]
    check(spark, crowd, [(rng.uniform(47, 55), rng.uniform(6, 15)) for _ in range(60)])
    assert walked and max(walked) < 40  # and not a row for each of the 80 points


def test_a_place_that_is_not_finite_hides_no_other(spark):
    points = spark.createDataFrame([("a", "x", 50.0, 8.0), ("b", "x", float("inf"), 8.0)], POINTS)
    sites = spark.createDataFrame([("1", "x", 50.0, 9.0), ("2", "x", -50.0, 8.0)], SITES)
    found = nearest_site(points, sites, key=["k"], on="net", site_id="sid").collect()
    assert [(row["k"], row["sid"]) for row in found] == [("a", "1")]
