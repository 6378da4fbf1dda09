import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railctx.functions import time as t
from railctx.period import Period
from railctx.session import require_utc


def texts(df, *columns):
    rows = df.select(*[F.col(c).cast("string") for c in columns]).collect()
    return [tuple(row) for row in rows]


def test_summer_clock_becomes_utc_and_hour(spark):
    df = spark.createDataFrame([("2026-06-01 02:30:00",), ("2026-06-15 14:45:00",)], "s string")
    utc = t.local_to_utc(F.col("s"), t.TEXT)
    out = df.select(utc.alias("u"), t.utc_hour(utc).alias("h"))
    assert texts(out, "u", "h") == [
        ("2026-06-01 00:30:00", "2026-06-01 00:00:00"),
        ("2026-06-15 12:45:00", "2026-06-15 12:00:00"),
    ]


def test_winter_clock_is_one_hour_off(spark):
    df = spark.createDataFrame([("2026-01-10 00:15:00",)], "s string")
    assert texts(df.select(t.local_to_utc(F.col("s"), t.TEXT).alias("u")), "u") == [("2026-01-09 23:15:00",)]


@pytest.mark.parametrize(
    ("nanos", "utc"),
    [
        (1780272000000000000, "2026-05-31 22:00:00"),
        (1780271640000000000, "2026-05-31 21:54:00"),
        # The fraction is dropped, never rounded into the next hour.
        (1780271999999999999, "2026-05-31 21:59:59"),
        (None, None),
    ],
)
def test_nanoseconds(spark, nanos, utc):
    df = spark.createDataFrame([(nanos,)], "n bigint")
    assert texts(df.select(t.local_to_utc(F.col("n"), t.NANOS).alias("u")), "u") == [(utc,)]


def test_nanoseconds_before_1970_round_down(spark):
    df = spark.createDataFrame([(-1,), (-1_000_000_000,)], "n bigint")
    assert texts(df.select(t.nanos_to_clock(F.col("n")).alias("c")), "c") == [
        ("1969-12-31 23:59:59",),
        ("1969-12-31 23:59:59",),
    ]


def test_kind_follows_the_column_type():
    assert t.clock_kind(T.LongType()) == t.NANOS
    assert t.clock_kind(T.TimestampNTZType()) == t.CLOCK
    assert t.clock_kind(T.StringType()) == t.TEXT
    with pytest.raises(TypeError):
        t.clock_kind(T.BooleanType())


def test_text_of_many_digits_is_a_nanosecond_count(spark):
    df = spark.createDataFrame([("1780272000000000000",), ("nonsense",)], "s string")
    assert texts(df.select(t.wall_clock(F.col("s"), t.TEXT).alias("c")), "c") == [
        ("2026-06-01 00:00:00",),
        (None,),
    ]


def test_zone_less_timestamp_is_a_clock(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2026-06-01 14:30:00' AS c")
    assert texts(df.select(t.local_to_utc(F.col("c")).alias("u")), "u") == [("2026-06-01 12:30:00",)]
    assert df.select(t.raw_nanos(F.col("c"), t.CLOCK)).first()[0] == 1780324200000000000


def test_hour_stamps(spark):
    df = spark.createDataFrame([(2026060100,), (2026061512,), (2026061599,), (7,)], "n bigint")
    assert texts(df.select(t.parse_hour_stamp(F.col("n")).alias("h")), "h") == [
        ("2026-06-01 00:00:00",),
        ("2026-06-15 12:00:00",),
        (None,),
        (None,),
    ]
    blank = spark.createDataFrame([(" 2026060105 ",), ("",)], "s string")
    assert texts(blank.select(t.parse_hour_stamp(F.col("s")).alias("h")), "h") == [
        ("2026-06-01 05:00:00",),
        (None,),
    ]


@pytest.mark.parametrize(
    ("clock", "ambiguous", "skipped"),
    [
        ("2026-10-25 01:59:00", False, False),
        ("2026-10-25 02:00:00", True, False),
        ("2026-10-25 02:30:00", True, False),
        ("2026-10-25 03:00:00", False, False),
        ("2026-03-29 01:59:00", False, False),
        ("2026-03-29 02:00:00", False, True),
        ("2026-03-29 02:30:00", False, True),
        ("2026-03-29 03:00:00", False, False),
        ("2026-06-01 02:30:00", False, False),
    ],
)
def test_clock_changes_are_flagged(spark, clock, ambiguous, skipped):
    df = spark.sql(f"SELECT TIMESTAMP '{clock}' AS c")
    row = df.select(t.is_ambiguous_local(F.col("c")), t.is_skipped_local(F.col("c"))).first()
    assert tuple(row) == (ambiguous, skipped)


@pytest.mark.parametrize(
    ("zone", "clock", "first", "second"),
    [
        ("Europe/Berlin", "2026-10-25 02:30:00", "2026-10-25 00:30:00", "2026-10-25 01:30:00"),
        ("Europe/Berlin", "2026-03-29 02:30:00", None, None),
        ("Europe/Berlin", "2026-06-01 02:30:00", "2026-06-01 00:30:00", None),
        # Half an hour: 10:30 ahead in winter, 11:00 in summer.
        ("Australia/Lord_Howe", "2026-04-05 01:45:00", "2026-04-04 14:45:00", "2026-04-04 15:15:00"),
        ("Australia/Lord_Howe", "2026-04-05 02:00:00", "2026-04-04 15:30:00", None),
        ("Australia/Lord_Howe", "2026-10-04 02:15:00", None, None),
        ("Australia/Lord_Howe", "2026-10-04 02:30:00", "2026-10-03 15:30:00", None),
        # Two hours.
        ("Antarctica/Troll", "2026-10-25 01:30:00", "2026-10-24 23:30:00", "2026-10-25 01:30:00"),
        ("Antarctica/Troll", "2026-03-29 02:59:00", None, None),
        ("UTC", "2026-10-25 02:30:00", "2026-10-25 02:30:00", None),
        # A day that was left out.
        ("Pacific/Apia", "2011-12-30 12:00:00", None, None),
    ],
)
def test_instants_of_any_zone(spark, zone, clock, first, second):
    df = spark.sql(f"SELECT TIMESTAMP '{clock}' AS c").select(t.local_instants(F.col("c"), zone).alias("i"), t.is_skipped_local(F.col("c"), zone).alias("s"), t.is_ambiguous_local(F.col("c"), zone).alias("a"))
    row = df.select(F.col("i.first").cast("string"), F.col("i.second").cast("string"), "s", "a").first()
    assert tuple(row) == (first, second, first is None, second is not None)


def test_no_clock_has_no_flags(spark):
    row = spark.sql("SELECT CAST(NULL AS TIMESTAMP) c").select(t.is_ambiguous_local(F.col("c")), t.is_skipped_local(F.col("c")), t.local_instants(F.col("c"))["first"]).first()
    assert tuple(row) == (None, None, None)


def test_clock_change_instants(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP '2026-10-25 02:30:00', TIMESTAMP '2026-03-29 02:30:00')) c")
    assert texts(df.select(t.local_to_utc(F.col("c")).alias("u")), "u") == [
        ("2026-10-25 00:30:00",),
        ("2026-03-29 01:30:00",),
    ]


def test_period_bounds(spark):
    june = Period.month("2026-06")
    assert (june.first_day, june.last_day, june.label) == (20260601, 20260630, "2026-06")
    assert Period.month("2026-12").end.isoformat() == "2027-01-01"
    row = spark.range(1).select(F.unix_seconds(june.start_utc), F.unix_seconds(june.end_utc)).first()
    assert tuple(row) == (1780272000, 1782864000)
    with pytest.raises(ValueError):
        Period(june.end, june.start, "back to front")


def test_period_membership_is_half_open(spark):
    june = Period.month("2026-06")
    df = spark.sql(
        "SELECT explode(array(TIMESTAMP '2026-05-31 23:59:59', TIMESTAMP '2026-06-01 00:00:00',"
        " TIMESTAMP '2026-06-30 23:00:00', TIMESTAMP '2026-07-01 00:00:00')) AS ts"
    )
    assert [r[0] for r in df.select(june.holds_instant(F.col("ts"))).collect()] == [False, True, True, False]
    stamps = spark.createDataFrame([("2026053123",), ("2026060100",), ("2026063023",), ("2026070100",)], "s string")
    assert [r[0] for r in stamps.select(june.holds_stamp(F.col("s"))).collect()] == [False, True, True, False]
    days = spark.createDataFrame([(20260601, 20260630), (20260602, 20991231), (19000101, 20260629)], "a long, b long")
    held = days.select(june.holds_validity(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in held] == [True, False, False]


def test_other_session_zones_are_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    require_utc(spark)
