"""Boundary rows per operator (one row per boundary value)."""

import datetime as dt

from pyspark.sql import functions as F

from metroflux.functions import calendar as cal
from metroflux.functions import classify as cl
from metroflux.operators import disruption as ds
from metroflux.operators import staging as stg
from metroflux.operators import star
from metroflux.operators.dedupe import dedupe
from metroflux.schemas import ALERTS_RAW, FIXTURE_BOUNDS, TRIPS_RAW, WEATHER_RAW

T0 = dt.datetime(2024, 1, 10, 8, 0, 0)


def trip(**kw):
    base = dict(VendorID=2, tpep_pickup_datetime=T0, tpep_dropoff_datetime=T0 + dt.timedelta(minutes=15),
                passenger_count=1, trip_distance=2.5, RatecodeID=1, store_and_fwd_flag="N",
                PULocationID=10, DOLocationID=20, payment_type=1, fare_amount=12.5, extra=0.0,
                mta_tax=0.5, tip_amount=2.0, tolls_amount=0.0, improvement_surcharge=1.0,
                total_amount=16.0, congestion_surcharge=2.5, Airport_fee=0.0, cbd_congestion_fee=0.75)
    base.update(kw)
    return tuple(base[f.name] for f in TRIPS_RAW.fields)


def trips(spark, *rows):
    return spark.createDataFrame(list(rows), TRIPS_RAW)


def test_dedupe_equal_rows_cents_and_null_passenger(spark):
    rows = [trip(), trip(),                                   # exact copies
            trip(fare_amount=7.1, tip_amount=1.0), trip(fare_amount=7.1000000000000005, tip_amount=0.5),
            trip(passenger_count=None, PULocationID=11), trip(passenger_count=None, PULocationID=11)]
    out = stg.dedupe_trips(trips(spark, *rows))
    assert out.count() == 3
    # survivor of the cents-equal pair is the smallest over the other columns (tip 0.5)
    assert out.where("PULocationID = 10 and round(fare_amount, 2) = 7.1").first().tip_amount == 0.5
    # idempotent
    assert stg.dedupe_trips(out).count() == 3


def test_minutes_truncate_toward_zero(spark):
    rows = [(T0, T0 + dt.timedelta(seconds=61)), (T0, T0 + dt.timedelta(seconds=59)),
            (T0, T0 - dt.timedelta(seconds=61)),
            (dt.datetime(2024, 1, 1, 23, 50), dt.datetime(2024, 1, 2, 0, 10))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r.m for r in df.select(cal.minutes_between("a", "b").alias("m")).collect()]
    assert got == [1, 0, -1, 20]


def test_filter_bounds(spark):
    b = dict(FIXTURE_BOUNDS)
    cases = {  # (minutes, miles, fare, pickup) -> kept
        (0, 1.0, 10.0, T0): False, (1, 1.0, 10.0, T0): True, (90, 1.0, 10.0, T0): True,
        (91, 1.0, 10.0, T0): False, (5, 0.0, 10.0, T0): False, (5, 40.0, 10.0, T0): True,
        (5, 40.01, 10.0, T0): False, (5, 1.0, 0.0, T0): False, (5, 1.0, 150.0, T0): True,
        (5, 1.0, 150.01, T0): False, (5, 1.0, 10.0, dt.datetime(2024, 1, 1)): True,
        (5, 1.0, 10.0, dt.datetime(2024, 2, 1)): False,
        (5, 1.0, 10.0, dt.datetime(2023, 12, 31, 23, 59, 59)): False,
    }
    rows = [trip(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=m),
                 trip_distance=mi, fare_amount=f, PULocationID=i) for i, (m, mi, f, p) in enumerate(cases)]
    rows.append(trip(PULocationID=None))
    kept = {r.pickup_location_id for r in stg.stage_trips(trips(spark, *rows), b).collect()}
    want = {i for i, k in enumerate(cases.values()) if k}
    assert kept == want


def test_weather_severity_boundaries(spark):
    rows = [(2.0, 0.0, 0.0, "light_snow"), (2.01, 0.0, 0.0, "heavy_snow"), (0.5, 0.0, 0.0, "clear"),
            (0.51, 0.0, 0.0, "light_snow"), (0.0, 5.0, 0.0, "light_rain"), (0.0, 5.01, 0.0, "heavy_rain"),
            (0.0, 1.0, 0.0, "clear"), (0.0, 1.01, 0.0, "light_rain"), (0.0, 0.0, -5.0, "clear"),
            (0.0, 0.0, -5.01, "extreme_cold"), (0.0, 0.0, 30.0, "warm"), (0.0, 0.0, 30.01, "extreme_heat"),
            (0.0, 0.0, 22.0, "clear"), (0.0, 0.0, 22.01, "warm"), (None, None, None, "clear")]
    df = spark.createDataFrame(rows, "s double, r double, t double, want string")
    got = df.select(cl.weather_severity("s", "r", "t").alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)


def test_fahrenheit_half_up(spark):
    df = spark.createDataFrame([(-12.0,), (0.5,), (37.0,), (-40.0,)], "c double")
    assert [r.f for r in df.select(cl.celsius_to_fahrenheit("c").alias("f")).collect()] == [10.4, 32.9, 98.6, -40.0]


def test_disruption_scores(spark):
    df = spark.createDataFrame([(e,) for e in ["NO_SERVICE", "SIGNIFICANT_DELAYS", "REDUCED_SERVICE",
                                               "MODIFIED_SERVICE", "DETOUR", "OTHER_EFFECT", None]], "effect string")
    assert [r.s for r in df.select(cl.disruption_score().alias("s")).collect()] == [5, 4, 3, 2, 1, 0, 0]


def test_alert_staging_drops_blank_and_null(spark):
    rows = [("a1", "A", "C", "DETOUR", "h", "1704067200", "1704070800", None, None),
            ("a2", "A", "C", "DETOUR", "h", "", "1704070800", None, True),
            ("a3", "A", "C", "DETOUR", "h", "1704067200", None, None, False)]
    out = stg.stage_alerts(spark.createDataFrame(rows, ALERTS_RAW)).collect()
    assert [r.alert_id for r in out] == ["a1"]
    assert out[0].alert_start_datetime == dt.datetime(2024, 1, 1, 0, 0)
    assert out[0].alert_duration_minutes == 60


def test_distance_buckets(spark):
    vals = [(0.99, "under_1_mile"), (1.0, "1_to_5_miles"), (5.99, "1_to_5_miles"), (6.0, "6_to_20_miles"),
            (20.99, "6_to_20_miles"), (21.0, "21_to_50_miles"), (50.99, "21_to_50_miles"),
            (51.0, "51_to_100_miles"), (100.0, "51_to_100_miles"), (100.01, "over_100_miles"),
            (None, "over_100_miles")]
    df = spark.createDataFrame(vals, "d double, want string")
    assert all(r.g == r.want for r in df.select(cl.distance_bucket("d").alias("g"), "want").collect())


def test_time_of_day_vocabularies(spark):
    df = spark.range(24).select(F.col("id").alias("h"))
    rows = df.select("h", cal.trip_time_of_day("h").alias("a"), cal.dim_time_of_day("h").alias("b"),
                     cal.is_peak_hour("h").alias("p")).orderBy("h").collect()
    assert rows[4].a == "early_morning" and rows[4].b == "off_peak"
    assert rows[5].b == "morning_peak" and rows[12].a == "afternoon_peak" and rows[12].b == "off_peak"
    assert [r.h for r in rows if r.p] == [7, 8, 9, 17, 18, 19]
    assert {r.a for r in rows} == {"early_morning", "late_morning", "afternoon_peak", "evening_peak",
                                   "late_night", "mid_night"}


def test_zero_and_null_divisors(spark):
    from metroflux.functions.numeric import ratio_rounded
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 8.0), (0.01, 8.0)], "n double, d double")
    got = [r.x for r in df.select(ratio_rounded("n", "d", 2, 100).alias("x")).collect()]
    assert got == [None, None, 12.5, 0.13]   # 0.125 rounds half away from zero


def _alerts(spark, rows):
    schema = ("alert_date date, subway_line string, cause string, effect string, disruption_severity_score bigint, "
              "is_synthetic boolean, alert_start_hour bigint, alert_end_hour bigint, alert_duration_minutes bigint, "
              "alert_start_datetime timestamp_ntz, alert_end_datetime timestamp_ntz")
    return spark.createDataFrame(rows, schema)


def test_explode_hours(spark):
    d = dt.date(2024, 1, 5)
    mk = lambda s, e, sh, eh: (d, "A", "c", "e", 4, None, sh, eh, 0, s, e)
    rows = [mk(dt.datetime(2024, 1, 5, 8, 10), dt.datetime(2024, 1, 5, 11, 0), 8, 11),
            mk(dt.datetime(2024, 1, 5, 22, 0), dt.datetime(2024, 1, 6, 2, 30), 22, 2),
            mk(dt.datetime(2024, 1, 5, 9, 0), dt.datetime(2024, 1, 5, 9, 20), 9, 9),
            mk(dt.datetime(2024, 1, 5, 9, 0), None, 9, None)]
    df = _alerts(spark, rows)
    assert ds.explode_hours(df).count() == 4 + 0 + 1 + 0
    across = ds.explode_hours(df, across_midnight=True)
    assert across.count() == 4 + 5 + 1 + 0
    assert across.where("alert_date = date'2024-01-06'").count() == 3


def test_hourly_disruptions_counts(spark):
    d = dt.date(2024, 1, 5)
    s, e = dt.datetime(2024, 1, 5, 8), dt.datetime(2024, 1, 5, 8, 30)
    rows = [(d, "A", "c", "e", 4, None, 8, 8, 30, s, e), (d, "A", "c", "e", 2, None, 8, 8, 30, s, e),
            (d, "B", "c", "e", 5, None, 8, 8, 30, s, e)]
    alerts = _alerts(spark, rows).select("alert_date", "subway_line", "cause", "effect",
                                         "disruption_severity_score", "is_synthetic", "alert_duration_minutes",
                                         "alert_start_datetime", "alert_end_datetime")
    r = ds.hourly_disruptions(alerts).first()
    assert (r.severe_alert_count, r.moderate_alert_count, r.lines_affected, r.max_severity_score) == (2, 3, 2, 5)
    assert r.has_synthetic_data is None   # all-NULL flag; defaulted to false downstream


def test_compound_excludes_light_rain(spark):
    df = spark.createDataFrame([(1, "light_rain"), (1, "heavy_rain"), (0, "heavy_snow"), (None, "light_snow")],
                               "n bigint, sev string")
    assert [r.c for r in df.select(cl.is_compound("n", "sev").alias("c")).collect()] == [False, True, False, False]


def test_date_spine_end_excluded(spark):
    assert star.date_spine(spark, "2024-01-01 00:00:00", "2024-01-02 00:00:00").count() == 24
    t = star.dim_time(star.date_spine(spark, "2023-12-19 00:00:00", "2024-01-05 00:00:00"))
    hol = {r.date_day for r in t.where("is_holiday_period").select("date_day").distinct().collect()}
    assert dt.date(2023, 12, 19) not in hol and dt.date(2023, 12, 20) in hol and dt.date(2023, 12, 31) in hol
    assert dt.date(2024, 1, 1) in hol and dt.date(2024, 1, 3) in hol and dt.date(2024, 1, 4) not in hol


def test_precipitation_type(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (None, None)], "s double, r double")
    got = [r.p for r in df.select(cl.precipitation_type("s", "r").alias("p")).collect()]
    assert got == ["snow_and_rain", "snow_only", "rain_only", "dry", "dry"]


def test_weather_staging_parses_text_and_timestamp(spark):
    rows = [("2025-11-03T22:00", 1.0, 0.0, 0.0, 5.0, 3, 10000.0, 40.7, -74.0, "UTC")]
    w = stg.stage_weather(spark.createDataFrame(rows, WEATHER_RAW)).first()
    assert w.weather_datetime == dt.datetime(2025, 11, 3, 22, 0) and w.weather_hour == 22
    assert w.temperature_fahrenheit == 33.8


def test_generic_dedupe_keeps_smallest(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, None), (1, 2, "z")], "k int, l int, v string")
    out = {(r.k, r.l): r.v for r in dedupe(df, ["k", "l"]).collect()}
    assert out == {(1, 1): "a", (1, 2): None}


def _by_hours(alerts, across):
    """The hourly table from one row per alert and hour."""
    hours = ds.explode_hours(ds.alert_hours(alerts), across)
    score = F.col("disruption_severity_score")
    return hours.groupBy("alert_date", "hour_of_day").agg(
        F.count_if(score >= 4).alias("severe_alert_count"), F.count_if(score >= 2).alias("moderate_alert_count"),
        F.count_distinct("subway_line").alias("lines_affected"), F.max(score).alias("max_severity_score"),
        F.bool_or("is_synthetic").alias("has_synthetic_data"))


def _staged(spark, rows):
    schema = ("alert_date date, subway_line string, cause string, effect string, disruption_severity_score bigint, is_synthetic boolean, "
              "alert_duration_minutes bigint, alert_start_datetime timestamp_ntz, alert_end_datetime timestamp_ntz")
    return spark.createDataFrame([(s.date() if s else None, line, "c", "e", score, flag, 0, s, e) for line, score, flag, s, e in rows], schema)


def test_sweep_equals_one_row_per_alert_and_hour(spark):
    import random
    rng = random.Random(9)
    base = dt.datetime(2024, 1, 5)
    rows = []
    for _ in range(300):
        s = base + dt.timedelta(minutes=rng.randrange(60 * 24 * 6))
        e = s + dt.timedelta(minutes=rng.choice([0, 20, 59, 60, 61, 300, 1500, 4000, -30]))
        rows.append((rng.choice(["A", "B", "7", None]), rng.choice([0, 1, 2, 3, 4, 5, None]), rng.choice([True, False, None]), s, e))
    rows += [("A", 4, None, None, base), ("A", 4, None, base, None), ("C", 5, True, base, base)]
    alerts = _staged(spark, rows)
    for across in (False, True):
        want = _by_hours(alerts, across)
        got = ds.hourly_disruptions(alerts, across).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert ds.hourly_disruptions(alerts.limit(0)).count() == 0


def test_sweep_rows_grow_with_alerts_not_with_their_length(spark):
    s = dt.datetime(2024, 1, 1, 8, 10)
    alerts = _staged(spark, [(line, 4, None, s + dt.timedelta(hours=i), s + dt.timedelta(days=365)) for i, line in enumerate("ABCDEFGHIJ")] * 50)
    changes = ds._changes(ds.covered_span(ds.alert_hours(alerts), across_midnight=True))
    assert changes.count() == 2 * 500
    out = ds.hourly_disruptions(alerts, across_midnight=True)
    assert out.count() == 365 * 24 + 1
    assert out.where("lines_affected = 10 and severe_alert_count = 500").count() == 365 * 24 + 1 - 9
