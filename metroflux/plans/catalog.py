"""Named queries over a test-data directory: (spark, sf_dir) -> DataFrame.

Every query reads the supplied tables through the feed adapters, so its
work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.operators import demand as dm
from metroflux.operators import disruption as ds
from metroflux.operators import staging as stg
from metroflux.plans.pipeline import Pipeline
from metroflux.schemas import FIXTURE_BOUNDS
from metroflux.sources.fixtures import Feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def prepare(spark: SparkSession) -> None:
    # all timestamps are NTZ wall clock; UTC keeps minute differences free of DST jumps
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def pipeline(spark: SparkSession, sf_dir: str, odd: bool = False, **kw) -> Pipeline:
    """The models of one test-data directory; with `odd` from the feeds that also hold odd rows (landing, quality)."""
    prepare(spark)
    f = Feeds(spark, sf_dir, odd)
    return Pipeline(spark, f.trips_raw(), f.weather_raw(), f.alerts_raw(), f.zones(),
                    **{"bounds": FIXTURE_BOUNDS, **kw})


# --- step 1-3: staging, enrichment, demand, disruption ----------------------------

@query
def q_stg_trips(spark, sf_dir):
    return pipeline(spark, sf_dir).stg_trips


@query
def q_demand_basic(spark, sf_dir):
    return dm.demand_basic(pipeline(spark, sf_dir).stg_trips)


@query
def q_stg_weather(spark, sf_dir):
    return pipeline(spark, sf_dir).stg_weather


@query
def q_trips_weather(spark, sf_dir):
    return pipeline(spark, sf_dir).trips_weather


@query
def q_trip_metrics(spark, sf_dir):
    return pipeline(spark, sf_dir).trip_metrics


@query
def q_demand_zone_hour(spark, sf_dir):
    return pipeline(spark, sf_dir).demand_zone_hour


@query
def q_stg_alerts(spark, sf_dir):
    return pipeline(spark, sf_dir).stg_alerts


@query
def q_alert_hours(spark, sf_dir):
    return ds.alert_hours(pipeline(spark, sf_dir).stg_alerts)


@query
def q_hourly_disruptions(spark, sf_dir):
    return pipeline(spark, sf_dir).hourly_disruptions


@query
def q_disruptions_across_midnight(spark, sf_dir):
    """Hourly disruptions by the hours that alerts really cover, past midnight too."""
    return pipeline(spark, sf_dir, across_midnight=True).hourly_disruptions


@query
def q_local_alerts(spark, sf_dir):
    """Staged alerts on the clock of the trips instead of UTC."""
    return pipeline(spark, sf_dir, alert_tz="America/New_York").stg_alerts


@query
def q_subway_impact(spark, sf_dir):
    return pipeline(spark, sf_dir).subway_impact


# --- step 4: marts -----------------------------------------------------------------

@query
def q_dim_location(spark, sf_dir):
    return pipeline(spark, sf_dir).dim_location


@query
def q_dim_time(spark, sf_dir):
    """Hours of every month that the events reach into, first to last."""
    from metroflux.operators import star
    prepare(spark)
    return star.dim_time(star.spine_of(fx.table(spark, sf_dir, "events"), "ts"))


@query
def q_dim_weather(spark, sf_dir):
    return pipeline(spark, sf_dir).dim_weather


@query
def q_fact_trips(spark, sf_dir):
    return pipeline(spark, sf_dir).fact_trips


@query
def q_surrogate_key(spark, sf_dir):
    """trip_id next to its eight parts, for every staged trip."""
    from metroflux.functions.keys import surrogate_key
    from metroflux.operators.star import TRIP_KEY
    t = pipeline(spark, sf_dir).stg_trips.select(*TRIP_KEY)
    return t.select("*", surrogate_key(t, TRIP_KEY).alias("trip_id"))


# --- step 5: data quality ----------------------------------------------------------

from metroflux.operators import quality as dq  # noqa: E402
from metroflux.plans.suite import models_of, suite  # noqa: E402
from metroflux.schemas import TRIPS_REQUIRED  # noqa: E402

# freshness is judged at fixed instants: soon after the newest fixture trip, more than a week and more than a month later
FRESHNESS_AS_OF = ("2024-03-03 00:00:00", "2024-03-14 00:00:00", "2024-05-01 00:00:00")


def _suite_report(spark, sf_dir, kinds=None):
    """Build the models that tests read once, as tables in a new folder, and test the tables."""
    import uuid
    p = pipeline(spark, sf_dir, odd=True)
    tests = [t for t in suite() if kinds is None or t.kind in kinds]
    needed = {t.model for t in tests} | {t.ref[0] for t in tests if t.ref}
    p.materialize(f"{checkpoint_dir(spark).rstrip('/')}/suite/{uuid.uuid4().hex}",
                  tables=[t for t in p.SUITE_TABLES if t in needed or t in ("stg_trips", "trip_metrics")])
    return dq.run_suite(models_of(p), tests)


@query
def q_dq_not_null(spark, sf_dir):
    return _suite_report(spark, sf_dir, {"not_null"})


@query
def q_dq_unique(spark, sf_dir):
    return _suite_report(spark, sf_dir, {"unique"})


@query
def q_dq_accepted(spark, sf_dir):
    return _suite_report(spark, sf_dir, {"accepted_values"})


@query
def q_dq_freshness(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    return dq.dq_freshness(p.trips_raw, "tpep_pickup_datetime", *FRESHNESS_AS_OF)


@query
def q_dq_orphans(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    return dq.dq_orphans(p.fact_trips, p.dim_location, "pickup_location_id", "location_id",
                         keep=["trip_id", "pickup_location_id"])


@query
def q_dq_coverage(spark, sf_dir):
    return dq.dq_coverage(pipeline(spark, sf_dir).fact_trips)


@query
def q_dq_amount(spark, sf_dir):
    return dq.dq_amount_consistency(pipeline(spark, sf_dir).fact_trips)


@query
def q_dq_speed(spark, sf_dir):
    # the miles bound of staging is lower than the rule's, so it is lifted here: the rule judges what staging let through
    return dq.dq_impossible_speed(pipeline(spark, sf_dir, odd=True, bounds=dict(FIXTURE_BOUNDS, max_miles=200)).fact_trips)


@query
def q_dq_report(spark, sf_dir):
    return _suite_report(spark, sf_dir)


@query
def q_dq_summary(spark, sf_dir):
    return dq.summarize(_suite_report(spark, sf_dir))


@query
def q_batch_stats(spark, sf_dir):
    """B02 per landed batch, from the audit rows that the landing itself kept."""
    from metroflux.sources.lake import Lake
    lake = Lake(spark, _run_folder(spark, "lake"))
    trips = dq.require_columns(pipeline(spark, sf_dir, odd=True).trips_raw, TRIPS_REQUIRED)
    lake.land("trips", trips, _pickup(), INGESTED_AT)
    return lake.batches("trips").where(F.col("outcome") == "accepted").select(
        "row_count", "column_count", "data_year", "data_month", F.lit(True).alias("schema_validated"))


@query
def q_hour_completeness(spark, sf_dir):
    return dq.hour_completeness(pipeline(spark, sf_dir).stg_weather)


@query
def q_alert_profile(spark, sf_dir):
    return dq.alert_profile(pipeline(spark, sf_dir).alerts_raw)


# --- step 6: reports ---------------------------------------------------------------

from metroflux.operators import cube as cb  # noqa: E402
from metroflux.operators import reports as rp  # noqa: E402

# slicers applied in the sliced KPI report
SLICE = {"month": "January", "disrupted": True, "severities": ["light_rain", "heavy_rain", "clear"]}


def _cube(spark, sf_dir):
    return cb.build_cube(pipeline(spark, sf_dir).fact_trips)


def _unfiltered_trips(p):
    """Deduplicated, standardised trips before the validity filter (for outlier profiles)."""
    return stg.standardise_trips(stg.dedupe_trips(p.trips_raw))


@query
def q_kpi(spark, sf_dir):
    return cb.kpi(_cube(spark, sf_dir))


@query
def q_hourly_by_disruption(spark, sf_dir):
    return cb.hourly_by_disruption(_cube(spark, sf_dir))


@query
def q_fare_by_tod(spark, sf_dir):
    return cb.fare_by_tod(_cube(spark, sf_dir))


@query
def q_trips_by_tod(spark, sf_dir):
    return cb.trips_by_tod(_cube(spark, sf_dir))


@query
def q_monthly_volume(spark, sf_dir):
    return cb.monthly_volume(_cube(spark, sf_dir))


@query
def q_sliced_kpi(spark, sf_dir):
    return cb.kpi(rp.slice_by(_cube(spark, sf_dir), **SLICE))


@query
def q_fare_bands(spark, sf_dir):
    return rp.fare_bands(_unfiltered_trips(pipeline(spark, sf_dir)))


@query
def q_outliers(spark, sf_dir):
    return rp.outlier_counts(_unfiltered_trips(pipeline(spark, sf_dir)), FIXTURE_BOUNDS)


@query
def q_negative_adjust(spark, sf_dir):
    return rp.negative_adjustments(pipeline(spark, sf_dir).fact_trips)


@query
def q_dup_profile(spark, sf_dir):
    return rp.duplicate_profile(pipeline(spark, sf_dir).trips_raw,
                                stg.trip_identity(without=("VendorID",)), by="VendorID")


@query
def q_out_of_window(spark, sf_dir):
    return rp.out_of_window(pipeline(spark, sf_dir).trips_raw, FIXTURE_BOUNDS["window_start"],
                            FIXTURE_BOUNDS["window_end"])


@query
def q_reduction(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    return rp.reduction_ratio(p.stg_trips, p.demand_zone_hour)


@query
def q_holiday(spark, sf_dir):
    return cb.holiday_split(_cube(spark, sf_dir))


@query
def q_disruption_gap(spark, sf_dir):
    return cb.disruption_gap(_cube(spark, sf_dir))


@query
def q_report_cube(spark, sf_dir):
    """The cube itself with its sums finished."""
    from metroflux.functions import numeric as nm
    cube = cb.with_trip_label(_cube(spark, sf_dir))
    return cube.select(*cb.KEYS, "trip_time_of_day", "trips", "minutes", *[nm.total(m).alias(m) for m in cb.MEASURES],
                       *[f"{m}_n" for m in cb.MEASURES])


@query
def q_report_pack(spark, sf_dir):
    """All eight reports from one written cube: the trips are read once."""
    path = f"{_run_folder(spark, 'cube')}/report_cube"
    built = _cube(spark, sf_dir)
    built.write.parquet(path)
    cube = spark.read.schema(built.schema).parquet(path)
    return cb.report_pack(cube, rp.slice_by(cube, **SLICE))


# --- step 7: landing and JSON feeds ------------------------------------------------

from metroflux.sources import fixtures as fx  # noqa: E402
from metroflux.sources import json_feeds as jf  # noqa: E402
from metroflux.session import checkpoint_dir  # noqa: E402

# load stamp of the fixture runs (an argument, never the clock)
INGESTED_AT = "2024-02-01T00:00:00"


@query
def q_flatten_weather(spark, sf_dir):
    prepare(spark)
    return jf.flatten_weather_json(fx.weather_json_docs(fx.table(spark, sf_dir, "events")))


@query
def q_flatten_alerts(spark, sf_dir):
    prepare(spark)
    parsed = jf.parse_alert_entities(fx.alert_json_docs(fx.table(spark, sf_dir, "events")))
    return jf.flatten_alert_json(parsed, ingested_at=INGESTED_AT)


@query
def q_feed_rejects(spark, sf_dir):
    """How many documents or entities of each JSON feed could not be read."""
    prepare(spark)
    events = fx.table(spark, sf_dir, "events")
    rejects = {"alerts": jf.alert_rejects(jf.parse_alert_entities(fx.alert_json_docs(events))),
               "weather": jf.weather_rejects(fx.weather_json_docs(events))}
    counts = [df.agg(F.count(F.lit(1)).alias("rejects")).select(F.lit(feed).alias("feed"), "rejects") for feed, df in rejects.items()]
    return counts[0].unionByName(counts[1])


def _run_folder(spark, name):
    """A new folder per run: what an earlier run or another table folder landed is never read."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


def _pickup():
    return F.col("tpep_pickup_datetime")


def _near_zones():
    """Trips cluster by pickup zone, drop-off zone and hour: zone numbers fit 9 bits, hours 5."""
    return [(F.col("PULocationID"), 9), (F.col("DOLocationID"), 9), (F.hour(_pickup()), 5)]


def _land_all(spark, sf_dir):
    """The three raw feeds in a new lake, each in one parse and one write; the JSON feeds come with their rejects."""
    from metroflux.functions.calendar import from_epoch_seconds, parse_iso_minute
    from metroflux.sources.lake import Lake
    p = pipeline(spark, sf_dir, odd=True)
    lake = Lake(spark, _run_folder(spark, "lake"))
    lake.land("trips", p.trips_raw, _pickup(), INGESTED_AT, near=_near_zones())
    weather = jf.weather_rows(fx.weather_json_docs(fx.table(spark, sf_dir, "events"), odd=True))
    lake.land("weather", weather, parse_iso_minute("datetime_hour"), INGESTED_AT, reject=F.col("reject"))
    lake.land("mta_alerts", p.alerts_raw, from_epoch_seconds(F.expr("try_cast(start_time as bigint)")), INGESTED_AT)
    return lake


@query
def q_load_manifest(spark, sf_dir):
    """Land the three raw feeds into the shared lake, report rows per batch."""
    batches = _land_all(spark, sf_dir).batches().where(F.col("outcome") == "accepted")
    return batches.select("source", "data_year", "data_month", "row_count", F.lit("success").alias("status"))


@query
def q_landing_balance(spark, sf_dir):
    """Per source how many rows a landing brought, and what became of them."""
    rows = lambda outcome: F.coalesce(F.sum(F.when(F.col("outcome") == outcome, F.col("row_count"))), F.lit(0))
    return _land_all(spark, sf_dir).batches().groupBy("source").agg(
        F.sum("row_count").alias("input_rows"), rows("accepted").alias("accepted"), rows("rejected").alias("rejected"))


@query
def q_landed_trips(spark, sf_dir):
    """The landed trips themselves, with their batch, day and audit columns."""
    from metroflux.sources.lake import Lake
    lake = Lake(spark, _run_folder(spark, "lake"))
    lake.land("trips", pipeline(spark, sf_dir, odd=True).trips_raw, _pickup(), INGESTED_AT, near=_near_zones())
    return lake.read("trips").withColumns({"year": F.col("year").cast("string"), "month": F.lpad(F.col("month").cast("string"), 2, "0"),
                                           "day": F.col("day").cast("string")})


@query
def q_landed_rejects(spark, sf_dir):
    """The trips that belong to no batch, as a table, with the reason."""
    from metroflux.sources.lake import Lake
    lake = Lake(spark, _run_folder(spark, "lake"))
    lake.land("trips", pipeline(spark, sf_dir, odd=True).trips_raw, _pickup(), INGESTED_AT)
    return lake.rejects("trips").select("tpep_dropoff_datetime", "VendorID", "PULocationID", "DOLocationID", "fare_amount",
                                        "_ingested_at", F.col("_reject").alias("reason"))


@query
def q_landed_zone(spark, sf_dir):
    """Trips into one zone from the clustered table: footers rule out the files whose range lacks it."""
    from metroflux.sources.lake import Lake
    lake = Lake(spark, _run_folder(spark, "lake"))
    lake.land("trips", pipeline(spark, sf_dir, odd=True).trips_raw, _pickup(), INGESTED_AT, near=_near_zones())
    zone = lake.read("trips").where(F.col("DOLocationID") == 77)
    return zone.select("tpep_pickup_datetime", "PULocationID", "DOLocationID", "trip_distance", "fare_amount")


@query
def q_landed_alerts(spark, sf_dir):
    """Alert entities land unpartitioned, a batch twice; readable rows come back once, unreadable entities as their text."""
    from metroflux.sources.lake import Lake
    lake = Lake(spark, _run_folder(spark, "lake"))
    rows = jf.alert_rows(fx.alert_json_docs(fx.table(spark, sf_dir, "events")), ingested_at=INGESTED_AT)
    for _ in range(2):
        lake.land("alerts", rows, None, INGESTED_AT, feed="2024-01", reject=F.col("reject"))
    columns = ["alert_id", "subway_line", "cause", "effect", "header_text", "start_time", "end_time", "reject"]
    return lake.read("alerts").select(*columns).unionByName(lake.rejects("alerts").select(*columns))


def _land_drifting(spark, sf_dir):
    """Trips in a feed up to January 2024 and one after it, whose columns have drifted."""
    from metroflux.sources.lake import Lake
    trips = pipeline(spark, sf_dir, odd=True).trips_raw
    later = F.coalesce(_pickup() >= F.lit("2024-02-01").cast("timestamp_ntz"), F.lit(False))
    drifted = trips.where(later).withColumns({
        "passenger_count": F.col("passenger_count").cast("double"), "RatecodeID": F.col("RatecodeID").cast("int"),
        "booking": F.when(F.col("VendorID") == 1, "app")}).withColumnRenamed("Airport_fee", "airport_fee").drop("cbd_congestion_fee")
    lake = Lake(spark, _run_folder(spark, "lake"))
    lake.land("trips", trips.where(~later), _pickup(), INGESTED_AT, feed="to 2024-01")
    lake.land("trips", drifted, _pickup(), INGESTED_AT, feed="after 2024-01")
    return lake


@query
def q_landed_drift(spark, sf_dir):
    """Trips of two feeds with differing columns, read back under the merged schema."""
    from metroflux.schemas import TRIPS_RAW
    return _land_drifting(spark, sf_dir).read("trips", TRIPS_RAW).select(
        "tpep_pickup_datetime", "VendorID", "passenger_count", "RatecodeID", "PULocationID", "DOLocationID", "fare_amount",
        "Airport_fee", "cbd_congestion_fee", "booking")


@query
def q_schema_drift(spark, sf_dir):
    """What drifted between the feeds, with the accepted rows that each departure concerns."""
    from metroflux.schemas import TRIPS_RAW
    lake = _land_drifting(spark, sf_dir)
    rows = lake.batches("trips").where(F.col("outcome") == "accepted").groupBy(F.col("feed").alias("batch")).agg(
        F.sum("row_count").alias("row_count"))
    return lake.drift("trips", TRIPS_RAW).join(rows, "batch")


# --- step 8: the same operators on a second shape ----------------------------------

from metroflux.operators.dedupe import dedupe  # noqa: E402
from metroflux.operators.star import dim_nation, orders_star  # noqa: E402


@query
def q_dedupe_lineitem(spark, sf_dir):
    """One line per (order, line number); the smallest line over all other columns survives."""
    prepare(spark)
    return dedupe(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def q_orders_star(spark, sf_dir):
    prepare(spark)
    t = lambda n: fx.table(spark, sf_dir, n)
    return orders_star(t("orders"), t("customer"), dim_nation(t("nation"), t("region")))


@query
def q_dq_lineitem_orphans(spark, sf_dir):
    """Lines whose order is not among the settled ones (all lines have an order, so a part of the orders is the dimension)."""
    prepare(spark)
    settled = fx.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return dq.dq_orphans(fx.table(spark, sf_dir, "lineitem"), settled,
                         "l_orderkey", "o_orderkey", keep=["l_orderkey", "l_linenumber"])


@query
def q_incremental_landing(spark, sf_dir):
    """Land raw trips by month, stream the batches into the raw table, land one again, report rows per month."""
    from metroflux.schemas import TRIPS_RAW
    from metroflux.sources.landing import load_month, load_months
    from metroflux.sources.readers import read_landed
    from metroflux.streaming.incremental import refresh_new_batches
    root = _run_folder(spark, "incremental")
    trips = pipeline(spark, sf_dir, odd=True).trips_raw
    args = (spark, f"{root}/landing/trips", f"{root}/raw_trips", f"{root}/_checkpoint", TRIPS_RAW)
    load_months(trips, f"{root}/landing", "trips", _pickup())
    refresh_new_batches(*args)
    january = trips.where(F.date_format(_pickup(), "yyyy-MM") == "2024-01")
    load_month(january, f"{root}/landing", "trips", 2024, 1)
    refresh_new_batches(*args)
    raw = read_landed(spark, f"{root}/raw_trips")
    return raw.groupBy(F.col("year").cast("string").alias("data_year"),
                       F.lpad(F.col("month").cast("string"), 2, "0").alias("data_month")).agg(
        F.count(F.lit(1)).alias("row_count"))
