"""The end-to-end model graph, built lazily from four raw feeds.

    trips_raw -> stg_trips --+
    weather_raw -> stg_weather -+-> trips_weather -> trip_metrics -+-> demand_zone_hour -+
    alerts_raw -> stg_alerts -> hourly_disruptions -----------------+--------------------+-> subway_impact
    zones -> dim_location ; window -> dim_time ; stg_weather -> dim_weather
    trip_metrics + subway_impact + dim_location x2 + dim_time -> fact_trips

Every model is a DataFrame; nothing runs until an action. `materialize()`
writes the table models to Parquet under the shared checkpoint folder and
swaps the lazy plan for a read of the written table, which cuts lineage so a
lost executor recomputes from the written table, not from the raw feeds.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.operators import demand as dm
from metroflux.operators import disruption as ds
from metroflux.operators import enrich as en
from metroflux.operators import staging as stg
from metroflux.operators import star
from metroflux.operators.quality import require_unique
from metroflux.schemas import TRIP_BOUNDS
from metroflux.session import checkpoint_dir


class Pipeline:
    def __init__(self, spark: SparkSession, trips_raw: DataFrame, weather_raw: DataFrame,
                 alerts_raw: DataFrame, zones: DataFrame, bounds: dict | None = None,
                 across_midnight: bool = False, assert_unique: bool = False, alert_tz: str | None = None):
        self.spark = spark
        self.trips_raw, self.weather_raw, self.alerts_raw, self.zones = trips_raw, weather_raw, alerts_raw, zones
        self.bounds = dict(TRIP_BOUNDS, **(bounds or {}))
        self.across_midnight = across_midnight
        self.alert_tz = alert_tz
        # As in the source, a repeated weather hour or zone fans trips out and the fact keeps
        # one row per trip_id at the end. With assert_unique such a repeat makes the run
        # fail and is named; no join can then fan out, and the last dedupe (a shuffle of the
        # widest table) is left out.
        self.assert_unique = assert_unique
        self._written: dict[str, DataFrame] = {}

    def _model(self, name: str, build) -> DataFrame:
        return self._written[name] if name in self._written else build()

    # --- staging (views) ----------------------------------------------------
    @property
    def stg_trips(self) -> DataFrame:
        return self._model("stg_trips", lambda: stg.stage_trips(self.trips_raw, self.bounds))

    @cached_property
    def stg_weather(self) -> DataFrame:
        return stg.stage_weather(self.weather_raw)

    @cached_property
    def stg_alerts(self) -> DataFrame:
        return stg.stage_alerts(self.alerts_raw, self.alert_tz)

    # --- intermediate (tables) ----------------------------------------------
    @property
    def trips_weather(self) -> DataFrame:
        return self._model("trips_weather", lambda: en.join_weather(
            self.stg_trips, self.stg_weather, assert_unique=self.assert_unique))

    @property
    def trip_metrics(self) -> DataFrame:
        return self._model("trip_metrics", lambda: en.trip_metrics(self.trips_weather))

    @property
    def demand_zone_hour(self) -> DataFrame:
        return self._model("demand_zone_hour", lambda: dm.demand_zone_hour(self.trip_metrics))

    @property
    def hourly_disruptions(self) -> DataFrame:
        return self._model("hourly_disruptions", lambda: ds.hourly_disruptions(
            self.stg_alerts, self.across_midnight))

    @property
    def window_disruptions(self) -> DataFrame:
        """Hourly disruptions of the analysis window: at most `time_rows` rows, all that trips can meet."""
        start, end = (F.to_date(F.lit(self.bounds[k])) for k in ("window_start", "window_end"))
        return self.hourly_disruptions.where(F.col("alert_date").between(start, end))

    @property
    def subway_impact(self) -> DataFrame:
        return self._model("subway_impact", lambda: ds.subway_impact(
            self.demand_zone_hour, self.window_disruptions, at_most_rows=self.time_rows + 24))

    # --- marts (tables) -----------------------------------------------------
    @property
    def dim_location(self) -> DataFrame:
        return self._model("dim_location", lambda: star.dim_location(self.zones))

    @property
    def fact_locations(self) -> DataFrame:
        loc = self.dim_location
        return require_unique(loc, ["location_id"]) if self.assert_unique else loc

    @property
    def time_rows(self) -> int:
        return star.spine_rows(self.bounds["window_start"], self.bounds["window_end"])

    @property
    def dim_time(self) -> DataFrame:
        return self._model("dim_time", lambda: star.dim_time(star.date_spine(
            self.spark, self.bounds["window_start"], self.bounds["window_end"])))

    @property
    def dim_weather(self) -> DataFrame:
        return self._model("dim_weather", lambda: star.dim_weather(self.stg_weather))

    @property
    def fact_trips(self) -> DataFrame:
        return self._model("fact_trips", lambda: star.fact_trips(
            self.trip_metrics, self.window_disruptions, self.fact_locations, self.dim_time,
            time_rows=self.time_rows, disruption_rows=self.time_rows + 24, final_dedupe=not self.assert_unique))

    # --- materialisation ------------------------------------------------------
    TABLES = ["trips_weather", "trip_metrics", "demand_zone_hour", "hourly_disruptions", "subway_impact",
              "dim_location", "dim_time", "dim_weather", "fact_trips"]
    # for the test suite also the staged trips are worth a table: three models read them
    SUITE_TABLES = ["stg_trips", *TABLES]
    PARTITION_BY = {"stg_trips": ["pickup_date"], "trips_weather": ["pickup_date"], "trip_metrics": ["pickup_date"], "fact_trips": ["pickup_date"],
                    "demand_zone_hour": ["pickup_date"], "subway_impact": ["pickup_date"]}

    def materialize(self, root: str | None = None, tables: list[str] | None = None) -> dict[str, str]:
        """Write the table models in dependency order (full refresh) and read them back.

        A refresh replaces the whole table, whatever the session's overwrite mode. Rows are
        rebalanced by date first, so that a date is one file or several of the advisory
        size and not one per task; AQE splits a large date and merges small ones.
        """
        root = (root or f"{checkpoint_dir(self.spark).rstrip('/')}/models").rstrip("/")
        paths = {}
        for name in tables or self.TABLES:
            df = getattr(self, name)
            path = f"{root}/{name}"
            by = self.PARTITION_BY.get(name, [])
            if by:
                df = df.hint("rebalance", *[F.col(c) for c in by])
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)
            # explicit schema: partition columns come back typed, not as text
            self._written[name] = self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
            paths[name] = path
        return paths
