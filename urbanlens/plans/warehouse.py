"""The model DAG as lazily built DataFrames.

``Warehouse(spark, sf_dir)`` derives the raw role frames from the driver's
tables and exposes every model as an attribute. Nothing runs until an action;
each attribute is built once per object, so queries that share a model share
its plan (and Spark's exchange reuse can share its shuffle within a query).

``Warehouse.from_marts(spark, paths)`` instead reads marts that ``publish``
wrote earlier, which is how the analytic queries run in production.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.plans import intermediate as I
from urbanlens.plans import marts as M
from urbanlens.plans import staging as S
from urbanlens.plans import testbed as T
from urbanlens.functions import columns as X
from urbanlens.operators import resolve as E
from urbanlens.session import land

_SEED_PATHS: dict[tuple, str] = {}

MART_NAMES = ("dim_date", "dim_station", "dim_weather", "dim_delay_codes",
              "fct_transit_delays", "fct_bike_trips", "fct_daily_mobility")


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None, persist_refs: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.persist_refs = persist_refs
        self._marts: dict[str, DataFrame] = {}
        self._stored: Callable[[str], str] | None = None

    @classmethod
    def stored(cls, spark: SparkSession, sf_dir: str, folder_of: Callable[[str], str]) -> Warehouse:
        """Marts are read from the folders that ``folder_of`` names, each when it is first used."""
        wh = cls(spark, sf_dir)
        wh._stored = folder_of
        return wh

    @classmethod
    def from_marts(cls, spark: SparkSession, paths: dict[str, str], cache_small: bool = False) -> Warehouse:
        """Read published marts from their folders. ``cache_small`` keeps the marts whose size is bounded by
        the domain (dimensions, and the daily fact: one row per day) in executor memory
        for a serving session that queries them repeatedly; the event facts stay on
        parquet, where pruning applies."""
        wh = cls(spark, None)
        for name in MART_NAMES:
            df = spark.read.parquet(paths[name])
            if cache_small and name not in ("fct_transit_delays", "fct_bike_trips"):
                df = df.cache()
            wh._marts[name] = df
        return wh

    def _ref(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Reference tables (the seeds) are written once per session and input folder and
        then read back by every query that needs them."""
        if not self.persist_refs:
            return df
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _SEED_PATHS:
            _SEED_PATHS[key] = land(df, name, partition_by)
        return self.spark.read.parquet(_SEED_PATHS[key])

    def _once(self, df: DataFrame, name: str) -> DataFrame:
        """A raw feed for a model that reads it in one pass: the landed table if the session has
        it, else the rows as they are derived. These are not written, and only the columns and
        the rows that the query asks for are rendered."""
        return self._ref(df, name) if (self.spark.sparkContext.applicationId, self.sf_dir, name) in _SEED_PATHS else df

    def _mart(self, name: str, build) -> DataFrame:
        if name not in self._marts:
            self._marts[name] = self.spark.read.parquet(self._stored(name)) if self._stored else build()
        return self._marts[name]

    # --- raw role frames: landed once per session as text tables (S02), like the
    # RAW layer of the source system; what reads a feed in one pass needs no landed table
    @cached_property
    def raw_incidents(self) -> DataFrame:
        # a folder for each mode: the models of one mode don't read the others
        return self._ref(T.raw_incidents(self.spark, self.sf_dir), "raw_incidents", ("transit_mode",))

    def _raw_mode(self, mode: str, incidents: DataFrame | None = None) -> DataFrame:
        inc = (self.raw_incidents if incidents is None else incidents).filter(F.col("transit_mode") == mode)
        if mode == "subway":
            return inc.select("date", "time", "day", "station", "code", "min_delay", "min_gap", "bound", "line")
        return inc.select("date", "route", "time", "day", "location", F.col("code").alias("delay_code"),
                          "min_delay", "min_gap", F.col("bound").alias("direction"))

    @cached_property
    def raw_subway(self) -> DataFrame:
        return self._raw_mode("subway")

    @cached_property
    def raw_bus(self) -> DataFrame:
        return self._raw_mode("bus")

    @cached_property
    def raw_streetcar(self) -> DataFrame:
        return self._raw_mode("streetcar")

    @cached_property
    def raw_trips(self) -> DataFrame:
        return self._ref(T.raw_trips(self.spark, self.sf_dir), "raw_trips")

    @cached_property
    def subway_feed(self) -> DataFrame:
        return self._raw_mode("subway", self._once(T.raw_incidents(self.spark, self.sf_dir), "raw_incidents"))

    @cached_property
    def trips_feed(self) -> DataFrame:
        trips = T.raw_trips(self.spark, self.sf_dir)
        # a row of its own for the start's text: a filter on the time would render it a second time
        return self._once(trips.withColumn("start_time", F.explode(F.array("start_time"))), "raw_trips")

    @cached_property
    def raw_weather(self) -> DataFrame:
        return self._ref(T.raw_weather(self.spark, self.sf_dir), "raw_weather")

    # --- reference tables -------------------------------------------------------
    @cached_property
    def bike_station_ref(self) -> DataFrame:
        return self._ref(M.station_ref_from_feed(T.bike_feed(self.spark, self.sf_dir)), "bike_station_ref")

    @cached_property
    def subway_registry(self) -> DataFrame:
        return T.subway_registry(self.spark, self.sf_dir)

    @cached_property
    def subway_coords(self) -> DataFrame:
        return T.subway_coords(self.spark, self.sf_dir)

    @cached_property
    def station_mapping(self) -> DataFrame:
        """E01 over the distinct raw subway names (with their primary line, A23)."""
        # the vocabulary (distinct raw names with their primary line) is persisted
        # once; every resolution rule then reads that small table, not the raw feed
        names = self._ref(E.primary_lines(self.raw_subway), "subway_name_vocabulary")
        reg = self.subway_registry
        return self._ref(E.resolve_names(names, T.station_lookup(reg), reg, T.station_overrides(self.spark)),
                         "station_mapping")

    @cached_property
    def delay_codes(self) -> DataFrame:
        """E09/E10 over the distinct codes of the three sources."""
        counts = E.code_counts((self.raw_subway, "code"), (self.raw_bus, "delay_code"),
                               (self.raw_streetcar, "delay_code"))
        return self._ref(E.classify_codes(counts, T.suffix_descriptions(self.spark),
                                          T.description_overrides(self.spark)), "delay_codes")

    # --- staging --------------------------------------------------------------
    @cached_property
    def stg_subway(self) -> DataFrame:
        return S.stg_subway(self.raw_subway)

    @cached_property
    def stg_bus(self) -> DataFrame:
        return S.stg_surface(self.raw_bus, "bus")

    @cached_property
    def stg_streetcar(self) -> DataFrame:
        return S.stg_surface(self.raw_streetcar, "streetcar")

    @cached_property
    def stg_trips(self) -> DataFrame:
        return S.stg_trips(self.trips_feed)

    @cached_property
    def stg_weather(self) -> DataFrame:
        return S.stg_weather(self.raw_weather)

    # --- intermediate -----------------------------------------------------------
    @cached_property
    def delays_unioned(self) -> DataFrame:
        return I.delays_unioned(self.stg_subway, self.stg_bus, self.stg_streetcar)

    @cached_property
    def delays_enriched(self) -> DataFrame:
        return I.delays_enriched(self.delays_unioned, self.station_mapping, self.delay_codes)

    @cached_property
    def trips_enriched(self) -> DataFrame:
        return I.trips_enriched(self.stg_trips, self.bike_station_ref)

    @cached_property
    def daily_transit(self) -> DataFrame:
        return I.daily_transit(self.delays_enriched)

    @cached_property
    def daily_bike(self) -> DataFrame:
        return I.daily_bike(self.trips_enriched)

    # --- marts ----------------------------------------------------------------
    @property
    def dim_date(self) -> DataFrame:
        def build() -> DataFrame:
            # bounds of the spine from one scan of the incidents (dedup never removes a
            # date, so the pre-dedup dates have the same min/max) and of the trips
            inc = self.raw_incidents.filter(X.safe_int("min_delay") > 0).select(X.strict_date("date").alias("d"))
            return M.dim_date_over((inc, "d"), (self.stg_trips, F.to_date("start_time")))
        return self._mart("dim_date", lambda: self._ref(build(), "dim_date"))

    @property
    def dim_station(self) -> DataFrame:
        return self._mart("dim_station", lambda: M.dim_station(
            self.station_mapping, self.subway_coords, self.bike_station_ref))

    @property
    def dim_weather(self) -> DataFrame:
        return self._mart("dim_weather", lambda: M.dim_weather(self.stg_weather))

    @property
    def dim_delay_codes(self) -> DataFrame:
        return self._mart("dim_delay_codes", lambda: M.dim_delay_codes(self.delay_codes))

    @property
    def fct_transit_delays(self) -> DataFrame:
        return self._mart("fct_transit_delays", lambda: M.fct_transit_delays(self.delays_enriched))

    @property
    def fct_bike_trips(self) -> DataFrame:
        return self._mart("fct_bike_trips", lambda: M.fct_bike_trips(self.trips_enriched))

    @property
    def fct_daily_mobility(self) -> DataFrame:
        return self._mart("fct_daily_mobility", lambda: M.fct_daily_mobility(
            self.daily_transit, self.daily_bike))

    def marts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in MART_NAMES}
