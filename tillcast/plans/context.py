"""Lazily built, shared DataFrames for one (session, data folder).

Nothing here is cached in memory or collected: each property is a logical plan (only
``category_points`` is a staged table), and
Catalyst prunes / pushes down per query. In production ``item_sales`` would be the
stored, date-partitioned fact (``tillcast.sources.tables.write_fact``); with the test
data it is derived from the raw tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tillcast.operators import enrich, events, series, summarize
from tillcast.sources import testdata


class Tables:
    """The engine's input tables and the views built on them.

    Give stored tables directly (``fact``, ``locations``, ``weather``,
    ``forecast_weather``, ``local_events``), e.g. from ``Tables.from_parquet``; any
    table not given is derived from the test data in ``sf_dir``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, as_of: str = testdata.AS_OF,
                 fact: DataFrame | None = None, locations: DataFrame | None = None,
                 weather: DataFrame | None = None, forecast_weather: DataFrame | None = None,
                 local_events: DataFrame | None = None, root: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.root = root            # where jobs publish models and results
        self.derived = False        # whether results are published on demand (test data)
        self._given = {"item_sales": fact, "locations": locations, "weather": weather,
                       "forecast_weather": forecast_weather, "local_events": local_events}

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, as_of: str) -> "Tables":
        """Stored tables under ``root``: item_sales (date-partitioned), locations,
        local_weather, weather_forecast, local_events."""
        from tillcast.sources.tables import read_fact
        rd = spark.read.parquet
        return cls(spark, None, as_of, fact=read_fact(spark, f"{root}/item_sales"),
                   locations=rd(f"{root}/locations"), weather=rd(f"{root}/local_weather"),
                   forecast_weather=rd(f"{root}/weather_forecast"), local_events=rd(f"{root}/local_events"), root=root)

    def _get(self, name, derive):
        given = self._given[name]
        if given is not None:
            return given
        if self.sf_dir is None:
            raise ValueError(f"table {name} was not given and there is no test-data folder")
        return derive(self.spark, self.sf_dir)

    @cached_property
    def item_sales(self) -> DataFrame:
        return self._get("item_sales", testdata.item_sales)

    @cached_property
    def category_points(self) -> DataFrame:
        """The fact per category and day, staged once for all series work."""
        return series.category_points(self.item_sales)

    @cached_property
    def locations(self) -> DataFrame:
        return self._get("locations", testdata.locations)

    @cached_property
    def weather(self) -> DataFrame:
        return self._get("weather", testdata.local_weather)

    @cached_property
    def forecast_weather(self) -> DataFrame:
        return self._get("forecast_weather", testdata.weather_forecast)

    @cached_property
    def local_events(self) -> DataFrame:
        return self._get("local_events", testdata.local_events)

    @cached_property
    def expanded_events(self) -> DataFrame:
        return events.expand_events(self.local_events)

    @cached_property
    def day_events(self) -> DataFrame:
        return events.day_events(self.expanded_events)

    @cached_property
    def view(self) -> DataFrame:
        return enrich.analytics_view(self.item_sales, self.locations, self.weather, self.day_events)

    def written_view(self) -> DataFrame:
        """The view laid out to be written whole, event texts on every sale; measures the texts first."""
        return enrich.analytics_view(self.item_sales, self.locations, self.weather, self.day_events,
                                     enrich.text_partitions(self.day_events))

    @cached_property
    def daily_summary(self) -> DataFrame:
        return summarize.daily_summary(self.item_sales, self.locations, self.weather, self.day_events)


_CACHE: dict = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    key = (id(spark), sf_dir)
    t = _CACHE.get(key)
    if t is None or t.spark is not spark:
        t = _CACHE[key] = Tables(spark, sf_dir)
    return t
