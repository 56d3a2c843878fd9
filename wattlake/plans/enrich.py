"""Season, geographic group and weather of consumption rows, and how rows are made ready for models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions import dates
from wattlake.operators import geo, rows
from wattlake.sources import weather

#: Columns that models don't get.
IDENTIFIERS = ["unit_id", "device_id", "device_version", "data_instalacao", "data_inicio_automacao", "metodo", "latitude", "longitude"]


def with_season(df: DataFrame, day: str = "data") -> DataFrame:
    return df.withColumn("estacao", dates.season_of_day(day))


def with_groups(df: DataFrame, radius_km: float = 40.0, min_samples: int = 2, reference: DataFrame | None = None) -> DataFrame:
    """Adds grupo_regional: of *reference* if given, else of clusters of the coordinates in *df*."""
    reference = reference if reference is not None else geo.clusters(df, radius_km, min_samples)
    return geo.assign(df, reference.select("latitude", "longitude", "grupo_regional"))


def with_weather(df: DataFrame, cache: DataFrame, day: str = "data") -> DataFrame:
    """Adds the eight measures of the row's hour and place."""
    return weather.attach(df.withColumn("data_str", F.date_format(day, "yyyy-MM-dd")), cache).drop("data_str")


def enriched(df: DataFrame, cache: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    return with_weather(with_groups(with_season(df), reference=reference), cache)


def weather_work(df: DataFrame, cache: DataFrame, day: str = "data") -> DataFrame:
    """The places and days whose weather is still to be fetched."""
    return weather.missing_keys(df.withColumn("data_str", F.date_format(day, "yyyy-MM-dd")), cache)


def final_table(df: DataFrame) -> DataFrame:
    return rows.for_model(df, IDENTIFIERS)
