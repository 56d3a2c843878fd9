"""Hourly weather: responses, the cache table, and joining it to consumption."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.operators.rows import one_of_each
from wattlake.sources import versions

KEY = ["latitude", "longitude", "data_str"]
# Names in the response and in the tables.
MEASURES = {
    "temperature_2m": "Temperatura_C",
    "apparent_temperature": "Temperatura_Percebida_C",
    "relative_humidity_2m": "Umidade_Relativa_%",
    "precipitation": "Precipitacao_mm",
    "wind_speed_10m": "Velocidade_Vento_kmh",
    "surface_pressure": "Pressao_Superficial_hPa",
    "direct_normal_irradiance": "Irradiancia_Direta_Wm2",
    "diffuse_radiation": "Irradiancia_Difusa_Wm2",
}
SCHEMA = "struct<hourly: struct<time: array<string>, " + ", ".join(f"{m}: array<double>" for m in MEASURES) + ">>"


def parse_responses(responses: DataFrame, body: str = "body", measures: dict[str, str] = MEASURES) -> DataFrame:
    """One row for each hour of each response (latitude, longitude, body): the parallel arrays side by side."""
    hourly = F.from_json(body, SCHEMA)["hourly"]
    rows = responses.select("latitude", "longitude", hourly.alias("_h")).select("latitude", "longitude", F.explode(F.arrays_zip("_h.time", *[f"_h.{m}" for m in measures])).alias("_r"))
    at = F.try_to_timestamp(F.col("_r.time"), F.lit("yyyy-MM-dd'T'HH:mm")).cast("timestamp_ntz")
    return rows.select("latitude", "longitude", F.date_format(at, "yyyy-MM-dd").alias("data_str"), F.hour(at).cast("bigint").alias("hora"), *[F.col(f"_r.{m}").alias(n) for m, n in measures.items()])


def cached_keys(cache: DataFrame) -> DataFrame:
    return cache.select(*KEY).distinct()


def missing_keys(df: DataFrame, cache: DataFrame) -> DataFrame:
    """The coordinates and days of *df* that the cache lacks: each once, without nulls."""
    wanted = df.select(*KEY).filter(" and ".join(f"{k} is not null" for k in KEY)).distinct()
    return wanted.join(cached_keys(cache), KEY, "left_anti")


def attach(df: DataFrame, cache: DataFrame) -> DataFrame:
    """*df* with the weather of its hour; rows without any keep nulls.  Coordinates must be equal; of an hour's several rows the fullest counts."""
    return df.join(one_of_each(cache, [*KEY, "hora"]), [*KEY, "hora"], "left")


def extended(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache with the hours of *new* that it lacks."""
    key = [*KEY, "hora"]
    return cache.unionByName(one_of_each(new, key).join(cache.select(*key), key, "left_anti"))


def extend_cache(new: DataFrame, path: str) -> int:
    """Adds the hours of *new* that the cache in *path* lacks, as its next version; returns that version's number."""
    return versions.append(new, path, [*KEY, "hora"])
