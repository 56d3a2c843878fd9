"""The star-schema test tables in the roles of telemetry and reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.sources.weather import MEASURES

TYPES = {"click": "splitao", "view": "Split-Wall", "purchase": "self", "signup": "piso-teto"}

TELEMETRY = """tel AS (SELECT event_id, 'D' || lpad(CAST(user_id % 7 AS VARCHAR), 7, '0') || lpad(CAST(user_id AS VARCHAR), 4, '0') AS device_id,
  user_id % 10 AS unit_id, CASE event_type WHEN 'click' THEN 'splitao' WHEN 'view' THEN 'Split-Wall' WHEN 'purchase' THEN 'self' WHEN 'signup' THEN 'piso-teto' ELSE ' ' END AS machine_type,
  CAST(ts AS DATE) AS data, CAST(extract(hour FROM ts) AS BIGINT) AS hora, ts, value AS consumo_kwh, props FROM events)"""
POINTS = """pts AS (SELECT DISTINCT -33.0::DOUBLE + (s_suppkey * 7919 % 2800)::DOUBLE / 100::DOUBLE AS latitude, -60.0::DOUBLE + (s_suppkey * 104729 % 2500)::DOUBLE / 100::DOUBLE AS longitude FROM supplier)"""
PAYLOAD = """rle AS (SELECT user_id, CAST(ts AS DATE) AS day, '{"Curr":"' || string_agg(CASE WHEN event_id % 17 = 0 THEN '*60' WHEN event_id % 19 = 0 THEN 'abc*10' WHEN event_id % 23 = 0 THEN CAST(event_id % 9 AS VARCHAR)
  ELSE CAST(event_id % 97 AS VARCHAR) || '.5*' || CAST(event_id % 9000 + 1 AS VARCHAR) END, ',' ORDER BY event_id) || '"}' AS charts_detailed FROM events GROUP BY 1, 2)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def device(key: str):
    return F.concat(F.lit("D"), F.lpad((F.col(key) % 7).cast("string"), 7, "0"), F.lpad(F.col(key).cast("string"), 4, "0"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.lit(" ")
    for event, name in TYPES.items():
        kind = F.when(F.col("event_type") == event, name).otherwise(kind)
    return table(spark, sf_dir, "events").select(
        "event_id", device("user_id").alias("device_id"), (F.col("user_id") % 10).alias("unit_id"), kind.alias("machine_type"), F.col("ts").cast("date").alias("data"), F.hour("ts").cast("bigint").alias("hora"),
        "ts", F.col("value").alias("consumo_kwh"), "props",
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    lat, lon = F.lit(-33.0) + (key * 7919 % 2800).cast("double") / 100.0, F.lit(-60.0) + (key * 104729 % 2500).cast("double") / 100.0
    return table(spark, sf_dir, "supplier").select("s_suppkey", lat.alias("latitude"), lon.alias("longitude"))


def run_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dev_id, day, charts_detailed): a payload of run-length encoded samples for each user and day."""
    e = F.col("event_id")
    part = F.when(e % 17 == 0, "*60").when(e % 19 == 0, "abc*10").when(e % 23 == 0, (e % 9).cast("string")).otherwise(F.concat((e % 97).cast("string"), F.lit(".5*"), (e % 9000 + 1).cast("string")))
    ordered = F.array_sort(F.collect_list(F.struct(e.alias("i"), part.alias("p"))))
    grouped = table(spark, sf_dir, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.array_join(ordered["p"], ",").alias("parts"))
    return grouped.select(F.concat(F.lit("DAC"), F.col("user_id").cast("string")).alias("dev_id"), "day", F.concat(F.lit('{"Curr":"'), F.col("parts"), F.lit('"}')).alias("charts_detailed"))


_MEASURES = [*MEASURES.values(), "consumo_lag_1h", "consumo_lag_24h", "consumo_rolling_mean_3h"]
#: Enriched rows: the telemetry with made-up measures (the first of which lacks in some rows), season and group.
OBSERVED = TELEMETRY + ", obs AS (SELECT event_id, hora, data, consumo_kwh, machine_type, 'verao' AS estacao, CAST(unit_id % 5 AS INTEGER) AS grupo_regional, " + ", ".join(
    ("CASE WHEN event_id % 41 <> 0 THEN " if not i else "") + f"consumo_kwh * {i + 2} / 16 + CAST(event_id * {7919 + i} % 1000 AS DOUBLE) / 8" + (" END" if not i else "") + f' AS "{m}"' for i, m in enumerate(_MEASURES)
) + " FROM tel)"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = [F.col("consumo_kwh") * (i + 2) / 16 + (F.col("event_id") * (7919 + i) % 1000).cast("double") / 8 for i in range(len(_MEASURES))]
    made[0] = F.when(F.col("event_id") % 41 != 0, made[0])
    group = (F.col("unit_id") % 5).cast("int").alias("grupo_regional")
    return telemetry(spark, sf_dir).select("event_id", "hora", "data", "consumo_kwh", "machine_type", F.lit("verao").alias("estacao"), group, *[c.alias(m) for c, m in zip(made, _MEASURES, strict=True)])
