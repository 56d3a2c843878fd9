"""Lag and rolling features of hourly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["unit_id", "machine_type"]
LAGS = ["consumo_lag_1h", "consumo_lag_24h", "consumo_rolling_mean_3h"]


def hourly_mean(df: DataFrame, value: str = "consumo_kwh", series: list[str] = SERIES) -> DataFrame:
    """One row for each series, day and hour."""
    return df.groupBy(*series, "data", "hora").agg(F.avg(value).alias(value))


def with_lags(df: DataFrame, value: str = "consumo_kwh", series: list[str] = SERIES, digits: int = 4, mode: str = "rows") -> DataFrame:
    """(series, data, hora, the three lags) of each hour of each series.

    The lag of an hour is the value exactly one hour before, that of a day the value exactly 24
    hours before, null where there is none.  The rolling mean is over three rows, this one
    included, as the data that models were trained on have it; mode "range" takes three hours.
    All frames are over one window in order of the hour's number, so a series is shuffled and
    sorted once and no self-join is needed.
    """
    number = F.datediff("data", F.lit("1970-01-01").cast("date")) * 24 + F.col("hora").cast("int")
    mean = hourly_mean(df, value, series).withColumn("_h", number)
    order = Window.partitionBy(*series).orderBy("_h")
    at = lambda hours: F.when(F.col("_h").isNotNull(), F.max(value).over(order.rangeBetween(-hours, -hours)))
    rolling = F.avg(value).over(order.rowsBetween(-2, 0) if mode == "rows" else order.rangeBetween(-2, 0))
    return mean.select(*series, "data", "hora", F.round(at(1), digits).alias(LAGS[0]), F.round(at(24), digits).alias(LAGS[1]), F.round(rolling, digits).alias(LAGS[2]))


def add_lags(df: DataFrame, value: str = "consumo_kwh", series: list[str] = SERIES, digits: int = 4, mode: str = "rows") -> DataFrame:
    """*df* with the lags of its series, day and hour (old ones replaced); one plan whatever the size."""
    return df.drop(*LAGS).join(with_lags(df, value, series, digits, mode), [*series, "data", "hora"], "left")
