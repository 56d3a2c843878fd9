"""Hourly energy from run-length encoded current samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.scalars import int_range, json_scalar, number, overlap, piece

#: Volts times the factor of the supply.
VOLTS = 310.94


def samples(telemetry: DataFrame, payload: str = "charts_detailed", key: str = "Curr") -> DataFrame:
    """(dev_id, day, idx, amps, seconds) of each usable part ``amps[*seconds]`` of the payload.

    Blank parts and those that begin with ``*`` are left out, as are parts without a number of
    amps or of positive seconds; seconds are 1 where they lack.
    """
    parts = telemetry.select("dev_id", "day", F.posexplode(F.split(json_scalar(payload, key), ",")).alias("idx", "part"))
    parts = parts.withColumn("part", F.trim("part")).filter((F.col("part") != "") & ~F.startswith("part", F.lit("*")))
    given = piece("part", "*", 1)
    read = parts.select("dev_id", "day", "idx", number(piece("part", "*", 0)).alias("amps"), F.coalesce(number(given), F.when(given.isNull(), 1.0), F.lit(1.0)).alias("seconds"))
    return read.filter("amps is not null and seconds > 0")


def spans(read: DataFrame) -> DataFrame:
    """Adds start and end second of each sample within its device's day."""
    order = Window.partitionBy("dev_id", "day").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    return read.withColumn("end_s", F.sum("seconds").over(order)).withColumn("start_s", F.col("end_s") - F.col("seconds"))


def hourly_energy(telemetry: DataFrame, first_day: str | None = None, last_day: str | None = None, prefix: str | None = None, volts: float = VOLTS, digits: int = 6) -> DataFrame:
    """(device_id, data, hora, consumo_kwh): energy of each hour 0 to 23 that a sample touches.

    A span is dealt to the hours floor(start / 3600) .. floor((end - 1) / 3600); one that this
    leaves without an hour vanishes, as does what lies after hour 23.
    """
    df = telemetry
    if first_day and last_day:
        df = df.filter(F.col("day").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    if prefix:
        df = df.filter(F.startswith("dev_id", F.lit(prefix)))
    hours = int_range(F.floor(F.col("start_s") / 3600), F.floor((F.col("end_s") - 1) / 3600))
    touched = spans(samples(df)).select("dev_id", "day", "amps", "start_s", "end_s", F.explode(hours).alias("hora"))
    share = overlap(F.col("start_s"), F.col("end_s"), F.col("hora") * 3600.0, (F.col("hora") + 1) * 3600.0)
    kwh = F.round(F.sum(F.lit(volts) * F.col("amps") * share / 3600 / 1000), digits)
    return touched.filter("hora between 0 and 23").groupBy(F.col("dev_id").alias("device_id"), F.col("day").alias("data"), "hora").agg(kwh.alias("consumo_kwh"))
