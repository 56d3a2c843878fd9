"""Units and their dates; consumption by direct and indirect measurement in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.scalars import date_of, family
from wattlake.operators.rows import cast_all, in_validity, positive

# The consolidated table and how rows were measured.
TYPES = {
    "unit_id": "bigint", "device_id": "string", "device_version": "string", "hora": "bigint", "data": "date", "consumo_kwh": "double", "data_instalacao": "date",
    "data_inicio_automacao": "date", "metodo": "string", "machine_type": "string", "latitude": "double", "longitude": "double",
}
DIRECT, INDIRECT = "direto", "indireto"


def prepared_units(units: DataFrame, start: str = "data_inicio", days: str = "dias_antes_automacao") -> DataFrame:
    """Adds data_inicio_automacao (from month/day/year text) and data_instalacao, days + 1 before it."""
    begun = date_of(start)
    return units.withColumn("data_inicio_automacao", begun).withColumn("data_instalacao", F.date_sub(begun, (F.col(days) + 1).cast("int")))


def with_reference(units: DataFrame, known: DataFrame) -> DataFrame:
    """Adds reference_id by unit_name (one a name, the least); as it is if the column is there."""
    if "reference_id" in units.columns:
        return units
    return units.join(known.groupBy("unit_name").agg(F.min("reference_id").alias("reference_id")), "unit_name", "left")


def with_unit_id(units: DataFrame, known: DataFrame) -> DataFrame:
    """Adds unit_id by reference_id (of several the least); an error if that column isn't there."""
    if "reference_id" not in units.columns:
        raise ValueError("reference_id is missing")
    ids = known.select(F.col("reference_id").cast("bigint").alias("reference_id"), F.col("id").alias("unit_id")).groupBy("reference_id").agg(F.min("unit_id").alias("unit_id"))
    return units.withColumn("reference_id", F.col("reference_id").cast("bigint")).join(ids, "reference_id", "left")


def new_units(units: DataFrame, done: DataFrame) -> DataFrame:
    """Units that the consolidated table hasn't; none, if there are none."""
    return units.join(done.select("unit_id"), "unit_id", "left_anti")


def _finished(df: DataFrame, available: DataFrame, places: DataFrame, method: str, once: bool) -> DataFrame:
    """The availability gate and the device's places, as the consolidated table has its columns.

    A device with several places has a row for each; without *once* repeated availability rows
    repeat consumption rows as well.
    """
    days = available.select(F.col("device_code").alias("_d"), F.col("record_date").alias("_day"))
    gated = df.join(days, (df["device_id"] == days["_d"]) & (df["data"] == days["_day"]), "left_semi" if once else "inner")
    placed = gated.join(places, gated["device_id"] == places["device_code"], "left")
    return cast_all(placed.withColumn("metodo", F.lit(method)).withColumn("device_version", family("device_id")), TYPES)


def direct(hourly: DataFrame, devices: DataFrame, available: DataFrame, places: DataFrame, once: bool = True) -> DataFrame:
    """Direct consumption: hourly energy of the devices within their unit's validity, on available days, with places.

    hourly: device_id, data, hora, consumo_kwh; devices: device_code, unit_id and the two unit dates.
    """
    joined = hourly.join(devices.withColumnRenamed("device_code", "_c"), F.col("device_id") == F.col("_c")).drop("_c")
    return _finished(in_validity(joined), available, places, DIRECT, once)


def indirect(history: DataFrame, devices: DataFrame, available: DataFrame, places: DataFrame, once: bool = True) -> DataFrame:
    """Indirect consumption: the stored hourly values of the devices in their unit's dates, the last day whole.

    history: device_code, record_date (timestamp), consumption.  One join serves all devices.
    """
    joined = history.join(devices, "device_code").filter((F.col("record_date") >= F.col("data_instalacao")) & (F.col("record_date") < F.date_add("data_inicio_automacao", 1)))
    rows = joined.select("unit_id", F.col("device_code").alias("device_id"), F.col("record_date").cast("date").alias("data"), F.hour("record_date").alias("hora"), F.col("consumption").alias("consumo_kwh"), "data_instalacao", "data_inicio_automacao")
    return _finished(positive(rows), available, places, INDIRECT, once)


def consolidated(direct_rows: DataFrame, indirect_rows: DataFrame) -> DataFrame:
    """Direct rows, and indirect ones of devices that have no direct row."""
    return direct_rows.unionByName(indirect_rows.join(direct_rows.select("device_id").distinct(), "device_id", "left_anti").select(*direct_rows.columns))


def versions_with_current(devices: DataFrame, families: DataFrame) -> DataFrame:
    """The devices' versions that have current data."""
    return devices.select(family("device_code").alias("family")).distinct().join(families, "family", "left_semi")
