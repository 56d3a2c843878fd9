"""Which device belongs to which machine, unit and place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.scalars import family


def path(first: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """*first* joined inner along a chain of (table, column so far, column of the table)."""
    return reduce(lambda left, s: left.join(s[0], left[s[1]] == s[0][s[2]]), steps, first)


def union_distinct(*paths: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, paths).distinct()


def union_all(*paths: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, paths)


def device_places(t: dict[str, DataFrame]) -> DataFrame:
    """(device_code, machine_type, latitude, longitude), by automation and by condensers; units without a place are left out.

    *t*: the association tables by name, with the columns that ``FIXTURES.md`` lists.
    """
    devices = t["DEVICES"].select(F.col("ID").alias("dev"), "DEVICE_CODE")
    duts = path(
        devices,
        (t["DUTS_DEVICES"].select(F.col("ID").alias("dut"), F.col("DEVICE_ID").alias("d")), "dev", "d"),
        (t["DUTS_AUTOMATION"].select("DUT_DEVICE_ID", F.col("MACHINE_ID").alias("machine")), "dut", "DUT_DEVICE_ID"),
    )
    dacs = path(
        devices,
        (t["DACS_DEVICES"].select(F.col("ID").alias("dac"), F.col("DEVICE_ID").alias("d")), "dev", "d"),
        (t["DACS_CONDENSERS"].select("DAC_DEVICE_ID", "CONDENSER_ID"), "dac", "DAC_DEVICE_ID"),
        (t["CONDENSERS"].select(F.col("ID").alias("cond"), F.col("MACHINE_ID").alias("machine")), "CONDENSER_ID", "cond"),
    )
    machines = t["MACHINES"].select(F.col("ID").alias("m"), "TYPE", "UNIT_ID")
    units = t["CLUNITS"].select(F.col("UNIT_ID").alias("u"), "LAT", "LON").filter("LAT is not null")
    placed = [path(p.select("DEVICE_CODE", "machine"), (machines, "machine", "m"), (units, "UNIT_ID", "u")) for p in (duts, dacs)]
    names = {"DEVICE_CODE": "device_code", "TYPE": "machine_type", "LAT": "latitude", "LON": "longitude"}
    return union_distinct(*[p.select(*[F.col(old).alias(new) for old, new in names.items()]) for p in placed])


def devices_of_units(paths: list[DataFrame], names: DataFrame) -> DataFrame:
    """Distinct (device_code, unit_id, unit_name) of all association paths, for the units named."""
    return union_all(*paths).join(names.select("unit_name"), "unit_name", "left_semi").distinct()


def cities(units: DataFrame) -> DataFrame:
    return units.select("city_id").filter("city_id is not null").distinct().orderBy("city_id")


def units_of_references(units: DataFrame, references: DataFrame) -> DataFrame:
    """(id, reference_id) of the units with one of the reference ids; none given is an error."""
    if references.isEmpty():
        raise ValueError("no reference ids")
    return units.select("id", "reference_id").join(references.select("reference_id"), "reference_id", "left_semi").select("id", "reference_id")


def available_devices(history: DataFrame, units: DataFrame, least: float = 75.0) -> DataFrame:
    """(device_code, unit_id) of devices of the units that were available enough on some day; of several units the least id."""
    known = history.filter(F.col("disponibility") >= least).join(units.select("unit_id"), "unit_id", "left_semi")
    return known.groupBy("device_code").agg(F.min("unit_id").alias("unit_id"))


def first_of(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key, the first in a stated order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_r = 1").drop("_r")


def families_with_current(consumption: DataFrame) -> DataFrame:
    return consumption.filter("consumption_ah > 0").select(family("device_code").alias("family")).distinct()


def available_days(history: DataFrame, devices: DataFrame, first: str, last: str, least: float = 75.0) -> DataFrame:
    """Distinct (device_code, record_date) of the devices from *first* to *last* with enough availability."""
    rows = history.filter(F.col("record_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & (F.col("disponibility") >= least))
    return rows.join(devices.select("device_code"), "device_code", "left_semi").select("device_code", "record_date").distinct()
