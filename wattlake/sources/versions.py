"""Tables in committed versions: data first, then one atomic switch, so that a reader sees a whole version or the one before.

A version is a manifest that names folders of Parquet files.  Appending writes the new rows
alone and a manifest with one folder more; nothing that a reader may be reading is touched.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.operators.rows import one_of_each

MANIFESTS, DATA = "_versions", "data"


class Conflict(RuntimeError):
    """Another writer has switched the table meanwhile."""


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return hadoop, at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list[str]:
    _, at, system = _files(spark, path)
    return [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions of a table, ascending."""
    return sorted(int(m[1]) for m in (re.fullmatch(r"(\d+)\.json", n) for n in _listed(spark, f"{path}/{MANIFESTS}")) if m)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """What a version (the last) consists of; null if there is none."""
    there = numbers(spark, path)
    if version is not None and version not in there:
        raise ValueError(f"{path} has no version {version}")
    if not there:
        return None
    text = spark.read.text(f"{path}/{MANIFESTS}/{version or there[-1]:09d}.json", wholetext=True).first()[0]
    return json.loads(text)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the last by default; an error if there is none."""
    found = manifest(spark, path, version)
    if found is None:
        raise ValueError(f"{path} has no version yet")
    schema = StructType.fromJson(found["schema"])
    return spark.read.schema(schema).parquet(*[f"{path}/{DATA}/{f['name']}" for f in found["folders"]]) if found["folders"] else spark.createDataFrame([], schema)


def _switch(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Makes *content* version *number*: written aside, then renamed, which fails if that version is there."""
    hadoop, _, system = _files(spark, path)
    aside, final = (hadoop.Path(f"{path}/{MANIFESTS}/{name}") for name in (f".{uuid.uuid4().hex}", f"{number:09d}.json"))
    out = system.create(aside, False)
    out.write(json.dumps(content).encode())
    out.close()
    try:
        none = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        hadoop.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else system.getUri(), spark._jsc.hadoopConfiguration()).rename(system.makeQualified(aside), system.makeQualified(final), none)
    except Exception as e:
        system.delete(aside, False)
        raise Conflict(f"{path} got a version {number} from another writer") from e


def _written(df: DataFrame, folder: str, key: list[str]) -> dict:
    """Writes a folder of rows; how many they are and lack a key is counted while they are written."""
    counts = Observation()
    lacking = F.lit(False)
    for c in key:
        lacking = lacking | F.col(f"`{c}`").isNull()
    df.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(lacking).alias("without_key")).write.parquet(folder)
    return counts.get


def _commit(spark: SparkSession, path: str, df: DataFrame, key: list[str], before: dict | None, kept: list[dict]) -> int:
    number = (before["version"] if before else 0) + 1
    name = f"{number:09d}-{uuid.uuid4().hex}"
    counts = _written(df, f"{path}/{DATA}/{name}", key)
    if counts["without_key"]:
        raise ValueError(f"{counts['without_key']} rows without {', '.join(key)}")
    found = spark.read.schema(df.schema).parquet(f"{path}/{DATA}/{name}").count()  # from the files' footers
    if found != counts["rows"]:
        raise RuntimeError(f"{counts['rows']} rows were written to {name}, {found} are there")
    folders = [*kept, {"name": name, "rows": found}]
    made = {"version": number, "rows": sum(f["rows"] for f in folders), "added": found, "key": key, "folders": folders, "schema": df.schema.jsonValue(), "at": datetime.datetime.now(datetime.UTC).isoformat()}
    _switch(spark, path, number, made)
    return number


def replace(df: DataFrame, path: str, key: list[str] | None = None) -> int:
    """*df* as the table's next version, whatever it was before; returns its number.  A *key* is unique: one row of each (the fullest) stays, null keys are an error."""
    spark = df.sparkSession
    return _commit(spark, path, one_of_each(df, key) if key else df, key or [], manifest(spark, path), [])


def append(df: DataFrame, path: str, key: list[str]) -> int:
    """The rows of *df* whose *key* the table lacks, as its next version; returns its number.

    Columns must agree in name and type with the version before.  Of rows alike in their key the
    fullest is taken.  Another writer's switch meanwhile is a :class:`Conflict`, and nothing changes.
    """
    spark = df.sparkSession
    before = manifest(spark, path)
    if before is None:
        return replace(df, path, key)
    schema = StructType.fromJson(before["schema"])
    if {(f.name, f.dataType.simpleString()) for f in schema} != {(f.name, f.dataType.simpleString()) for f in df.schema}:
        raise ValueError(f"columns differ: {sorted(set(schema.names) ^ set(df.columns)) or 'in type'}")
    new = one_of_each(df, key).select(schema.names).join(read(spark, path, before["version"]).select(*key), key, "left_anti")
    return _commit(spark, path, new, key, before, before["folders"])


def history(spark: SparkSession, path: str) -> DataFrame:
    """(version, rows, added, n_folders) of every version: a look at manifests alone."""
    made = [manifest(spark, path, n) for n in numbers(spark, path)]
    return spark.createDataFrame([(m["version"], m["rows"], m["added"], len(m["folders"])) for m in made], "version int, rows long, added long, n_folders int")


def merged(spark: SparkSession, path: str) -> int:
    """The last version again, in one folder; returns the new version's number."""
    before = manifest(spark, path)
    return _commit(spark, path, read(spark, path), before["key"], before, [])


def tidy(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Deletes all but the last *keep* versions and the folders that none of these names (also those of writes that were cut off); to be called while nobody writes."""
    there = numbers(spark, path)
    last = there[-keep:] if keep else []
    named = {f["name"] for n in last for f in manifest(spark, path, n)["folders"]}
    gone = [f"{path}/{DATA}/{n}" for n in _listed(spark, f"{path}/{DATA}") if n not in named]
    gone += [f"{path}/{MANIFESTS}/{n}" for n in _listed(spark, f"{path}/{MANIFESTS}") if n not in {f"{v:09d}.json" for v in last} and not n.endswith(".crc")]
    for g in gone:
        _, at, system = _files(spark, g)
        system.delete(at, True)
    return gone
