"""Reading, writing and probing tables."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.operators.rows import one_of_each

SEPARATORS = (";", ",", "\t", "|")
#: Characters of a file by which its separator is told.
SAMPLE = 2048
#: Rows that a database connection fetches at once.
FETCH = 10_000
#: Source kinds by their old integer codes.
KINDS = {1: "bigquery", 2: "postgresql", 3: "mysql"}


def separator_of(spark: SparkSession, path: str) -> str:
    """The separator of a CSV file, by its first SAMPLE characters: what the standard library's sniffer, which knows quotes, finds consistent.

    Where it finds none, the first of SEPARATORS that the first line contains; a comma if there is none.
    """
    lines = spark.read.text(path).select(F.substring("value", 1, SAMPLE)).take(SAMPLE)
    sample = "\n".join(r[0] for r in lines)[:SAMPLE]
    try:
        return csv.Sniffer().sniff(sample, "".join(SEPARATORS)).delimiter
    except csv.Error:
        return next((s for s in SEPARATORS if s in sample.split("\n", 1)[0]), ",")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, separator: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A CSV file with a header; quoted separators are honoured; only *columns* are parsed if given."""
    reader = spark.read.option("header", True).option("sep", separator or separator_of(spark, path)).option("quote", '"').option("escape", '"')
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def roots(df: DataFrame) -> list[str]:
    """The folders and files that the plan of *df* reads, as they were given; their content isn't listed."""
    leaves, found = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = leaf.relation().location().rootPaths()
            found += [paths.apply(i).toString() for i in range(paths.size())]
    return found


def qualified(spark: SparkSession, path: str) -> str:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrites *path*; refuses to overwrite what *df* reads, a part of it, or a folder around it."""
    target = qualified(df.sparkSession, path)
    read = [qualified(df.sparkSession, r) for r in roots(df)]
    if any(r == target or r.startswith(f"{target}/") or target.startswith(f"{r}/") for r in read):
        raise ValueError(f"{path} is read by the same plan; write to another path")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", separator).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_version(new: DataFrame, old: DataFrame | None, key: list[str]) -> DataFrame:
    """Old rows and those new ones whose key isn't there yet (of several the fullest); :mod:`versions` writes such.

    Column sets must agree; a difference is an error rather than a silent overwrite.
    """
    if old is None:
        return one_of_each(new, key)
    if set(new.columns) != set(old.columns):
        raise ValueError(f"columns differ: {sorted(set(new.columns) ^ set(old.columns))}")
    return old.unionByName(one_of_each(new, key).join(old.select(*key), key, "left_anti"))


def jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A table of a database; with *partition_column* and *bounds* it is read by several tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", FETCH).options(**options)
    if partition_column and bounds:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()


def read_source(spark: SparkSession, kind: int | str, name: str, **options: str) -> DataFrame:
    """A table of a source by its kind: one of KINDS, or any format that Spark reads."""
    kind = KINDS.get(kind, kind) if isinstance(kind, int) else kind
    if isinstance(kind, int):
        raise ValueError(f"unknown source {kind}")
    if kind in ("postgresql", "mysql"):
        return jdbc(spark, options.pop("url"), name, **options)
    if kind == "bigquery":
        return spark.read.format("bigquery").options(**options).load(name)
    return spark.read.format(kind).options(**options).load(name)


def extent(df: DataFrame, day: str) -> DataFrame:
    """One row: n_rows, first_day, last_day."""
    return df.agg(F.count("*").alias("n_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def is_fresh(spark: SparkSession, path: str) -> bool:
    """Whether the newest file of a table was written today."""
    newest = spark.read.parquet(path).select(F.max("_metadata.file_modification_time").cast("date").alias("d"), F.current_date().alias("t")).first()
    return newest is not None and newest["d"] == newest["t"]
